"""URL verdicts: longest-match rules, then trust and distrust spread over host links.

Rules decide the pages they fit.  Each host starts with as much trust as it has
pages allowed by a rule and as much distrust as it has pages blocked by one.
Personalised PageRank spreads trust along links and distrust against them (a host
that links to distrusted hosts is suspect).  The same two walks with every page as
a seed give what a host could have at most; the quotients are its relative trust
and distrust, between 0 and 1.  A page without a rule is blocked if its host's
relative distrust is at least ``SHARE`` and exceeds its relative trust, else allowed.

Links are counted per pair of hosts before anything else; relative links stay
with their host.  Each round is two joins on saved tables and one sum, so a hub's
rows can be split and combined.  Rounds go on until no host's score changes by more
than ``TOLERANCE`` of what the host could have; that quotient never grows from round
to round (a host's ``_all`` score takes in at least the same shares), so no far host
is still to move.  ``MOST_ROUNDS`` that do not suffice are an error.  DataFrame
operations only.

Rows: a null url, or one without ``://``, has empty host and path and no rule; null
html has no links; equal pages count each; an empty table gives no rows; extra
columns are ignored.  Scores are compared at four decimals, so neither rounding in
sums nor the tolerance decides between equals.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pumpline.llm.common import save

#: (verdict, host, path): the contract's rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
DAMPING = 0.85
TOLERANCE = 1e-6
MOST_ROUNDS = 200
DECIMALS = 4
SHARE = 0.5


def url_host(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def url_path(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def judged_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, rule_verdict) of every row."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between hosts, with those inside a host."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    links = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(LINK), F.lit(1))
    full = F.transform(links, lambda x: F.when(x.startswith("//"), F.concat(F.lit("x:"), x)).otherwise(x))
    to = F.transform(full, lambda x: F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), url_host(x)))
    rows = pages.select(url_host(url).alias("src"), F.explode(to).alias("to"))
    return rows.select("src", F.coalesce("to", "src").alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def host_scores(spark: SparkSession, pages: DataFrame, rules=RULES, damping: float = DAMPING,
                tolerance: float = TOLERANCE, most: int = MOST_ROUNDS) -> DataFrame:
    """(host, trust, trust_all, distrust, distrust_all) of every host that has pages or links.

    The ``_all`` columns are the same walks with every page as a seed.
    """
    seeds = judged_pages(pages, rules).groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("rule_verdict") == "allow").alias("good"),
        F.count_if(F.col("rule_verdict") == "block").alias("bad"))
    links = save(spark, host_links(pages), "host-links")
    out = links.groupBy("src").agg(F.sum("n").alias("n_out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("n_in"))
    links = save(spark, links.join(out, "src").join(into, "dst")
                 .select("src", "dst", (F.col("n") / F.col("n_out")).alias("along"), (F.col("n") / F.col("n_in")).alias("against")), "host-shares")
    ends = links.select(F.col("dst").alias("host")).distinct()
    counts = ("pages", "good", "bad")
    start = {"trust": "good", "trust_all": "pages", "distrust": "bad", "distrust_all": "pages"}
    seeds = seeds.join(ends, "host", "full").select("host", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in counts])
    state = save(spark, seeds.select("*", *[F.col(s).alias(c) for c, s in start.items()]), "host-seeds")
    for _ in range(most):
        move = lambda on, to, share, which: state.join(links, state.host == links[on]).select(
            F.col(to).alias("host"), *[(F.col(c) * F.col(share) if c.startswith(which) else F.lit(0.0)).alias(c) for c in start])
        got = move("src", "dst", "along", "trust").unionByName(move("dst", "src", "against", "distrust"))
        got = got.groupBy("host").agg(*[F.sum(c).alias(f"got_{c}") for c in start])
        new = {c: F.col(s) * (1 - damping) + F.coalesce(f"got_{c}", F.lit(0.0)) * damping for c, s in start.items()}
        moved = F.greatest(*[F.try_divide(F.abs(new[c] - F.col(c)), F.greatest(new[f"{c.split('_')[0]}_all"], F.col(f"{c.split('_')[0]}_all"))) for c in start])
        seen = Observation()
        state = save(spark, state.join(got, "host", "left").observe(seen, F.max(moved).alias("most")).select(
            "host", *counts, *[e.alias(c) for c, e in new.items()]), "host-state")
        if (seen.get["most"] or 0.0) <= tolerance:
            return state
    raise RuntimeError(f"scores of hosts still change by more than {tolerance} after {most} rounds")


def digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Contract columns: page_id, host, path, rule, verdict."""
    scores = host_scores(spark, pages)
    relative = lambda c: F.round(F.coalesce(F.try_divide(F.col(c), F.col(f"{c}_all")), F.lit(0.0)), DECIMALS)
    blocked = save(spark, scores.select("host", ((relative("distrust") > relative("trust")) & (relative("distrust") >= SHARE)).alias("blocked")), "host-verdicts")
    rows = judged_pages(pages)
    return rows.join(blocked, "host").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))


def oracle(rules=RULES, damping: float = DAMPING, tolerance: float = TOLERANCE, most: int = MOST_ROUNDS) -> str:
    """DuckDB SQL for ``digest``: the rounds as a recursive table that ends by the same rule."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    cases = lambda pick: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{pick(w, h + p)}'" for w, h, p in ordered) + " END"
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    link = LINK.replace("'", "''")
    host = f"translate(regexp_extract(substr({{0}}, strpos({{0}}, '://') + 3), '^[^/?#]*', 0), '{upper}', '{lower}')"
    scores = (("good", "trust", "ta"), ("pages", "ta", "ta"), ("bad", "distrust", "da"), ("pages", "da", "da"))
    new = ", ".join(f"h.{a} * {1 - damping!r}::DOUBLE + COALESCE(SUM(m.{c}), 0) * {damping!r}::DOUBLE AS {c}" for a, c, _ in scores)
    moved = ", ".join(f"abs(n.{c} - o.{c}) / NULLIF(greatest(n.{w}, o.{w}), 0)" for _, c, w in scores)
    return f"""
WITH RECURSIVE u AS (SELECT page_id, html, COALESCE(url, '') AS url FROM pages),
p0 AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN {host.format('url')} ELSE '' END AS host,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
p AS (SELECT *, {cases(lambda w, r: r)} AS rule, {cases(lambda w, r: w)} AS rv FROM p0),
e AS (SELECT host AS src, unnest(regexp_extract_all(COALESCE(html, ''), '{link}', 1)) AS x FROM p),
e1 AS (SELECT src, CASE WHEN starts_with(x, '//') THEN 'x:' || x ELSE x END AS x FROM e),
e2 AS (SELECT src, CASE WHEN regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {host.format('x')} ELSE src END AS dst FROM e1),
n AS (SELECT src, dst, COUNT(*)::DOUBLE AS n FROM e2 GROUP BY ALL),
l AS MATERIALIZED (SELECT src, dst, n / SUM(n) OVER (PARTITION BY src) AS along, n / SUM(n) OVER (PARTITION BY dst) AS against FROM n),
h AS MATERIALIZED (SELECT host, MAX(pages) AS pages, MAX(good) AS good, MAX(bad) AS bad FROM (
  SELECT host, COUNT(*)::DOUBLE AS pages, COUNT(*) FILTER (rv = 'allow')::DOUBLE AS good, COUNT(*) FILTER (rv = 'block')::DOUBLE AS bad FROM p GROUP BY host
  UNION ALL SELECT DISTINCT dst, 0.0, 0.0, 0.0 FROM l) GROUP BY host),
s AS (SELECT 0 AS k, 1.0::DOUBLE AS moved, host, good AS trust, pages AS ta, bad AS distrust, pages AS da FROM h
  UNION ALL
  SELECT o.k + 1, MAX(greatest({moved})) OVER (), n.host, n.trust, n.ta, n.distrust, n.da
  FROM (SELECT h.host, {new}
        FROM h LEFT JOIN (
          SELECT l.dst AS host, s.trust * l.along AS trust, s.ta * l.along AS ta, 0.0::DOUBLE AS distrust, 0.0::DOUBLE AS da FROM s JOIN l ON s.host = l.src
          UNION ALL SELECT l.src, 0.0, 0.0, s.distrust * l.against, s.da * l.against FROM s JOIN l ON s.host = l.dst) m ON m.host = h.host
        GROUP BY h.host, h.pages, h.good, h.bad) n JOIN s o ON o.host = n.host
  WHERE o.moved > {tolerance!r}::DOUBLE AND o.k < {most})
SELECT p.page_id, p.host, p.path, p.rule, COALESCE(p.rv, CASE WHEN r.d > r.t AND r.d >= {SHARE} THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN (SELECT host, ROUND(COALESCE(trust / NULLIF(ta, 0), 0), {DECIMALS}) AS t, ROUND(COALESCE(distrust / NULLIF(da, 0), 0), {DECIMALS}) AS d
             FROM s WHERE k = (SELECT MAX(k) FROM s)) r USING (host)
"""
