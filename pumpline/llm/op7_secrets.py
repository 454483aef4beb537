"""Secret scan judged by corpus-wide ownership frequency, in DataFrame operations only.

Candidates are pattern matches (assign, access, hex) and long mixed-class tokens.
Each candidate's value is hashed; the corpus is aggregated to the number of
distinct owners (``source``) and repositories (a source's documents in one
language) that hold the hash.  A value held by several owners, or by more than
``REPOS`` of one owner's repositories, is a copied example (licence hashes,
documentation keys); one that stays with a single owner in few places looks live.  Base matches are always reported; a token is added only where it
looks live and overlaps no base match.

Positions come from splitting a text at the matches: the pieces between matches
and the matches alternate, so running sums of their lengths (in code points)
give every start.  The sums run over exploded matches, never over text.

Rows: null text is empty; a text without findings gives zero counts, the hash of
the empty string and an empty span list; a null source is an owner of its own;
equal rows are kept apart; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pumpline.llm.common import fresh, names, numbered, ready, save

#: kind -> (pattern, group that holds the value, fewest characters of that group), in the contract's order.
#: For access and hex the length is in the pattern: a run that is too short fails as a whole either way.
KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "token": (r"[A-Za-z0-9_-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")
MARK = "[SECRET]"

#: A value in more repositories than these is copied about, whoever owns them.
REPOS = 2


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, pos, before, hit): each match with the length of the text since the last one."""
    pattern, _, _ = KINDS[kind]
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.transform(F.arrays_zip(pieces.alias("piece"), hits.alias("hit")), lambda x, i: F.struct(
        F.lit(list(KINDS).index(kind)).alias("kind"), i.alias("pos"),
        F.length(x["piece"]).alias("before"), x["hit"].alias("hit")))
    # the piece after the last match has no match
    return F.when(text.rlike(pattern), F.filter(found, lambda x: x["hit"].isNotNull()))


def candidates(docs: DataFrame, *keep: str, rid: str | None = None) -> DataFrame:
    """(rid, owner, repo, m) of every row, with the columns ``keep``: all matches of the whole text, in one scan.

    ``rid`` is the column of that name; else a number that holds for one
    evaluation, so the table must be saved before it is used twice.
    """
    number = F.monotonically_increasing_id() if rid is None else F.col(rid)
    src = docs.select(number.alias("rid"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("owner"),
                      F.col("lang").cast("string").alias("lang"), *keep)
    empty = F.array().cast("array<struct<kind:int,pos:int,before:int,hit:string>>")
    return src.select("rid", "owner", F.xxhash64("owner", "lang").alias("repo"), *keep,
                      F.concat(*[F.coalesce(_matches(F.col("text"), k), empty) for k in KINDS]).alias("m"))


def spans(rows: DataFrame) -> DataFrame:
    """(rid, owner, repo, kind, start, end, hash): every candidate of ``candidates``."""
    found = rows.select("rid", "owner", "repo", F.explode("m").alias("m"))
    run = Window.partitionBy("rid", F.col("kind")).orderBy("pos")
    rows = found.select("rid", "owner", "repo", "m.*")
    end = F.sum(F.col("before") + F.length("hit")).over(run)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))
    value, ok = F.col("hit"), F.lit(True)
    for k, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        if group:
            value = F.when(F.col("kind") == k, F.regexp_extract("hit", pattern, group)).otherwise(value)
            ok = ok & ((F.col("kind") != k) | (F.length(F.regexp_extract("hit", pattern, group)) >= least))
        if kind == "token":
            mixed = F.col("hit").rlike("[a-z]") & F.col("hit").rlike("[A-Z]") & F.col("hit").rlike("[0-9]")
            ok = ok & ((F.col("kind") != k) | mixed)
    return rows.where(ok).select("rid", "owner", "repo", "kind", "start", "end", F.sha2(value.cast("binary"), 256).alias("hash"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos): distinct owners and repositories of each candidate hash.

    Combined to one row per (hash, owner, repo) before the counts, so a value that
    fills the corpus is a few rows by then.
    """
    one = found.select("hash", F.coalesce(F.col("owner"), F.lit("\0")).alias("owner"), "repo").distinct()
    owners = one.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan(spark: SparkSession, rows: DataFrame, max_owners: int = 1, max_repos: int = REPOS) -> DataFrame:
    """(rid, kind, start, end, base, live) of every reported span of saved ``candidates``.

    ``live``: the value's hash has at most ``max_owners`` owners and ``max_repos``
    repositories in the corpus.
    """
    found = save(spark, spans(rows), "secret-spans")
    own = save(spark, ownership(found), "secret-owners")
    judged = found.join(own, "hash").select("rid", "kind", "start", "end", (F.col("kind") < len(BASE)).alias("base"),
                                            ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)).alias("live"))
    # the last end of the base matches that start at or before a token, and the next base start
    upto = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    is_base = F.col("base")
    judged = judged.select("*", F.max(F.when(is_base, F.col("end"))).over(upto).alias("last_end"),
                           F.min(F.when(is_base, F.col("start"))).over(after).alias("next_start"))
    free = (F.coalesce(F.col("last_end"), F.lit(0)) <= F.col("start")) & (F.col("next_start").isNull() | (F.col("next_start") >= F.col("end")))
    return judged.where(is_base | (F.col("live") & free)).select("rid", "kind", "start", "end", "base", "live")


def _text(rows: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns, with n_live and n_shared (spans of single-owner and of copied values)."""
    ready(spark)
    rows = save(spark, candidates(docs, "doc_id"), "secret-candidates")
    found = scan(spark, rows)
    count = lambda c: F.count_if(c)
    per = found.groupBy("rid").agg(
        *[count(F.col("kind") == k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("all"),
        count(F.col("live")).alias("n_live"), count(~F.col("live")).alias("n_shared"))
    per = per.select("rid", *[f"n_{k}" for k in BASE], F.sha2(_text(F.filter("all", lambda x: x["base"])).cast("binary"), 256).alias("base_sha256"),
                     _text(F.col("all")).alias("spans"), "n_live", "n_shared")
    per = save(spark, per, "secret-per-doc")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.select("rid", "doc_id").join(per, "rid", "left").select(
        "doc_id", *[zero(f"n_{k}") for k in BASE],
        F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_shared"))


def redact_live(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with every live-looking secret replaced by a mark; copied examples stay.

    All rows and columns of ``docs`` are kept; n_chars (where present) follows the new text.
    """
    ready(spark)
    numbers, rid = numbered(spark, docs, "secret-rows")
    cuts_name, new_name = fresh(numbers, "cuts", "new_text")
    live = scan(spark, save(spark, candidates(numbers, rid=rid), "secret-candidates")).where("live")
    before = Window.partitionBy("rid").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    live = live.withColumn("prev", F.coalesce(F.max("end").over(before), F.lit(0)))
    cuts = live.groupBy(F.col("rid").alias(rid)).agg(F.sort_array(F.collect_list(F.struct("start", "prev", "end"))).alias(cuts_name))
    rows = numbers.join(save(spark, cuts, "secret-cuts"), rid, "left")
    text = F.col("text").cast("string")
    # spans that start inside an earlier one add nothing to the text; the tail starts after the last end
    pieces = F.transform(cuts_name, lambda x: F.when(x["start"] >= x["prev"], F.concat(
        F.substring(text, x["prev"] + 1, x["start"] - x["prev"]), F.lit(MARK))).otherwise(F.lit("")))
    last = F.array_max(F.transform(cuts_name, lambda x: x["end"])).cast("int")
    new = F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))
    rows = rows.withColumn(new_name, F.when(F.col(cuts_name).isNotNull(), new))
    out = []
    for c, n in zip(names(docs), docs.columns):
        if n == "text":
            out.append(F.coalesce(new_name, c).alias(n))
        elif n == "n_chars":
            out.append(F.when(F.col(new_name).isNotNull(), F.length(new_name).cast(docs.schema[n].dataType)).otherwise(c).alias(n))
        else:
            out.append(c)
    return rows.select(*out)
