import duckdb
import pytest

from pumpline.llm import op6_urls as U
from pumpline.llm.common import table
from tests.llm.conftest import SF

PAGES = "page_id long, url string, html string"


def verdicts(spark, df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.digest(spark, df).collect()}


def test_rules(spark, frame):
    urls = {1: "http://a.com/x", 2: "https://www.EXAMPLE.com/en/1?q", 3: "http://x.example.com/en/", 4: "http://example.com/de/", 5: "http://com/",
            6: "http://a.com", 7: "http://notcom/en/", 8: "http://a.net/es/1#f", 9: "ftp://a.b.net/fr/x?y/z", 10: "a.com/x", 11: None, 12: "http://www.example.com/en",
            13: "http://a.com?x/y", 14: "http://a.com#/y", 15: "x://y://z/p", 16: "http://ü.com/é", 17: "http://a.com:80/x"}
    got = verdicts(spark, frame([(i, u, None) for i, u in urls.items()], PAGES))
    assert got[1] == ("a.com", "/x", "com/", "allow") and got[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[3] == ("x.example.com", "/en/", "example.com/en/", "block") and got[4][2:] == ("com/", "allow") and got[5][2] == "com/"
    assert got[6] == ("a.com", "", None, "allow") and got[7][2] is None
    assert got[8] == ("a.net", "/es/1", "net/es/", "block") and got[9] == ("a.b.net", "/fr/x", "net/fr/", "block")
    assert got[10] == ("", "", None, "allow") and got[11] == ("", "", None, "allow") and got[12][2] == "com/"
    assert got[13] == ("a.com", "", None, "allow") and got[14][1] == "" and got[15][:2] == ("y:", "//z/p")
    assert got[16] == ("ü.com", "/é", "com/", "allow") and got[17][:3] == ("a.com:80", "/x", None)


def test_distrust_flows_against_links_and_trust_along_them(spark, frame):
    link = lambda *u: "".join(f'<a class="x" HREF="{x}">t</a>' for x in u)
    rows = [(1, "http://bad.net/es/1", link("/home")), (7, "http://bad.net/es/2", ""), (8, "http://bad.net/es/3", ""),
            (2, "http://farm.org/", link(*["http://bad.net/es/1"] * 9)),  # farm links to a blocked host
            (3, "http://good.com/", link("http://friend.org/a", "//friend.org/b")), (4, "http://friend.org/c", link("/c")),
            (5, "http://alone.org/", None), (6, "http://bad.net/en/", "")]
    got = verdicts(spark, frame(rows, PAGES))
    assert got[2][3] == "block" and got[4][3] == "allow" and got[5][3] == "allow"
    assert got[6][2:] == (None, "block") and got[1][2:] == ("net/es/", "block")
    few = [(i, f"http://bad.net/en/{i}", link("/home")) for i in range(20, 30)]
    assert verdicts(spark, frame(rows + few, PAGES))[6][3] == "allow"  # a host of which little is blocked


def test_digest_is_the_sql(spark):
    pages = table(spark, SF, "pages")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = {r[0]: r[1:] for r in con.sql("SELECT page_id, host, path, rule, verdict FROM (" + U.oracle() + ")").fetchall()}
    assert verdicts(spark, pages) == want and len(want) == pages.count()


def test_scores_are_brute_force(spark):
    pages = table(spark, SF, "pages")
    links = {(r.src, r.dst): r.n for r in U.host_links(pages).collect()}
    seeds = {}
    for r in U.judged_pages(pages).collect():
        s = seeds.setdefault(r.host, [0, 0])
        s[0] += r.rule_verdict == "allow"
        s[1] += r.rule_verdict == "block"
    hosts = set(seeds) | {d for _, d in links}
    out = {h: sum(n for (s, _), n in links.items() if s == h) for h in hosts}
    into = {h: sum(n for (_, d), n in links.items() if d == h) for h in hosts}
    t, b = {h: seeds.get(h, [0, 0])[0] for h in hosts}, {h: seeds.get(h, [0, 0])[1] for h in hosts}
    pages_of = {h: 0 for h in hosts}
    for r in U.judged_pages(pages).collect():
        pages_of[r.host] += 1
    trust, distrust, trust_all, distrust_all = dict(t), dict(b), dict(pages_of), dict(pages_of)
    for _ in range(300):  # far beyond the tolerance
        nt, nb = {h: 0.15 * t[h] for h in hosts}, {h: 0.15 * b[h] for h in hosts}
        na, nc = ({h: 0.15 * pages_of[h] for h in hosts} for _ in range(2))
        for (s, d), n in links.items():
            nt[d] += 0.85 * trust[s] * n / out[s]
            nb[s] += 0.85 * distrust[d] * n / into[d]
            na[d] += 0.85 * trust_all[s] * n / out[s]
            nc[s] += 0.85 * distrust_all[d] * n / into[d]
        trust, distrust, trust_all, distrust_all = nt, nb, na, nc
    for r in U.host_scores(spark, pages).collect():
        assert abs(r.trust - trust[r.host]) < 1e-5 * trust_all[r.host] + 1e-12 and abs(r.distrust - distrust[r.host]) < 1e-5 * distrust_all[r.host] + 1e-12
        assert abs(r.trust_all / trust_all[r.host] - 1) < 1e-5 and abs(r.distrust_all / distrust_all[r.host] - 1) < 1e-5


def test_hosts_far_from_the_seeds_are_reached(spark, frame):
    """A chain of hosts that ends at a blocked one: distrust reaches its far end, thirty links away."""
    hop = lambda k: f"<a href='http://h{k}.org/'>x</a>"
    rows = [(0, "http://h0.org/", hop(1))] + [(k, f"http://h{k}.org/", hop(k + 1)) for k in range(1, 30)]
    rows += [(100 + k, f"http://bad.net/es/{k}", "") for k in range(2000)] + [(99, "http://h30.org/", "<a href='http://bad.net/es/1'>x</a>")]
    got = verdicts(spark, frame(rows, PAGES, clash=False))
    assert all(got[k][3] == "block" for k in range(30)) and got[99][3] == "block"
    with pytest.raises(RuntimeError, match="still change"):
        U.host_scores(spark, frame(rows, PAGES, clash=False), most=5)


def test_odd_rows(spark, frame):
    rows = [(None, None, None), (1, "", ""), (1, "http://a.com/", "<a href=x" * 20000), (1, "http://a.com/", "<a href=x" * 20000), (2, "http://" + "h" * 100000, "<a href='http://q'>")]
    df = frame(rows, PAGES)
    assert U.digest(spark, df).count() == 5
    assert U.digest(spark, df.limit(0)).count() == 0
