from __future__ import annotations

from pyspark.sql import functions as F

from cardsentry.llm import url_filter as U
from cardsentry.llm.queries import URL_RULES

URLS = [
    (1, "https://WWW.Example.ORG/es/x?y#z", "www.example.org", "/es/x", "example.org/es/", "block"),
    (2, "http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    (5, "ftp://a.com/fr/1", "a.com", "/fr/1", "com/fr/", "allow"),
    (6, "x://b.com/de/#", "b.com", "/de/", "com/de/", "block"),
    (7, "http://org", "org", "", None, "allow"),
    (8, "http://a.com?u=http://b.org/es/", "a.com", "", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "no scheme/com/de/", "", "", None, "allow"),
    (11, "", "", "", None, "allow"),
    (12, "http://ÄB.com/de/\nx", "Äb.com", "/de/\nx", "com/de/", "block"),
    (13, "http:///fr/", "", "/fr/", None, "allow"),
    (14, "a://b://c.com/fr/", "b:", "//c.com/fr/", None, "allow"),
    (14, "a://b://c.com/fr/", "b:", "//c.com/fr/", None, "allow"),
    (None, "http://x.net/" + "p" * 20_000, "x.net", "/" + "p" * 20_000, None, "allow"),
]


def pages(spark, rows):
    return spark.createDataFrame([(r[0], r[1], "<p>", "clash") for r in rows], "page_id long, url string, html string, host string")


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "ref string, bad boolean")


def ref():
    return F.nullif(F.regexp_extract("path", r"^/p/(\d+)$", 1), F.lit(""))


def test_hosts_paths_and_rules(spark):
    got = U.judge(spark, pages(spark, URLS), outcomes(spark, []), URL_RULES, ref())
    key = lambda r: str(r)
    assert sorted([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()], key=key) == sorted(
        [(i, h, p, r, v) for i, _, h, p, r, v in URLS], key=key)


def test_bad_hosts_are_blocked_and_small_ones_shrunk(spark):
    rows, out = [], []
    for k in range(400):
        bad_host = k % 4 == 0
        rows.append((k, f"http://{'spam' if bad_host else f'h{k % 7}'}.site.net/p/{k}"))
        out.append((str(k), bad_host or k % 10 == 1))
    rows += [(1000 + k, f"http://small.other.net/p/{1000 + k}") for k in range(2)]
    out += [("1000", True), ("1000", False), ("1001", False), (None, True), ("5", None)]
    for limit in (10**6, 0):  # broadcast and shuffle join
        got = U.judge(spark, pages(spark, rows), outcomes(spark, out), [], ref(), broadcast_rows=limit).collect()
        assert len(got) == len(rows)
        assert all((r["verdict"] == "block") == r["host"].startswith("spam") for r in got)


def test_prior_by_moments_equals_a_direct_computation():
    import random

    rng = random.Random(3)
    units = [(n := rng.randint(1, 50), sum(rng.random() < rate for _ in range(n))) for rate in (0.1, 0.9, 0.5, 0.2, 0.8) * 8]
    n, k = sum(u[0] for u in units), sum(u[1] for u in units)
    p, m = k / n, len(units)
    s = sum(a * (b / a - p) ** 2 for a, b in units)
    spread = (s - p * (1 - p) * (m - 1)) / (p * (1 - p) * (n - sum(a * a for a, _ in units) / n - m + 1))
    got = U.prior(m, n, k, sum(b * b / a for a, b in units), sum(a * a for a, _ in units))
    assert abs(got[0] - p) < 1e-12 and abs(got[1] - (1 - spread) / spread) < 1e-9


def test_levels(spark):
    d, s = U.levels(F.col("h"), U.MULTI_SUFFIXES)
    rows = spark.createDataFrame([("a.b.co.uk",), ("x.example.com",), ("com",), ("",)], "h string").select("h", d, s).collect()
    assert [tuple(r) for r in rows] == [("a.b.co.uk", "b.co.uk", "co.uk"), ("x.example.com", "example.com", "com"), ("com", "com", "com"), ("", "", "")]


def test_empty_table(spark):
    assert U.judge(spark, pages(spark, []), outcomes(spark, []), URL_RULES, ref()).collect() == []


def test_reputation_columns_and_sites_without_port_and_user(spark):
    rows, out = [], []
    for k in range(60):
        rows.append((k, f"http://{'me@' if k % 3 else ''}spam.net{':8080' if k % 2 else ''}/p/{k}"))
        out.append((str(k), k % 10 != 0))
    rows += [(100 + k, f"http://fine.org:{k}/p/{100 + k}") for k in range(20)]
    out += [(str(100 + k), False) for k in range(20)]
    got = {r["page_id"]: r for r in U.judge(spark, pages(spark, rows), outcomes(spark, out), [], ref()).collect()}
    assert got[1]["host"] == "me@spam.net:8080"  # as the url has it
    assert all((r["n_outcomes"], r["n_bad"], r["verdict"]) == (60, 54, "block") for k, r in got.items() if k < 100)
    assert all((r["n_outcomes"], r["n_bad"], r["verdict"]) == (20, 0, "allow") for k, r in got.items() if k >= 100)
    assert got[0]["bad_bound"] < got[0]["bad_rate"] <= 54 / 60 and got[100]["bad_rate"] >= 0
