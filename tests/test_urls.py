"""URL canonicalisation (U1-U3, P2, P3, P4) on literal edge cases."""

import pytest
from pyspark.sql import functions as F

from newsfold.functions import urls as U

CASES = [
    ("HTTP://Ex.COM:80/a//?b=2&a=1&utm_source=x&a=&UTM_Medium=q#f", "http://Ex.COM:80/a?a=1&b=2"),
    ("http://e.com", "http://e.com/"),
    ("http://e.com/?q=a+b%20c~*é", "http://e.com/?q=a+b+c~%2A%C3%A9"),
    ("https://duckduckgo.com/l/?uddg=https%3A%2F%2Fe.com%2Fa%3Fsource%3Drss%26id%3D7", "https://e.com/a?id=7"),
    ("mailto:a@b.c", ""),
    ("javascript:x", ""),
    ("//e.com/x", ""),
    ("", ""),
    ("file:///x", "file:///x"),
    ("http://www.e.com/", "http://www.e.com/"),
    ("https://e.com/", "https://e.com/"),
    ("http://[bad", ""),
    ("http://e.com/a/b/;p", "http://e.com/a/b;p"),
    ("http://e.com/a;", "http://e.com/a"),
    ("http://e.com/p?=x&k", "http://e.com/p?=x"),
    ("http://e.com/p?a=%zz", "http://e.com/p?a=%25zz"),
    ("1http://e.com/", ""),
    ("urn:isbn:123", "urn:isbn:123"),
    ("http://e.com/?b=2&a=3&a=1", "http://e.com/?a=1&a=3&b=2"),
    ("http://[::1]:8080/x/", "http://[::1]:8080/x"),
]


@pytest.fixture(scope="module")
def canon(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(CASES)], "i int, url string")
    out = U.with_canonical_url(df, "url").orderBy("i").collect()
    return [(r["normalized_url"], r["domain"]) for r in out]


def test_canonical_url(canon):
    for (raw, want), (got, _) in zip(CASES, canon):
        assert got == want, raw


def test_domain_keeps_port_and_www(canon):
    domains = {raw: d for (raw, _), (_, d) in zip(CASES, canon)}
    assert domains["HTTP://Ex.COM:80/a//?b=2&a=1&utm_source=x&a=&UTM_Medium=q#f"] == "ex.com:80"
    assert domains["http://www.e.com/"] == "www.e.com"
    assert domains["file:///x"] == ""


def test_host_allowed_and_site_exclusion(spark):
    rows = [("spam-farm.example.org",), ("e.com",), ("",), ("blog.e.com",), ("notblog.e.com",)]
    df = spark.createDataFrame(rows, "domain string")
    out = df.select(
        "domain",
        U.host_allowed(F.col("domain"), ["spam-farm", "cheap-pills"]).alias("ok"),
        U.excluded_by_site(F.col("domain"), F.array(F.lit("e.com"))).alias("excluded"),
    ).collect()
    got = {r["domain"]: (r["ok"], r["excluded"]) for r in out}
    assert got["spam-farm.example.org"][0] is False
    assert got[""][0] is False
    assert got["e.com"] == (True, True)
    assert got["blog.e.com"] == (True, True)
    assert got["notblog.e.com"] == (True, True)  # subdomain of e.com by the dot rule
