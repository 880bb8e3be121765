from cashweave.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("a.b", "", "block"), (None, "/", "block")]
URLS = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en/", "https://sub.example.com/en", "x://y://com/",
    "http://notexample.com/en/", "http://a.net/es/1", "http://a.net/es", "http://net/fr/#", "http://É.NET/fr/", "http://b", "http://a.b", "http://x.a.b?q", "http://xa.b/", "http://" + "a." * 20_000 + "com/x", "http://a.com" + "/p" * 30_000, "http://a.com\n/en/",
]


def _brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, tail = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest[cut:]
    path = tail[: min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_equals_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for most in (urls.MOST_BITS, 80):  # 80: the list is cut into parts
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages, rules, most_bits=most).collect()}
        assert got == {i: _brute(u) for i, u in enumerate(URLS)}


def test_cascade_is_exact(spark):
    """Many keys, so that the levels have false positives to encode."""
    from pyspark.sql import functions as F

    keys = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = urls.build_cascade(keys)
    assert len(cascade.levels) > 2
    assert cascade.size < 858 * 24
    assert keys.where(cascade.holds(F.col("key")) != F.col("listed")).count() == 0


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert [tuple(r) for r in urls.judge_urls(pages, rules.limit(0)).collect()] == [(1, "a.com", "/", None, "allow")]
    assert urls.judge_urls(pages.limit(0), rules).collect() == []
