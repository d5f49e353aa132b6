"""URL filter against a loop over all rules; the Bloom filter against sets."""

from pyspark.sql import functions as F

from wardflow.llm import bloom, urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.COM", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.org", "/f", "block"), ("same.io", "/x", "allow"), ("same.io", "/x", "block"), (None, "/", "block"), ("", "", "block")]
URLS = ["http://WWW.Example.net/en/1?x=1#y", "https://example.net/de/2", "http://example.net", "http://net/", "http://xnet/",
        "ftp://a.b.example.com/de/", "http://example.com/de", "http://example.com/dex", "http://a.org/fr/1", "http://b.a.org/f",
        "http://aa.org/fr/", "nothing", "", None, "http://", "http://?q", "http:///path", "a://b://c.net/", "http://same.io/x",
        "http://u@h.net:80/a", "http://ÄB.net/É", "http://net./", "http://bad.example/p/?utm_source=1&a=2&ref=z#f",
        "https://www.bad.example:443/p?a=2", "http://bad.example/p", "http://bad.example/p?a=3", "http://x\ny.net/\n"]
LISTED = ["http://bad.example/p/?a=2", None, "", "no url", "http://bad.example/p/?a=2"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    return host, tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]


def judged(url):
    host, path = parts(url)
    fits = [(len(h + p), v, h.lower() + p) for h, p, v in RULES
            if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    if fits:
        _, verdict, rule = max(fits)
        return rule, verdict
    return None, "block" if url and "bad.example" in url and "a=2" in url else "allow"


def test_same_as_a_loop_over_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, URLS[1], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string").withColumn("_rule", F.lit(1))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    found = urls.judge(pages, rules, listed)
    assert found.columns == ["page_id", "url", "_rule", "host", "path", "rule", "verdict", "listed"]
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=str)
    assert got == sorted(((i, u, *parts(u), *judged(u)) for i, u, _ in rows), key=str)
    assert urls.judge(pages.limit(0), rules, listed).count() == 0
    free = urls.judge(pages, rules.limit(0), listed.limit(0))
    assert {(r.rule, r.verdict) for r in free.collect()} == {(None, "allow")}


def test_bloom_filter_loses_no_member(spark, monkeypatch):
    keys = spark.range(3000).select((F.col("id") * 7).cast("string").alias("k"))
    rows = spark.range(30000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("x"))
    members = {str(7 * i) for i in range(3000) if 7 * i < 30000}
    for most in (bloom.MAX_BLOCKS, 4):
        monkeypatch.setattr(bloom, "MAX_BLOCKS", most)
        found = bloom.possible(rows, F.col("k"), bloom.build(keys, "k", 3000))
        assert found.columns == ["k", "x"]
        got = {r.k for r in found.collect()}
        assert members <= got
        if most > 4:
            assert len(got - members) < 300
    assert bloom.possible(rows, F.col("k"), bloom.build(keys.limit(0), "k", 0)).count() == 0
