"""Rules, vocabulary and their boundaries."""

from pyspark.sql import functions as F

from skylag.llm import url_filter
from skylag.llm.common import on_workers

CASES = [
    ("http://A.Example.ORG/es/x?y", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://badexample.org/en/12", "badexample.org", "/en/12", "org/", "allow"),
    ("http://x.org", "x.org", "", None, "allow"),
    ("https://m.b.com/de/1#t", "m.b.com", "/de/1", "com/de/", "block"),
    ("https://com/fr/porn", "com", "/fr/porn", "com/fr/", "allow"),
    ("http://x.net/a-PORN-b", "x.net", "/a-PORN-b", None, "block"),
    ("http://x.net/popcorn/pornography", "x.net", "/popcorn/pornography", None, "allow"),
    ("http://casino.net/casino/casino", "casino.net", "/casino/casino", None, "allow"),
    ("http://casino.net/?q=poker", "casino.net", "/", None, "block"),
    ("http://sussex.net/sex-education", "sussex.net", "/sex-education", None, "allow"),
    ("no scheme/xxx", "", "", None, "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://x.net/" + "a" * 100_000, "x.net", "/" + "a" * 100_000, None, "allow"),
]


def test_urls(spark):
    on_workers(spark)
    pages = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES + CASES[:1])], "page_id long, url string")
    got = url_filter.judge(pages.withColumn("rule", F.lit("own")).withColumn("more", F.lit(1))).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == CASES + CASES[:1]
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_many_rules_from_a_table(spark):
    on_workers(spark)
    i = F.col("id")
    hosts = spark.range(100_000).select(F.when(i % 2 == 0, "block").otherwise("allow").alias("verdict"), F.concat(F.lit("h"), i, F.lit(".example.net")).alias("host"), F.lit("/").alias("path"))
    more = spark.createDataFrame([("block", "h1.example.net", "/bad"), ("allow", "h2.example.net", "/"), ("block", None, "/"), ("block", "net", "/x")], "verdict string, host string, path string")
    urls = ["http://h1.example.net/", "http://www.H1.example.net/bad/page", "http://h2.example.net/a", "http://h99998.example.net/a", "http://h100000.example.net/x", "http://xh1.example.net/", "http://" + "a." * 20_000 + "h3.example.net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("own"))
    got = url_filter.judge(pages, hosts.union(more)).orderBy("page_id").collect()
    assert [(r.verdict, r.rule) for r in got] == [
        ("allow", "h1.example.net/"), ("block", "h1.example.net/bad"), ("block", "h2.example.net/"), ("block", "h99998.example.net/"), ("block", "net/x"),
        ("allow", None), ("allow", "h3.example.net/"),
    ]


def test_terms_from_a_table(spark):
    on_workers(spark)
    terms = spark.createDataFrame([("One", 1.0), ("half", 0.5), ("other half", 0.5), ("third", 0.34), ("half", 0.2), (None, 1.0), ("", 1.0)], "term string, weight double")
    urls = ["x://a/one", "x://a/half", "x://a/half/other half", "x://a/half/third/third", "x://a/half/third/xone"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge(pages, terms=terms).orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["block", "allow", "block", "allow", "allow"]
    assert {r.verdict for r in url_filter.judge(pages, terms=terms.limit(0)).collect()} == {"allow"}
