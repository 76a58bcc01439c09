import pytest
from pyspark.sql import functions as F

from parcelight.llm import url_filter
from parcelight.llm.queries import URL_RULES

SCHEMA = "page_id bigint, url string, host int, verdict int, _key string, w0 int"


def _pages(spark, urls):
    return spark.createDataFrame([(i, u, 1, 2, "k", 3) for i, u in enumerate(urls)], SCHEMA)


def _judged(spark, urls, listed=(), rules=URL_RULES):
    entries = spark.createDataFrame([(u,) for u in listed], "url string")
    out = url_filter.judge(_pages(spark, urls), entries, rules)
    return [out_row for _, out_row in sorted((r.page_id, r) for r in out.collect())]


def test_hosts_and_paths(spark):
    urls = [None, "", "no scheme/a", "://", "http://A.B.Org", "HTTP://É.COM/Ä/x?q=/y#z",
            "http://h#f", "x://y://com/fr/", "http://h?a/b", "http://u@h:80/p"]
    rows = _judged(spark, urls)
    assert [(r.host, r.path) for r in rows] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("a.b.org", ""), ("É.com", "/Ä/x"),
        ("h", ""), ("y:", "//com/fr/"), ("h", ""), ("u@h:80", "/p")]


def test_the_longest_rule_wins(spark):
    urls = ["http://example.org/es/1", "http://m.example.org/es/", "http://example.org/en/12",
            "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/",
            "http://x.com/de/", "http://x.com/es/", "http://example.org", "http://com/fr/"]
    rows = _judged(spark, urls)
    assert [(r.rule, r.verdict) for r in rows] == [
        ("example.org/es/", "block"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
        ("org/", "allow"), ("org/", "allow"), ("com/fr/", "allow"), ("com/de/", "block"),
        (None, "allow"), (None, "allow"), ("com/fr/", "allow")]


def test_listed_urls_in_canonical_form(spark):
    listed = ["https://www.bad.net/p/?utm_source=x&b=2&a=1#top", None, "no scheme",
              "http://bad.net/p?a=1&b=2", "http://root.net"]
    urls = ["http://bad.net/p?b=2&a=1&ref=q", "http://bad.net/p?b=2", "http://bad.net/P?a=1&b=2",
            "http://m.bad.net/p?a=1&b=2", "https://root.net/", None, "no scheme",
            "http://bad.net/p?a=1&b=2"]
    rows = _judged(spark, urls, listed)
    assert [r.verdict for r in rows] == [
        "block", "allow", "allow", "allow", "block", "allow", "allow", "block"]
    assert [r.listed for r in rows] == [r.verdict == "block" for r in rows]


def test_false_hits_are_removed(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "PER_BLOCK", 400)  # a crowded filter
    listed = [f"http://l{i}.net/" for i in range(800)]
    urls = [f"http://l{i}.net/" for i in range(0, 1600, 2)]
    rows = _judged(spark, urls, listed, [])
    assert [r.listed for r in rows] == [i < 800 for i in range(0, 1600, 2)]
    assert sum(r.possible and not r.listed for r in rows) > 50
    assert all(r.possible for r in rows if r.listed)


def test_the_filter_passes_few(spark):
    listed = [f"http://l{i}.net/" for i in range(2000)]
    urls = [f"http://o{i}.net/" for i in range(4000)]
    rows = _judged(spark, urls, listed, [])
    assert not any(r.listed for r in rows)
    assert sum(r.possible for r in rows) < 0.01 * len(rows)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_a_hot_url_repeated_ids_and_nulls(spark, threshold):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        pages = spark.range(3000).select(
            F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("page_id"),
            F.when(F.col("id") % 3 == 0, "http://hot.net/x").when(F.col("id") % 3 == 1, None)
            .otherwise(F.concat(F.lit("http://h"), F.col("id"), F.lit(".net/"))).alias("url"))
        entries = spark.createDataFrame([("http://hot.net/x",)] * 3, "url string")
        out = url_filter.judge(pages, entries, [])
        assert out.count() == 3000
        assert out.where("verdict = 'block'").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_nothing(spark):
    assert _judged(spark, []) == []
    rows = _judged(spark, ["http://a.net/"], [])
    assert rows[0].verdict == "allow"
