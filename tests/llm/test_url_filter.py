from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quarterdeck.llm import url_filter
from quarterdeck.llm.queries import ORACLE, QUERIES

T0 = datetime(2024, 1, 1)


def days(n):
    return T0 + timedelta(days=n)


def run(spark, captures, entries):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame(entries, "list_name string, pattern string, listed_at timestamp, active boolean")
    return {r.page_id: (r.blocked, r.lists, r.n_hits) for r in url_filter.filter_captures(c, e).collect()}


def test_entries_hold_from_their_date_until_the_next(spark):
    entries = [("a", "Bad.example", days(10), True), ("a", "bad.example", days(100), False), ("a", "bad.example", days(400), True), ("b", "bad.example", days(400), True), ("b", "bad.example", days(400), False)]
    moments = [9, 10, 99, 100, 399, 400, 4000]
    captures = [(i, "https://www.BAD.example:80/x?y#z", days(d)) for i, d in enumerate(moments)]
    no, one, two = (False, "", 0), (True, "a", 1), (True, "a,b", 2)
    assert run(spark, captures, entries) == dict(enumerate([no, one, one, no, no, two, two]))


def test_domains_paths_and_odd_urls(spark):
    entries = [("d", "example.com", T0, True), ("p", "site.org/ads/new", T0, True), ("h", "localhost", T0, True)]
    urls = ["http://example.com", "http://a.b.example.com/x", "http://notexample.com/", "http://example.com.evil.net/", "https://site.org/ads/new/1", "https://site.org/ads/newer", "https://site.org//ads//new?q=/ads", "http://u:p@localhost:8080/", None, "", "/relative/path", "http://" + "s/" * 30_000]
    got = run(spark, [(i, u, days(1)) for i, u in enumerate(urls)] + [(99, urls[0], None)], entries)
    assert [i for i, v in got.items() if v[0]] == [0, 1, 4, 6, 7]


def test_paths_keep_their_case(spark):
    entries = [("p", "Site.ORG/Ads/New", T0, True), ("q", "site.org/low", T0, True), ("d", "Other.NET", T0, True)]
    urls = ["http://SITE.org/Ads/New/x", "http://site.org/ads/new/x", "http://site.org/Low", "http://site.org/low", "http://www.OTHER.net/Any"]
    got = run(spark, [(i, u, days(1)) for i, u in enumerate(urls)], entries)
    assert [i for i, v in got.items() if v[0]] == [0, 3, 4]


def test_oracle_on_pages_with_capitals_in_paths(spark, tmp_path):
    import duckdb

    rows = [(i, f"http://Host{i % 7}.example/{'Ads' if i % 2 else 'ads'}{i % 5}/X") for i in range(300)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op7_temporal_url_filter"](spark, str(tmp_path)).withColumn("fetched_at", F.col("fetched_at").cast("string")).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = con.sql(ORACLE["op7_temporal_url_filter"]).fetchall()
    assert sorted((r.page_id, r.host, r.fetched_at, r.blocked, r.lists, r.n_hits) for r in got) == sorted((p, h, str(t), b, x, n) for p, h, t, b, x, n in want)


def test_nulls_repeats_and_empty_tables(spark):
    entries = [(None, "x.com", T0, True), ("l", None, T0, True), ("l", "x.com", None, True), ("l", "x.com", T0, None)]
    c = spark.createDataFrame([(1, "http://x.com/", days(2))] * 3 + [(None, None, None)], "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame(entries, "list_name string, pattern string, listed_at timestamp, active boolean")
    c = c.selectExpr("*", "1 AS pattern", "2 AS host", "3 AS `_at`")
    got = url_filter.filter_captures(c, e).collect()
    assert sorted(r.blocked for r in got) == [False, True, True, True]
    assert url_filter.filter_captures(c.where("1 = 0"), e).count() == 0
    assert not any(r.blocked for r in url_filter.filter_captures(c, e.where("1 = 0")).collect())


def test_many_entries_of_one_pattern(spark):
    entries = [("l", "x.com", T0 + timedelta(hours=7 * i), i % 3 == 0) for i in range(900)]
    captures = [(i, "http://x.com/", T0 + timedelta(hours=5 * i + 1)) for i in range(1200)]
    got = run(spark, captures, entries)
    for i, _, at in captures:
        last = min(899, int((at - T0) / timedelta(hours=7)))
        assert got[i][0] == (last % 3 == 0)


def test_query_matches_the_oracle(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_temporal_url_filter"](spark, sf).withColumn("fetched_at", F.col("fetched_at").cast("string"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = con.sql(ORACLE["op7_temporal_url_filter"]).fetchall()
    assert sorted((r.page_id, r.host, r.fetched_at, r.blocked, r.lists, r.n_hits) for r in got.collect()) == sorted((p, h, str(t), b, x, n) for p, h, t, b, x, n in want)
