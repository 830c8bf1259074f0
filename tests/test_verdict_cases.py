"""Inputs outside the clean fixtures: tabs and byte order marks, repeated
requests, failed captures."""

from webloom.operators.crawl import sitemap_urls
from webloom.operators.monitor import snapshot
from webloom.operators.robots import parse_robots
from webloom.operators.scrape import batch_scrape

CAPTURE = "host string, body string, status_code int, fetched_at timestamp"


def test_robots_tabs_and_byte_order_mark(spark):
    body = "﻿User-agent:\t*\nDisallow:\t/private\t\n"
    df = spark.createDataFrame([("a.com", body, 200, None)], CAPTURE)
    assert {(r.kind, r.pattern) for r in parse_robots(df, latest=False).collect()} >= {("disallow", "/private")}


def test_sitemap_urls_lose_tabs(spark):
    df = spark.createDataFrame([("a.com", "<loc>\thttp://a.com/x \t</loc>", 200, None)], CAPTURE)
    assert [r.url for r in sitemap_urls(df).collect()] == ["http://a.com/x"]


def test_repeated_url_counts_once_per_request(spark):
    req = spark.createDataFrame([(1, "u"), (1, "u"), (1, "v")], "job_id int, url string")
    cap = spark.createDataFrame([("u", "<p>x", 200, None, None)],
                                "url string, html string, status_code int, fetched_at timestamp, error string")
    row = batch_scrape(req, cap)[2].collect()[0]
    assert (row.total, row.succeeded, row.status) == (3, 2, "partial")


def test_failed_captures_are_no_snapshots(spark):
    cap = spark.createDataFrame([("u", "<p>x", 200, None, None), ("v", None, 500, None, "boom"), ("w", None, 200, None, None)],
                                "url string, html string, status_code int, fetched_at timestamp, error string")
    assert [r.url for r in snapshot(cap).collect()] == ["u"]


def test_spread_starts_no_job(spark):
    from pyspark.sql import functions as F

    from webloom.session import spread
    spark.sparkContext.setJobGroup("spread-build", "building only")
    try:
        df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().join(spark.range(9).withColumnRenamed("id", "k"), "k")
        spread(df, "k")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("spread-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lexicon_of_any_size(spark):
    from webloom.operators.compliance import tos_flags
    texts = spark.createDataFrame([(1, "no w7x or w1000x here"), (2, None)], "doc bigint, content string")
    lexicon = spark.createDataFrame([(f"c{i}", f"w{i}x", "warn") for i in range(1001)], "clause string, pattern string, severity string")
    flags = tos_flags(texts, lexicon, "doc")
    assert sorted(r.clause for r in flags.collect()) == ["c1000", "c7"]
    none = tos_flags(texts, lexicon.where("clause = ''"), "doc")
    assert none.schema.simpleString() == flags.schema.simpleString() and none.count() == 0


def test_digests_have_no_size_limit(spark):
    from webloom.operators.documents import batch_digest, render_search
    rows = spark.range(501).selectExpr("'j' job_id", "id seq", "'t' title", "concat('u', id) url", "'c' content")
    failed = rows.where("seq < 0").selectExpr("job_id", "seq", "url", "'' error")
    summary = spark.createDataFrame([("j", 501, 501)], "job_id string, total bigint, succeeded bigint")
    assert batch_digest(rows, failed, summary).first().text.count("## t") == 501
    results = spark.range(60).selectExpr("1 query_id", "cast(id + 1 as int) position", "concat('t', id) title", "'u' url",
                                         "'s' description", "cast(null as string) published_date", "'c' content")
    queries = spark.createDataFrame([(1, "q")], "query_id int, query string")
    assert "t59" in render_search(results, queries, "bracket", 60).first().text


def test_robots_asof_keeps_repeated_requests_and_map_columns(spark):
    from pyspark.sql import functions as F

    from webloom.operators.robots import robots_asof
    at = "timestamp'2024-01-02 00:00:00'"
    requests = spark.range(3).selectExpr("map('k', 1) AS m", "'http://a.example/x/1' AS url", f"{at} AS requested_at")
    requests = requests.unionByName(requests.limit(1).withColumn("requested_at", F.lit(None).cast("timestamp")))
    robots = spark.range(1).selectExpr("'a.example' AS host", "'User-agent: *\\nDisallow: /x' AS body", "200 AS status_code",
                                       f"{at} - interval 1 minute AS fetched_at", "cast(null as string) AS error")
    got = sorted((r.robots_known, r.allowed) for r in robots_asof(requests, robots).collect())
    assert got == [(False, True), (True, False), (True, False), (True, False)]


def test_valid_seeds(spark):
    from webloom.functions.urls import valid_url
    good = ["http://[::1]/x", "https://a.com/a b", "http://a.com:80?q", "mailto:x"]
    bad = ["http://", "http://a b.com/", "no scheme", "http://[::1/x", "http://a.com:x/"]
    df = spark.createDataFrame([(u,) for u in good + bad], "url string").withColumn("ok", valid_url("url"))
    assert {r.url for r in df.collect() if r.ok} == set(good)


def test_junk_tags_take_linear_time():
    import time

    from webloom.functions.html import Document
    for junk in ("<a x=1 ", "<a ", "</a ", "<!x ", "<a x='", '<a "', "<a ="):
        for light in (True, False):
            began = time.perf_counter()
            doc = Document("<p>seen</p>" + junk * (1_000_000 // len(junk)), light=light)
            assert time.perf_counter() - began < 5 and doc.text_of(None).startswith("seen"), junk
    began = time.perf_counter()
    Document("<i>" * 100_000 + "</b>" * 100_000)
    assert time.perf_counter() - began < 5


def test_tags_around_broken_ones():
    from webloom.functions.html import Document
    cases = {'<p>a<b "<i>c</i>': ("a<b \"c", []), '<a href="x"y="z">t</a>': ("t", ["x"]), "<a href=x/>t": ("t", ["x/"]),
             "1 < 2 <a href='q>r' >t</a": ("1 < 2 t</a", ["q>r"]), "a<!-- b": ("a", []), "a<!doctype": ("a<!doctype", []),
             "<br/>x</i></p>y": ("xy", []), "<a href=1 <p>t": ("t", ["1"])}
    for light in (True, False):
        for src, want in cases.items():
            doc = Document(src, light=light)
            assert (doc.text_of(None), doc.hrefs) == want, src


def test_markdown_of_deep_nesting():
    from webloom.functions.html import Document, to_markdown
    doc = Document("<div>" * 20_000 + "<b>x</b> y")
    assert to_markdown(doc, None) == "**x** y"
    assert to_markdown(Document("<b>" * 3000 + "x"), None) == "**" * 3000 + "x" + "**" * 3000


def test_latest_of_repeated_captures(spark):
    from webloom.operators.crawl import crawl, links_of
    from webloom.operators.documents import load
    from webloom.operators.search import enrich
    from webloom.options import CrawlOptions
    new = "<title>new</title><meta name=description content=d><body><a href=/b>b</a>"
    rows = [("http://a.example/", f"2024-01-0{i + 1}", h) for i, h in enumerate(("<a href=/old>x</a>", "<p>y", new))]
    caps = spark.createDataFrame([*rows, ("http://a.example/b", "2024-01-01", "<p>z")], "url string, at string, html string")
    caps = caps.selectExpr("url", "html", "200 status_code", "cast(at as timestamp) fetched_at", "cast(null as string) error")
    assert {r.dst for r in links_of(caps).collect()} == {"http://a.example/b"}
    seeds = spark.createDataFrame([("c", "http://a.example/")], "crawl_id string, url string")
    got = crawl(seeds, caps, CrawlOptions(depth=1))
    assert got.summary.first().pages_crawled == 2
    assert sorted((r.url, r.title) for r in got.pages.collect()) == [("http://a.example/", "new"), ("http://a.example/b", None)]
    req = spark.createDataFrame([(1, "http://a.example/")], "job_id int, url string")
    results, _, summary = batch_scrape(req, caps)
    assert [r.title for r in results.collect()] == ["new"] and summary.first().total == 1
    hits = spark.createDataFrame([(1, 1, "http://a.example/", "t", "snippet")],
                                 "query_id int, position int, url string, title string, description string")
    docs = load("search", enriched=enrich(hits, caps)).collect()
    assert [(d.title, d.description, d.crawled_at[:10]) for d in docs] == [("new", "d", "2024-01-03")]


def test_stream_monitor_out_of_order(spark):
    import random

    from webloom.streaming.streams import read_stream, run_to_table, stream_monitor, work_dir
    wd = work_dir(spark, "order")
    days = [(d, "A" if d < 400 else "B") for d in range(800)]
    random.Random(5).shuffle(days)
    late = [(100, "B"), (900, "B")]
    for part in (days, late):
        df = spark.createDataFrame(part, "d int, body string").coalesce(1)
        df.selectExpr("'u' url", "concat('<p>', body) html", "200 status_code", "timestamp_seconds(86400 * d) fetched_at",
                      "cast(null as string) error").write.mode("append").parquet(f"{wd}/in")
    schema = spark.read.parquet(f"{wd}/in").schema
    run_to_table(stream_monitor(read_stream(spark, f"{wd}/in", schema, files_per_trigger=1)), f"{wd}/out", f"{wd}/cp")
    at = [r.t for r in spark.read.parquet(f"{wd}/out").selectExpr("unix_seconds(fetched_at) t").collect()]
    assert at == [86400 * 400]
