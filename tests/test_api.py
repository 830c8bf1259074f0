"""Operators not covered by registered queries: sinks, callbacks, loaders,
rendering styles, guards."""
import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from webloom.operators import documents as D
from webloom.operators.compliance import compliance_gate, redact_pii, tos_flags
from webloom.operators.crawl import crawl
from webloom.operators.scrape import batch_errors, batch_scrape, scrape
from webloom.operators.search import build_query
from webloom.options import CrawlOptions, WebloomError, check_format
from webloom.sources.captures import read_crawl, write_crawl

PAGE = ('<html><head><title>T</title></head><body><main><h1>Heading</h1><p>x y</p>'
        '<a href="/b">b</a></main></body></html>')


def caps(spark, rows):
    df = spark.createDataFrame(rows, "url string, html string")
    return (df.withColumn("status_code", F.lit(200)).withColumn(
        "fetched_at", F.lit(dt.datetime(2024, 1, 1))).withColumn("error", F.lit(None).cast("string")))


def test_json_format_nulls(spark):
    no_title = '<html><body><main>hi</main></body></html>'
    c = caps(spark, [("http://a.com/", PAGE), ("http://a.com/n", no_title)])
    got = {r.url: json.loads(r.content) for r in scrape(c, "json").collect()}
    assert got["http://a.com/"] == {"title": "T", "text": "Headingx yb", "links": ["http://a.com/b"]}
    assert got["http://a.com/n"]["title"] is None and "description" not in got["http://a.com/n"]
    with pytest.raises(WebloomError):
        check_format("pdf")


def test_write_crawl_and_load(spark):
    e = spark.createDataFrame([("http://a.com/", 0, "http://a.com/b")], "src string, pos int, dst string")
    c = caps(spark, [("http://a.com/", PAGE), ("http://a.com/b", PAGE)])
    s = spark.createDataFrame([("c1", "http://a.com/")], "crawl_id string, url string")
    r = crawl(s, c, CrawlOptions(depth=1, format="text"), edges=e)
    out = tempfile.mkdtemp(prefix="webloom-crawl-")
    write_crawl(r, out)
    stored = read_crawl(spark, out)
    assert stored["pages"].count() == 2 and stored["pages"].columns == r.pages.columns
    assert stored["summary"].first().pages_crawled == 2 and stored["skips"].count() == 0
    # A run that failed before its manifest is not seen, and goes with the next write.
    os.makedirs(os.path.join(out, "data", "half", "pages"))
    assert read_crawl(spark, out)["pages"].count() == 2
    write_crawl(crawl(s, c.where("url = 'http://a.com/'"), CrawlOptions(depth=1, format="text"), edges=e), out)
    assert read_crawl(spark, out)["pages"].count() == 1 and read_crawl(spark, out)["skips"].count() == 1
    assert len(os.listdir(os.path.join(out, "data"))) == 1
    with pytest.raises(ValueError):
        read_crawl(spark, os.path.join(out, "nothing"))


def test_stored_crawl_files_are_bounded(spark):
    import types
    many = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("crawl_id"),
                                     F.format_string("u%d", "id").alias("url"))
    out = tempfile.mkdtemp(prefix="webloom-crawl-")
    write_crawl(types.SimpleNamespace(pages=many, skips=many.limit(5), summary=many.select("crawl_id").distinct()), out, 4, 3)
    files = [f for d, _, names in os.walk(os.path.join(out, "data")) if d.split(os.sep)[-2] == "pages" for f in names if f.endswith(".parquet")]
    assert 4 < len(files) <= 12 and read_crawl(spark, out)["pages"].exceptAll(many).count() == 0


def test_load_documents(spark):
    e = spark.createDataFrame([("http://a.com/", 0, "http://a.com/b")], "src string, pos int, dst string")
    c = caps(spark, [("http://a.com/", PAGE), ("http://a.com/b", PAGE)])
    s = spark.createDataFrame([("c1", "http://a.com/")], "crawl_id string, url string")
    r = crawl(s, c, CrawlOptions(depth=1, format="text"), edges=e)
    docs = D.load("crawl", result=r)
    assert docs.count() == 2 and "page_content" in docs.columns
    string = D.load("crawl", "string", result=r)
    assert {x["id"] for x in D.iterate(string)} == {"http://a.com/", "http://a.com/b"} and string.first().metadata["wordCount"].isdigit()
    with pytest.raises(ValueError):
        D.load("unknown")
    with pytest.raises(ValueError):
        D.load("crawl", "other", result=r)


def test_stream_pages_callback(spark):
    from webloom.streaming.streams import read_stream, stream_pages, work_dir
    wd = work_dir(spark, "t")
    caps(spark, [("http://a.com/", PAGE)]).write.parquet(f"{wd}/in")
    from webloom import schemas
    src = read_stream(spark, f"{wd}/in", schemas.CAPTURES)
    seen = []

    def on_batch(df, epoch):
        seen.append(df.count())

    q = stream_pages(src, "text", on_batch=on_batch, checkpoint=f"{wd}/ckpt")
    q.awaitTermination()
    assert sum(seen) == 1


def test_render_styles(spark):
    res = spark.createDataFrame([(1, 1, "Ti", "http://x/", "desc", "body text")],
                                "query_id long, position int, title string, url string, description string, content string")
    q = spark.createDataFrame([(1, "q1"), (2, "q2")], "query_id long, query string")
    got = {s: {r.query_id: r.text for r in D.render_search(res, q, s).collect()} for s in D.SEARCH_STYLES}
    assert got["bracket"][1] == "[1] Ti\nURL: http://x/\nSummary: desc\nContent:\nbody text"
    assert got["bold"][1] == "1. **Ti**\n   URL: http://x/\n   desc\n\nbody text\n"
    assert got["dash"][1] == "1. **Ti** — http://x/\ndesc\n\nbody text"
    assert got["plain_py"][1] == "1. Ti\n   http://x/\n   desc\n\nbody text"
    assert got["bracket"][2] == "No results found for: q2"
    assert got["plain_py"][2] == 'No web results found for: "q2"'


def test_context_caps(spark):
    df = spark.createDataFrame([("u", "x" * 3500, list(map(str, range(60))))],
                               "url string, content string, links array<string>")
    r = D.context_caps(df, "crawl").first()
    assert r.content.endswith("\n\n[truncated]") and len(r.content) == 3000 + len("\n\n[truncated]")
    assert len(D.context_caps(df, "scrape").first().links) == 50
    assert D.context_caps(df, "search").first().content.endswith("full content]")


def test_blank_query_and_errors(spark):
    q = spark.createDataFrame([(1, "  "), (2, "hello ")], "query_id long, query string")
    got = {r.query_id: (r.q, r.error) for r in build_query(q).collect()}
    assert got == {1: (None, "INVALID_URL"), 2: ("hello", None)}
    req = spark.createDataFrame([(7, "http://a.com/"), (7, "http://gone/")], "job_id long, url string")
    _, failed, summary = batch_scrape(req, caps(spark, [("http://a.com/", PAGE)]), "text")
    assert [r.url for r in batch_errors(failed, 7).collect()] == ["http://gone/"]
    assert summary.first().status == "partial"


def test_pii_literals_and_gate(spark):
    df = spark.createDataFrame([("d1", "ssn 123-45-6789 mail a.b@c.org call (555) 123-4567 id 4111111111111111"),
                                ("d2", "binding arbitration applies")], "url string, content string")
    r = {x.url: x for x in redact_pii(df).collect()}
    assert r["d1"].content == "ssn [SSN] mail [EMAIL] call [PHONE] id 4111111111111111"
    assert (r["d1"].n_ssn, r["d1"].n_email, r["d1"].n_phone, r["d1"].pii_redacted) == (1, 1, 1, 3)
    lex = spark.createDataFrame([("arb", "(?i)binding arbitration", "block")], "clause string, pattern string, severity string")
    flags = tos_flags(df, lex)
    pages = df.select(F.lit("c").alias("crawl_id"), "url")
    summary, skips = compliance_gate(pages, flags)
    s = summary.first()
    assert (s.n_pages, s.n_blocked, s.compliant) == (2, 1, False)
    assert [(x.url, x.reason, x.detail) for x in skips.collect()] == [("d2", "tos", "arb")]


def test_context_caps_lists(spark):
    assert D.crawl_context_max_pages(None) == 20 and D.crawl_context_max_pages(80) == 50
    skips = spark.createDataFrame([("c", f"u{i:02d}", "error", "x", i % 3) for i in range(30)],
                                  "crawl_id string, url string, reason string, detail string, depth int")
    assert D.crawl_skips_context(skips).count() == 20
    req = spark.createDataFrame([(1, f"u{i}", i) for i in range(25)] + [(2, "v", 0)],
                                "job_id long, url string, seq long")
    got = D.batch_context_requests(req)
    assert got.filter("job_id = 1").count() == 20 and got.filter("job_id = 2").count() == 1
    assert got.filter("job_id = 1").agg(F.max("seq")).first()[0] == 19


def test_visited_once_with_watermark(spark):
    from webloom.streaming.streams import read_stream, run_to_table, visited_once, work_dir
    from pyspark.sql import types as T
    wd = work_dir(spark, "wm")
    rows = [("c", "u1", dt.datetime(2024, 1, 1, 0, 0)), ("c", "u1", dt.datetime(2024, 1, 1, 0, 5)),
            ("c", "u2", dt.datetime(2024, 1, 1, 0, 6))]
    spark.createDataFrame(rows, "crawl_id string, url string, ts timestamp").write.parquet(f"{wd}/in")
    schema = T.StructType([T.StructField("crawl_id", T.StringType()), T.StructField("url", T.StringType()),
                           T.StructField("ts", T.TimestampType())])
    src = read_stream(spark, f"{wd}/in", schema)
    run_to_table(visited_once(src, "ts", "1 hour"), f"{wd}/out", f"{wd}/ckpt")
    assert sorted(r.url for r in spark.read.parquet(f"{wd}/out").collect()) == ["u1", "u2"]


def test_latest_captures_and_canonicalize(spark):
    from webloom.sources.captures import latest_captures
    rows = [("http://a.com/", "<title>old</title>", 200, dt.datetime(2024, 1, 1), None),
            ("http://a.com/", "<title>new</title>", 200, dt.datetime(2024, 1, 2), None)]
    c = spark.createDataFrame(rows, "url string, html string, status_code int, fetched_at timestamp, error string")
    one = latest_captures(c).collect()
    assert len(one) == 1 and "new" in one[0].html
    e = spark.createDataFrame([("http://a.com/", 0, "HTTP://A.com/b#x"), ("http://a.com/", 1, "http://a.com/b")],
                              "src string, pos int, dst string")
    c2 = latest_captures(c.unionByName(spark.createDataFrame(
        [("http://a.com/b", "<title>b</title>", 200, dt.datetime(2024, 1, 1), None)], c.schema)))
    s = spark.createDataFrame([("c", "http://a.com/")], "crawl_id string, url string")
    raw = crawl(s, c2, CrawlOptions(depth=1), edges=e).nodes.count()
    canon = crawl(s, c2, CrawlOptions(depth=1, canonicalize=True), edges=e).nodes.count()
    assert (raw, canon) == (3, 2)


def test_crawl_pii_and_tos(spark):
    p1 = "<html><head><title>A</title></head><body><main>mail x@y.org now</main></body></html>"
    p2 = "<html><head><title>B</title></head><body><main>binding arbitration here</main></body></html>"
    c = caps(spark, [("http://a.com/", p1), ("http://a.com/b", p2)])
    e = spark.createDataFrame([("http://a.com/", 0, "http://a.com/b")], "src string, pos int, dst string")
    s = spark.createDataFrame([("c1", "http://a.com/")], "crawl_id string, url string")
    lex = spark.createDataFrame([("arb", "(?i)binding arbitration", "block")], "clause string, pattern string, severity string")
    r = crawl(s, c, CrawlOptions(depth=1, format="text", pii_filter=True, scan_tos=True), edges=e,
              tos_lexicon=lex)
    pages = {x.url: x.content for x in r.pages.collect()}
    assert pages == {"http://a.com/": "mail [EMAIL] now"}
    sm = r.summary.first()
    assert (sm.pages_crawled, sm.pages_skipped, sm.compliant, sm.pii_redacted) == (1, 1, False, 1)
    assert [(x.url, x.reason) for x in r.skips.collect()] == [("http://a.com/b", "tos")]


def test_stream_monitor_with_ttl(spark):
    from webloom import schemas
    from webloom.streaming.streams import read_stream, run_to_table, stream_monitor, work_dir
    wd = work_dir(spark, "ttl")
    a = caps(spark, [("http://a.com/", "<body><main>one</main></body>")])
    b = caps(spark, [("http://a.com/", "<body><main>two</main></body>")]).withColumn(
        "fetched_at", F.lit(dt.datetime(2024, 1, 2)))
    a.write.parquet(f"{wd}/in")
    b.write.mode("append").parquet(f"{wd}/in")
    src = read_stream(spark, f"{wd}/in", schemas.CAPTURES, files_per_trigger=1)
    run_to_table(stream_monitor(src, ttl_ms=3_600_000), f"{wd}/out", f"{wd}/ckpt")
    rows = spark.read.parquet(f"{wd}/out").collect()
    assert len(rows) == 1 and rows[0].prev_hash != rows[0].hash


def test_package_zip_for_executors():
    import zipfile

    from webloom.session import package_zip
    names = set(zipfile.ZipFile(package_zip()).namelist())
    for mod in ("webloom/__init__.py", "webloom/functions/html.py", "webloom/functions/urls.py",
                "webloom/operators/parse.py", "webloom/operators/monitor.py"):
        assert mod in names
