"""
sitemap and from links, enrichment, the site operator."""
import datetime as dt

from pyspark.sql import functions as F

from webloom.operators.crawl import map_sites, map_summary
from webloom.operators.search import build_query, enrich, parse_serps
from webloom.options import MapOptions

ROOT = "https://example.com"


def caps(spark, rows):
    df = spark.createDataFrame(rows, "url string, html string, status_code int")
    return df.withColumn("fetched_at", F.lit(dt.datetime(2024, 1, 1))).withColumn(
        "error", F.lit(None).cast("string"))


def test_map_from_sitemap(spark):
    body = ("<urlset><url><loc>https://example.com/a</loc></url><url><loc>https://example.com/b</loc>"
            "</url><url><loc> https://example.com/c </loc></url></urlset>")
    sm = spark.createDataFrame([("example.com", 0, body, 200)], "host string, part int, body string, status_code int")
    seeds = spark.createDataFrame([("s", ROOT)], "crawl_id string, url string")
    e = spark.createDataFrame([], "src string, pos int, dst string")
    m = map_sites(seeds, sm, caps(spark, []), e, MapOptions())
    assert sorted(r.url for r in m.collect()) == [f"{ROOT}/a", f"{ROOT}/b", f"{ROOT}/c"]
    assert map_summary(m).first().total == 3


def test_map_from_links(spark):
    sm = spark.createDataFrame([("example.com", 0, "", 404)], "host string, part int, body string, status_code int")
    seeds = spark.createDataFrame([("s", ROOT)], "crawl_id string, url string")
    e = spark.createDataFrame([(ROOT, 0, f"{ROOT}/x"), (ROOT, 1, "https://other.com/y"),
                               (f"{ROOT}/x", 0, f"{ROOT}/z")], "src string, pos int, dst string")
    c = caps(spark, [(ROOT, "<html></html>", 200), (f"{ROOT}/x", "<html></html>", 200)])
    m = map_sites(seeds, sm, c, e, MapOptions(depth=1))
    assert sorted(r.url for r in m.collect()) == [ROOT, f"{ROOT}/x", f"{ROOT}/z"]


def test_enrichment_and_site_operator(spark):
    serp = ('<div class="result"><h2 class="result__title"><a class="result__a" '
            'href="https://example.com/p">P</a></h2><a class="result__snippet">s</a></div>')
    s = spark.createDataFrame([(1, "q", serp, dt.datetime(2024, 1, 1), 200)],
                              "query_id long, query string, html string, fetched_at timestamp, status_code int")
    r, _ = parse_serps(s)
    page = "<html><head><title>P</title></head><body><main><h2>Ferry Times</h2><p>body</p></main></body></html>"
    e = enrich(r, caps(spark, [("https://example.com/p", page, 200)]), "markdown").first()
    assert "Ferry" in e.content and e.page_title == "P"
    q = spark.createDataFrame([(1, "open source crawler", "ferries.example")], "query_id long, query string, site string")
    assert build_query(q).first().q == "site:ferries.example open source crawler"
