import datetime as dt

from pyspark.sql import functions as F

from webloom.operators.search import extract_date, parse_serps

SERP = """<div class="result results_links"><h2 class="result__title">
<a class="result__a" href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fexample.com%2Fone&rut=1">One</a></h2>
<a class="result__snippet">First 2 days ago</a></div>
<div class="result result--ad"><h2 class="result__title"><a class="result__a" href="https://ad.com">Ad</a></h2></div>
<div class="result"><h2 class="result__title"><a href="https://example.com/two">Two</a></h2>
<a class="result__snippet">Second 2024-01-15</a></div>
<div class="result"><a class="result__a" href="//example.com/three">Three</a></div>"""


def serps(spark, html):
    return spark.createDataFrame([(1, "q", html, dt.datetime(2024, 3, 31, 12), 200)],
                                 "query_id long, query string, html string, fetched_at timestamp, status_code int")


def test_serp_parse_and_limit(spark):
    r, _ = parse_serps(serps(spark, SERP), limit=10)
    rows = [(x.position, x.url, x.title, x.published_at) for x in r.orderBy("position").collect()]
    assert rows == [(1, "https://example.com/one", "One", "2024-03-29"),
                    (2, "https://example.com/two", "Two", "2024-01-15"),
                    (3, "https://example.com/three", "Three", None)]
    r2, _ = parse_serps(serps(spark, SERP), limit=2)
    assert r2.count() == 2


def test_fallback_anchors(spark):
    html = '<a class="result__a" href="https://x.com/a">A</a><a class="result__url" href="https://x.com/b"></a>'
    r, _ = parse_serps(serps(spark, html))
    assert [(x.title, x.description) for x in r.orderBy("position").collect()] == \
        [("A", ""), ("https://x.com/b", "")]


def test_month_overflow(spark):
    df = spark.createDataFrame([("1 month ago", dt.date(2023, 3, 31)), ("1 year ago", dt.date(2024, 2, 29)),
                                ("3 weeks ago", dt.date(2024, 1, 10))], "s string, d date")
    got = [x.o for x in df.select(extract_date(F.col("s"), F.col("d")).alias("o")).collect()]
    assert got == ["2023-03-03", "2023-03-01", "2023-12-20"]
