"""Crawl levels over co-located tables: what is exchanged and what is parsed."""
import re

from pyspark.sql import functions as F

from webloom import schemas
from webloom.operators.crawl import _expand, _Links, capture_index, classify, crawl
from webloom.options import CrawlOptions
from webloom.session import placed_tables

SITE = {"/": ["/a", "/b"], "/a": ["/b", "/c"], "/b": ["/"], "/c": ["/d"], "/d": [], "/lonely": ["/x"], "/x": []}


def captures(spark):
    rows = [(f"http://s.com{p}", "".join(f'<a href="{h}">x</a>' for h in links), 200, None, None) for p, links in SITE.items()]
    return spark.createDataFrame(rows, schemas.CAPTURES)


def exchanges(df):
    """The scans below each Exchange of the physical plan, by their columns."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.split("\n") if re.search(r"Exchange hashpartitioning", line)], text


def test_a_level_exchanges_only_its_own_rows(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with placed_tables(spark) as place:
            index = place(capture_index(captures(spark)), "captures", "url")
            edges = spark.createDataFrame([("http://s.com/", 0, "http://s.com/a")], "src string, pos int, dst string")
            links = _Links(place, captures(spark), edges, False)
            frontier = spark.createDataFrame([("c", "http://s.com/", 0, [], "s.com")],
                                             "crawl_id string, url string, depth int, key array<int>, seed_host string")
            frontier = place(frontier, "visited", "crawl_id", "url")
            level = classify(frontier, index, CrawlOptions(), None)
            found, text = exchanges(level)
            assert len(found) == 1 and "Bucketed: true" in text, text
            level = level.checkpoint()
            following = _expand(level, links.of(level), [frontier.select("crawl_id", "url")] * 2, 1, False)
            found, text = exchanges(following)
            assert len(found) == 2, text  # by url to the links, by (crawl, url) to the visited
            assert [r.url for r in following.collect()] == ["http://s.com/a"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_reached_pages_are_parsed_once(spark):
    with placed_tables(spark) as place:
        links = _Links(place, captures(spark), None, False)
        reached = spark.createDataFrame([("http://s.com/",), ("http://s.com/a",)], "url string")
        first = links.of(reached)
        assert {(r.url, r.dst) for r in first[0].collect()} == {
            ("http://s.com/", "http://s.com/a"), ("http://s.com/", "http://s.com/b"),
            ("http://s.com/a", "http://s.com/b"), ("http://s.com/a", "http://s.com/c")}
        again = links.of(reached.union(spark.createDataFrame([("http://s.com/c",)], "url string")))
        assert len(again) == 2 and [r.dst for r in again[1].collect()] == ["http://s.com/d"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("webloom_")]


def test_depths_of_two_crawls_that_share_pages(spark):
    seeds = spark.createDataFrame([("one", "http://s.com/"), ("two", "http://s.com/a"), ("far", "http://s.com/lonely")],
                                  "crawl_id string, url string")
    got = crawl(seeds, captures(spark), CrawlOptions(depth=3)).nodes.select("crawl_id", "url", "depth").collect()
    short = {(r.crawl_id, r.url.removeprefix("http://s.com"), r.depth) for r in got}
    assert short == {("one", "/", 0), ("one", "/a", 1), ("one", "/b", 1), ("one", "/c", 2), ("one", "/d", 3),
                     ("two", "/a", 0), ("two", "/b", 1), ("two", "/c", 1), ("two", "/", 2), ("two", "/d", 2),
                     ("far", "/lonely", 0), ("far", "/x", 1)}
