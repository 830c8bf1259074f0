"""Crawl cases of the reference (cap, external links, exclude, bad seed) and
a BFS-depth property against plain Python."""
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from webloom.operators.crawl import crawl
from webloom.options import CrawlOptions, WebloomError


def graph_frames(spark, edges, captured):
    e = spark.createDataFrame(edges, "src string, pos int, dst string")
    c = spark.createDataFrame([(u, "<title>t</title>", 200) for u in captured],
                              "url string, html string, status_code int")
    c = c.withColumn("fetched_at", F.current_timestamp()).withColumn("error", F.lit(None).cast("string"))
    return e, c


def seeds(spark, url, cid="c1"):
    return spark.createDataFrame([(cid, url)], "crawl_id string, url string")


def test_cap(spark):
    root = "https://ex.com/"
    subs = [f"https://ex.com/p{i}" for i in range(10)]
    e, c = graph_frames(spark, [(root, i, s) for i, s in enumerate(subs)], [root] + subs)
    r = crawl(seeds(spark, root), c, CrawlOptions(max_pages=3), edges=e)
    pages = [x.url for x in r.nodes.filter("reason IS NULL").orderBy("depth", "key").collect()]
    assert pages == [root, subs[0], subs[1]]
    s = r.summary.first()
    assert (s.pages_crawled, s.status) == (3, "complete")


def test_external_and_exclude(spark):
    root = "https://ex.com/"
    e, c = graph_frames(spark, [(root, 0, "https://other.com/x"), (root, 1, "https://ex.com/admin/a"),
                                (root, 2, "https://ex.com/ok"), (root, 3, "https://ex.com/missing")],
                        [root, "https://other.com/x", "https://ex.com/admin/a", "https://ex.com/ok"])
    r = crawl(seeds(spark, root), c, CrawlOptions(exclude=("/admin",)), edges=e)
    got = {x.url: (x.reason, x.detail) for x in r.nodes.collect()}
    assert got["https://other.com/x"] == ("excluded", "different domain")
    assert got["https://ex.com/admin/a"] == ("excluded", "matched exclude pattern")
    assert got["https://ex.com/ok"] == (None, None)
    assert got["https://ex.com/missing"] == ("error", "not captured")
    s = r.summary.first()
    assert (s.pages_crawled, s.pages_skipped, s.pages_discovered) == (2, 3, 8)


def test_bad_seed_and_options(spark):
    e, c = graph_frames(spark, [], [])
    r = crawl(seeds(spark, "not a url"), c, CrawlOptions(), edges=e)
    assert r.rejects.first().code == "INVALID_URL"
    with pytest.raises(WebloomError):
        CrawlOptions(depth=0)
    with pytest.raises(WebloomError) as ex:
        CrawlOptions.of(webhook="http://hook")
    assert ex.value.code == "CLOUD_FEATURE"


def test_bfs_depth_property(spark):
    rng = random.Random(3)
    nodes = [f"https://g.com/n{i}" for i in range(40)]
    edges, adj = [], {n: [] for n in nodes}
    for n in nodes:
        for p in range(rng.randint(0, 4)):
            d = rng.choice(nodes)
            edges.append((n, p, d))
            adj[n].append(d)
    e, c = graph_frames(spark, edges, nodes)
    r = crawl(seeds(spark, nodes[0]), c, CrawlOptions(depth=4, max_pages=1000), edges=e)
    got = {x.url: x.depth for x in r.nodes.collect()}
    want, q = {nodes[0]: 0}, deque([nodes[0]])
    while q:
        u = q.popleft()
        if want[u] == 4:
            continue
        for v in adj[u]:
            if v not in want:
                want[v] = want[u] + 1
                q.append(v)
    assert got == want


def test_crawl_follows_extracted_links(spark):
    pages = {
        "http://ex.com/": '<html><body><nav><a href="/a">A</a><a href="http://other.org/">o</a></nav>'
                          '<main><a href="b#top">B</a></main></body></html>',
        "http://ex.com/a": '<html><body><a href="/">home</a><a href="/c">C</a></body></html>',
        "http://ex.com/b#top": "<html><title>b</title></html>",
        "http://ex.com/c": "<html><title>c</title></html>",
    }
    _, c = graph_frames(spark, [], [])
    c = spark.createDataFrame([(u, h, 200) for u, h in pages.items()],
                              "url string, html string, status_code int")
    c = c.withColumn("fetched_at", F.current_timestamp()).withColumn("error", F.lit(None).cast("string"))
    r = crawl(seeds(spark, "http://ex.com/"), c, CrawlOptions(depth=2))
    got = {x.url: (x.depth, x.reason) for x in r.nodes.collect()}
    assert got == {"http://ex.com/": (0, None), "http://ex.com/a": (1, None),
                   "http://other.org/": (1, "excluded"), "http://ex.com/b#top": (1, None),
                   "http://ex.com/c": (2, None)}
    from webloom.operators.crawl import discover
    d = {x.url for x in discover(seeds(spark, "http://ex.com/"), c).collect()}
    assert d == {"http://ex.com/", "http://ex.com/a", "http://ex.com/b#top", "http://ex.com/c"}
