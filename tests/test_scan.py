"""Ordered scans against brute force, with tiny segments and with one key that
holds nearly all rows, all at the same instant."""
import bisect
import datetime as dt
import random

from pyspark.sql import functions as F

from webloom.operators.crawl import _cap_cut
from webloom.operators.pacing import fetch_schedule, pacing_audit
from webloom.operators.robots import robots_asof
from webloom.operators.scan import SEGMENT, nth, segments

BASE = dt.datetime(2024, 1, 1)


def test_segments_split_one_hot_instant(spark):
    rows = spark.range(20_000).select(F.lit("h").alias("host"), F.lit(BASE).alias("at"), F.col("id").alias("seq"))
    out = segments(rows, ["host"], ["at", "seq"], 1_000)
    sizes = [r["count"] for r in out.groupBy(SEGMENT).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 10 and max(sizes) < 3_000
    ends = sorted((r.lo, r.hi) for r in out.groupBy(SEGMENT).agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_nth_of_each_key(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaab"), rng.random(), i) for i in range(3_000)] + [("c", 0.5, 9_000)]
    want = {"a": 1_700, "b": 10, "c": 2}
    df = spark.createDataFrame(rows, "k string, v double, id long").withColumn(
        "n", F.expr("case k when 'a' then 1700 when 'b' then 10 else 2 end"))
    got = {r.k: r.id for r in nth(df, ["k"], ["v", "id"], "n", 100).collect()}
    order = {k: sorted((v, i) for x, v, i in rows if x == k) for k in want}
    assert got == {k: order[k][n - 1][1] for k, n in want.items() if len(order[k]) >= n}


def test_schedule_and_audit_when_all_arrive_at_once(spark):
    req = spark.range(3_000).select(F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("host"),
                                    F.lit(BASE).alias("arrival"), F.col("id").alias("seq"))
    got = {r.seq: r.start_at for r in fetch_schedule(req, None, 1_000, segment_rows=100).collect()}
    place = {"hot": 0, "cold": 0}
    for i in range(3_000):
        host = "cold" if i % 50 == 0 else "hot"
        assert got[i] == BASE + dt.timedelta(seconds=place[host]), i
        place[host] += 1
    fetched = req.select("host", F.format_string("u%05d", "seq").alias("url"), F.col("arrival").alias("fetched_at"))
    assert pacing_audit(fetched, None, 1_000, segment_rows=100).count() == 3_000 - 2


def test_asof_with_one_hot_host(spark):
    rng = random.Random(7)
    captured = sorted(rng.sample(range(0, 4_000_000), 1_000))
    caps = spark.createDataFrame(
        [("hot.com", f"User-agent: *\nDisallow: /{i % 3}", 200, BASE + dt.timedelta(milliseconds=t)) for i, t in enumerate(captured)]
        + [("hot.com", "", 500, BASE), (None, "User-agent: *\nDisallow: /", 200, BASE)],
        "host string, body string, status_code int, fetched_at timestamp")
    n = 100_000
    asked = [(i, f"http://hot.com/{i % 3}", rng.randrange(0, 4_100_000)) for i in range(n)]
    asked += [(n + j, "http://hot.com/0", captured[5]) for j in range(50)] + [(n + 60, "not a url", 5), (n + 61, "http://cold.com/0", 5)]
    req = spark.createDataFrame([(i, u, BASE + dt.timedelta(milliseconds=t)) for i, u, t in asked] + [(n + 62, "http://hot.com/1", None)],
                                "id long, url string, requested_at timestamp")
    out = robots_asof(req, caps, ttl_seconds=5, segment_rows=9_000).select(
        "id", "allowed", "robots_known", (F.unix_millis("robots_fetched_at") - F.unix_millis(F.lit(BASE))).alias("at")).collect()
    got = {r.id: (r.allowed, r.robots_known, r.at) for r in out}
    assert len(out) == len(asked) + 1 and got[n + 62] == (True, False, None)
    for i, u, t in asked:
        k = bisect.bisect_right(captured, t) - 1
        known = "hot.com" in u and k >= 0 and t - captured[k] <= 5_000
        allowed = not (known and u.endswith(f"/{k % 3}"))
        assert got[i] == (allowed, known, captured[k] if known else None), (i, u, t)


def test_cap_of_a_million_pages(spark):
    nodes = spark.range(1_500_000).select(
        F.when(F.col("id") % 100 == 0, "small").otherwise("big").alias("crawl_id"), F.lit(None).cast("string").alias("reason"),
        F.when(F.col("id") < 200_000, 1).otherwise(2).alias("depth"), F.array(F.col("id").cast("int")).alias("key"))
    got = _cap_cut(nodes, 1_000_000, segment_rows=200_000).collect()
    ids = [i for i in range(1_500_000) if i % 100]
    assert [(r.crawl_id, r.cut_depth, r.cut_key) for r in got] == [("big", 2, [ids[999_999]])]
    assert _cap_cut(nodes, 2_000_000).collect() == []
