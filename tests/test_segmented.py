"""Segmented scans (used so a hot key never lands in one task) against brute
force, with tiny segments so every cross-segment path runs."""
import datetime as dt
import random


from webloom.operators.monitor import snapshot_history
from webloom.operators.pacing import fetch_schedule, pacing_audit
from webloom.sources.fixtures import host_ranks


def test_host_ranks_match_row_numbers(spark):
    rng = random.Random(5)
    rows = [(i, f"u{i}", rng.choice("aaab")) for i in range(0, 600, rng.choice([1, 2, 3]))]
    p = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {r.url: r["rank"] for r in host_ranks(p, segment_rows=17).collect()}
    seen = {}
    for _, u, h in sorted(rows):
        assert got[u] == seen.get(h, 0), u
        seen[h] = seen.get(h, 0) + 1


def _schedule(rows, delays, default_ms):
    out, last = {}, {}
    for host, arrival, seq in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        d = delays.get(host, default_ms)
        start = arrival if host not in last else max(arrival, last[host] + dt.timedelta(milliseconds=d))
        last[host] = start
        out[seq] = start
    return out


def test_fetch_schedule_brute_force(spark):
    rng = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["h1", "h2", "h3"]), base + dt.timedelta(milliseconds=rng.randint(0, 60000)), i)
            for i in range(400)]
    req = spark.createDataFrame(rows, "host string, arrival timestamp, seq long")
    delays = spark.createDataFrame([("h2", 2.0), ("h3", 0.5)], "host string, delay_sec double")
    got = {r.seq: r.start_at for r in fetch_schedule(req, delays, 1000, segment_rows=23).collect()}
    want = _schedule(rows, {"h2": 2000, "h3": 500}, 1000)
    assert got == want


def test_pacing_audit_brute_force(spark):
    rng = random.Random(2)
    base = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["h1", "h2"]), f"u{i}", base + dt.timedelta(milliseconds=rng.randint(0, 20000)))
            for i in range(200)]
    f = spark.createDataFrame(rows, "host string, url string, fetched_at timestamp")
    got = {r.url for r in pacing_audit(f, None, 1000, segment_rows=23).collect()}
    want, prev = set(), {}
    for h, u, t in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        if h in prev and (t - prev[h]) < dt.timedelta(milliseconds=1000):
            want.add(u)
        prev[h] = t
    assert got == want


def test_history_brute_force(spark):
    rng = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["a", "b"]), base + dt.timedelta(hours=i * 5), rng.choice("xy")) for i in range(60)]
    s = spark.createDataFrame(rows, "url string, fetched_at timestamp, hash string")
    got = {(r.url, r.fetched_at) for r in snapshot_history(s, bucket_seconds=86400).collect()}
    want, prev = set(), {}
    for u, t, h in sorted(rows):
        if u in prev and prev[u] != h:
            want.add((u, t))
        prev[u] = h
    assert got == want
