"""Per-host pacing (L1, L2) as segmented scans.

Both operators need an order per host. Hosts are cut into segments of a fixed
number of rows by sampled (host, time, sequence) ranges (``scan.segments``), so
a host that owns a third of all requests is split, even if they all arrive at
the same instant; windows per (segment, host) do the bulk of the work, and a
small per-host prefix over one summary row per segment carries the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.operators.scan import SEGMENT, SEGMENT_ROWS, earlier, segments, within
from webloom.options import DEFAULT_DELAY_MS
from webloom.session import stored


def _delayed(rows: DataFrame, delays: DataFrame | None) -> DataFrame:
    if delays is None:
        return rows.withColumn("delay_sec", F.lit(None).cast("double"))
    return rows.join(delays.select("host", "delay_sec"), "host", "left")


def fetch_schedule(requests: DataFrame, delays: DataFrame | None = None,
                   default_ms: int = DEFAULT_DELAY_MS, segment_rows: int = SEGMENT_ROWS,
                   ) -> DataFrame:
    """L1. ``requests``: host, arrival (timestamp), seq; served per host in
    (arrival, seq) order. ``delays``: host, delay_sec (robots Crawl-delay),
    which replaces the default even when shorter. Adds ``start_at``:
    start_1 = arrival_1, start_i = max(arrival_i, start_{i-1} + delay).

    With D_i the sum of delays of rows 2..i of the host,
    start_i = D_i + max_{k<=i}(arrival_k - D_k), computed as a two-level scan.
    """
    order = ["_a", "seq"]
    r = (_delayed(requests, delays)
         .withColumn("_d", F.coalesce((F.col("delay_sec") * 1000).cast("long"),
                                      F.lit(default_ms).cast("long")))
         .withColumn("_a", F.unix_micros("arrival")))
    r = segments(r, ["host"], order, segment_rows, "schedule")
    run = within(["host"], order).rowsBetween(Window.unboundedPreceding, 0)
    # One window pass per (segment, host): the delay sum from the segment start
    # (ms) and the running max of arrival minus that local sum (micros).
    r = r.withColumn("_dl", F.sum("_d").over(run))
    r = r.withColumn("_xl", F.col("_a") - F.col("_dl") * 1000)
    r = stored(r.withColumn("_xlrun", F.max("_xl").over(run)), "schedule-scan")
    # One summary row per segment carries the state across segments:
    #   _off  = delays of earlier segments, minus the host's first delay (the
    #           first request waits for nobody), so D = _off + _dl;
    #   _mprev = max over earlier segments of (arrival - D).
    b = (r.groupBy("host", SEGMENT)
         .agg(F.sum("_d").alias("_bd"), F.min_by("_d", F.struct(*order)).alias("_d0"),
              F.max("_xl").alias("_xlmax")))
    before = earlier(["host"])
    first = F.first("_d0").over(before.rowsBetween(Window.unboundedPreceding, 0))
    b = (b.withColumn("_off", F.coalesce(F.sum("_bd").over(before), F.lit(0)) - first)
         .withColumn("_bmax", F.col("_xlmax") - F.col("_off") * 1000))
    b = b.withColumn("_mprev", F.max("_bmax").over(before))
    r = r.join(b.select("host", SEGMENT, "_off", "_mprev"), ["host", SEGMENT])
    d_us = (F.col("_off") + F.col("_dl")) * 1000
    m = F.col("_xlrun") - F.col("_off") * 1000
    m = F.greatest(m, F.coalesce("_mprev", m))
    start = F.timestamp_micros(d_us + m)
    return r.select(*requests.columns, "delay_sec", start.alias("start_at"))


def pacing_audit(fetches: DataFrame, delays: DataFrame | None = None,
                 default_ms: int = DEFAULT_DELAY_MS, segment_rows: int = SEGMENT_ROWS,
                 ) -> DataFrame:
    """L2: fetches (host, url, fetched_at) closer to the previous fetch of the
    same host than the host's delay. Adds prev_fetched_at, gap_ms, delay_ms.
    The previous fetch is found inside the segment, or else as the last fetch
    of the nearest earlier segment (one summary row per segment)."""
    order = ["fetched_at", "url"]
    f = segments(_delayed(fetches, delays), ["host"], order, segment_rows, "audit")
    f = stored(f.withColumn("_prev", F.lag("fetched_at").over(within(["host"], order))), "audit-scan")
    last = f.groupBy("host", SEGMENT).agg(F.max("fetched_at").alias("_last"))
    last = last.withColumn("_prev_b_last", F.max("_last").over(earlier(["host"])))
    f = f.join(last.select("host", SEGMENT, "_prev_b_last"), ["host", SEGMENT])
    prev = F.coalesce("_prev", "_prev_b_last")
    delay_ms = F.coalesce((F.col("delay_sec") * 1000).cast("long"), F.lit(default_ms).cast("long"))
    gap_ms = F.floor((F.unix_micros("fetched_at") - F.unix_micros(prev)) / 1000).cast("long")
    out = f.select(*fetches.columns, prev.alias("prev_fetched_at"), gap_ms.alias("gap_ms"),
                   delay_ms.alias("delay_ms"))
    return out.filter(F.col("prev_fetched_at").isNotNull() & (F.col("gap_ms") < F.col("delay_ms")))
