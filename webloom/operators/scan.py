"""Ordered scans over keys of any size.

An operator that needs the rows of a key in order (the previous fetch of a host,
the last robots file before a request, the k-th page of a crawl) must not put a
key that owns a third of all rows into one task. The rows are range-partitioned
by (key, order) instead, with sampled bounds: every partition is a segment of
about ``rows`` rows, whatever the keys, and equal times are split too, as long
as the order ends in a column that tells rows apart. Windows run within
(segment, key), and one summary row per segment and key carries what earlier
segments of the key leave behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from webloom.session import stored

SEGMENT_ROWS = 1_000_000
SEGMENT = "_seg"


def segments(df: DataFrame, keys: list[str], order: list[str], rows: int = SEGMENT_ROWS,
             name: str = "segments") -> DataFrame:
    """``df`` with ``_seg``: numbers that grow with (keys, order), each for
    about ``rows`` rows. Stored once, so that all branches of a scan agree."""
    df = stored(df, f"{name}-rows")
    n = -(-df.count() // rows)
    if n <= 1:  # all keys together are one segment; windows still deal it out by key
        return df.withColumn(SEGMENT, F.lit(0))
    return stored(df.repartitionByRange(n, *keys, *order).withColumn(SEGMENT, F.spark_partition_id()), name)


def within(keys: list[str], order: list[str]) -> WindowSpec:
    """Rows of a key inside a segment, in order."""
    return Window.partitionBy(SEGMENT, *keys).orderBy(*order)


def earlier(keys: list[str]) -> WindowSpec:
    """Over one row per (key, segment): the earlier segments of the key."""
    return (Window.partitionBy(*keys).orderBy(SEGMENT)
            .rowsBetween(Window.unboundedPreceding, -1))


def nth(df: DataFrame, keys: list[str], order: list[str], n: str, rows: int = SEGMENT_ROWS,
        name: str = "nth") -> DataFrame:
    """Of each key the row at place ``n`` (a column, from 1, the same in all
    rows of a key) in order; keys with fewer rows have none. Segment counts and
    their prefix sums point to the one segment that holds the place; only that
    segment's rows of the key are ranked."""
    placed = segments(df, keys, order, rows, name)
    counts = placed.groupBy(*keys, SEGMENT).agg(F.count("*").alias("_n"), F.first(n).alias("_want"))
    hit = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier(keys)), F.lit(0)))
           .filter((F.col("_before") < F.col("_want")) & (F.col("_want") <= F.col("_before") + F.col("_n")))
           .select(*keys, SEGMENT, (F.col("_want") - F.col("_before")).alias("_place")))
    return (placed.join(hit, [*keys, SEGMENT])
            .withColumn("_rank", F.row_number().over(within(keys, order)))
            .filter(F.col("_rank") == F.col("_place")).drop(SEGMENT, "_place", "_rank"))
