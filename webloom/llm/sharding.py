"""Shuffled shards by a two-pass external shuffle.

Pass 1 scatters the rows over buckets of about ``bucket_bytes`` by a seeded
hash of their content; pass 2 puts each bucket, which fits in memory, through
a seeded Fisher-Yates shuffle. Bucket offsets (prefix sums of the bucket
counts) turn the place in a bucket into a place in the whole order; place p
goes to shard p mod n, slot p div n. Law ``rows``: shard counts differ by at
most one, slots have no gaps. The result depends only on the rows, the seed
and the parameters, not on files or tasks.

Rows: every row gets one place. A null text has size 8 and crc32 of the empty
text. Null or repeated ids are allowed; rows equal in id and text get places
of their own but share a bucket (their hash is equal). A group of equal texts
with different ids is spread like any other rows. Extra columns are carried
unless they bear the name of a result column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from webloom.llm.common import BROADCAST_ROWS, per_group, require

RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
BLOCK = 4096


def _offsets(counts: DataFrame) -> DataFrame:
    """Exclusive prefix sums of the bucket counts, in two levels: within
    blocks of buckets, then over the blocks."""
    blocked = counts.withColumn("block", F.expr(f"bucket div {BLOCK}"))
    inner = Window.partitionBy("block").orderBy("bucket")
    outer = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (blocked.groupBy("block").agg(F.sum("n").alias("n"))
             .select("block", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("ahead")))
    return (blocked.withColumn("inside", F.sum("n").over(inner) - F.col("n"))
            .join(ahead, "block").select("bucket", (F.col("inside") + F.col("ahead")).alias("offset")))


def shard(df: DataFrame, n_shards: int, seed: int = 17, bucket_bytes: int = 8 << 20,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with size, text_crc32, law, shard, slot and grown_shard."""
    require(df, id_col, text_col)
    if n_shards < 1 or bucket_bytes < 1:
        raise ValueError("n_shards and bucket_bytes must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [c for c in df.columns if c not in RESULT or c in (id_col, text_col)]
    sized = df.select(*kept, (F.octet_length(text) + 8).cast("bigint").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    scatter = F.xxhash64(F.lit(seed), F.col(id_col), text)
    rows = sized.withColumn("__order", scatter).withColumn("__bucket", F.pmod("__order", F.lit(n_buckets)))
    counts = rows.groupBy(F.col("__bucket").alias("bucket")).agg(F.count("*").alias("n"))

    schema = rows.schema
    at = rows.columns.index("__bucket")

    def run(buckets):
        for group in buckets:
            bucket = group.column(at)[0].as_py()
            rng = np.random.default_rng([seed, bucket])
            place = np.arange(group.num_rows)
            rng.shuffle(place)  # Fisher-Yates
            whole = group.take(pa.array(place)).append_column(
                "__place", pa.array(np.arange(group.num_rows), pa.int64()))
            yield from whole.to_batches(max_chunksize=256)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    order = ["__order", id_col, "text_crc32", text_col]
    mixed = per_group(rows, ["__bucket"], order, run, f"{fields}, __place bigint")
    offsets = _offsets(counts)
    if n_buckets <= BROADCAST_ROWS:  # else the texts would be shuffled once more before the join is planned anew
        offsets = F.broadcast(offsets)
    placed = mixed.join(offsets, F.col("__bucket") == F.col("bucket"))
    p = F.col("offset") + F.col("__place")
    return placed.select(
        *kept, "size", "text_crc32", F.lit("rows").alias("law"), F.pmod(p, F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(p / n_shards).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in slot order within each file. A
    bucket's places follow each other, so its rows are slot ranges of every
    shard as they are: no shuffle, and no task holds a shard."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType, text_col: str = "text") -> DataFrame:
    """The rows of written shards; ``schema`` is that of the frame written.
    size and text_crc32 are those of the text that is read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = spark.read.schema(schema).parquet(path)
    return (read.withColumn("size", (F.octet_length(text) + 8).cast("bigint"))
            .withColumn("text_crc32", F.crc32(text.cast("binary"))).select(*schema.names))
