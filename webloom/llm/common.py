"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.session import configure, ensure_checkpoint_dir

#: Most rows of a narrow (id-only) table that may be broadcast; larger ones are
#: joined by a shuffle. 2 M rows of up to 24 bytes stay near 100 MB as a hash table.
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to shared storage and read back: cuts lineage, survives lost
    executors, and later readers fetch only the columns they need."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_path`` named, once all that was read from
    it has been stored in its turn."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def small_enough(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting: at most ``bound`` rows of ids.
    Beyond it the frame is returned unhinted and the join shuffles."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """16 bytes that identify a document row by its id and text. Rows that
    repeat both are one document. Nulls differ from empty texts."""
    return F.unhex(F.md5(F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
        F.when(F.col(text).isNull(), "\0n").otherwise("\0t"), F.coalesce(F.col(text), F.lit("")))))


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys of a partition that is sorted by them,
    one table per group. Only the current group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k) for k in keys]
        codes = [c.dictionary_encode(null_encoding="encode").indices.to_numpy() for c in cols]
        cuts = np.zeros(batch.num_rows, dtype=bool)
        for code in codes:
            cuts[1:] |= code[1:] != code[:-1]
        starts = [0, *np.flatnonzero(cuts).tolist(), batch.num_rows]
        for lo, hi in zip(starts, starts[1:], strict=False):
            key = tuple(c[lo].as_py() for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def per_group(df: DataFrame, keys: list[str], order: list[str],
              func: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Shuffle by ``keys``, sort each partition (Spark's external sort) and
    stream the groups through ``func``: one Python call per partition, one
    group in memory."""
    def run(batches):
        yield from func(groups(batches, keys))
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def record_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in cols.items()],
        schema=pa.schema([schema.field(n) for n in cols]))
