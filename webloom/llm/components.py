"""Connected components by distributed union-find (alternating stars).

Each round hooks the larger neighbours of every node to the smallest node it
sees (large star), then the smaller ones (small star), until the edges are
stars around the smallest node of their component. Rounds are written to
shared storage; a hub's rows are only ever aggregated by ``min`` or split by
the skew join, never gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import stored


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges with a > b; loops and nulls dropped."""
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a is not null and b is not null and a > b").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the nodes of ``edges`` (columns a, b of one ordered type)
    with the smallest node of their component, that node included. An empty
    frame gives an empty result."""
    current = stored(_oriented(edges), name)
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.join(lowest, F.col("a") == F.col("u")).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b"))
        smallest = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = (large.join(smallest, F.col("a") == F.col("u"))
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                 .where("a > b").distinct())
        current = stored(small, name)
        following = _state(current)
        if following == state:
            break
        state = following
    roots = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def blocked(members: DataFrame, key: str, node: str, limit: int) -> DataFrame:
    """Members of buckets of two or more, dealt for comparison: a bucket over
    ``limit`` members is split into blocks by a hash of the node, and each
    block meets each other one (and itself) under a key of its own, so no
    task compares more than two blocks. Adds block_a, block_b and block."""
    sizes = members.groupBy(key).agg(F.count("*").alias("members")).where("members > 1")
    rows = members.join(sizes, key).withColumn("blocks", F.ceil(F.col("members") / limit).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(node, F.lit(3)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (rows.withColumn("block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other"))
            .drop("members", "blocks", "other"))
