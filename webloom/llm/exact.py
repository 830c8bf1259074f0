"""Exact duplicates by content-defined chunk recipes.

A text is normalised (A-Z lower-cased, nothing else) and cut where a rolling
hash of its last 32 bytes hits a pattern, so equal passages are cut alike. A
chunk's identifier is its digest; identifiers that occur more than once are
verified against the chunks' bytes, and an identifier found to name two
contents is replaced by (identifier, rank of the content). Texts are equal
exactly when their ordered identifier lists are: only lists move in the final
grouping, and only the bytes of repeated chunks are ever shuffled.

Rows: one output row per input row. A null text counts as empty; empty texts
are equal to each other. ``keep_id`` is the largest doc_id of the group (nulls
ignored; null if all are null); ``kept`` is ``doc_id <=> keep_id``, so rows that
repeat the largest doc_id are all kept. ``group_size`` counts rows. Only the id
and text columns are read; extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import require, small_enough, stored
from webloom.llm.hashing import mix

WINDOW = 32
MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 512, 11, 16384

_GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks. A position is a candidate when the rolling hash of
    the 32 bytes before it has MEAN_BITS zero bits on top; chunks are at least
    MIN_CHUNK (except the last) and at most MAX_CHUNK bytes."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    span = 1
    while span < WINDOW:  # h[i] = sum of gear[b[i - j]] << j over the window, by doubling
        shifted = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += shifted
        span *= 2
    candidates = np.flatnonzero(h < np.uint32(1 << (32 - MEAN_BITS))) + 1
    out, start, i = [], 0, 0
    while n - start > MIN_CHUNK:
        i = int(np.searchsorted(candidates, start + MIN_CHUNK))
        end = int(candidates[i]) if i < len(candidates) else n
        end = min(end, start + MAX_CHUNK, n)
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def chunk_id(chunk: bytes, id_bytes: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=id_bytes).digest()


def _recipes(docs: DataFrame, id_bytes: int) -> DataFrame:
    kind = docs.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sha, recipe = [], []
            for text in batch.column(1).to_pylist():
                data = (text or "").encode().lower()
                sha.append(hashlib.sha256(data).hexdigest())
                recipe.append([chunk_id(c, id_bytes) for c in chunks(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sha), pa.array(recipe, pa.list_(pa.binary()))],
                names=["doc_id", "text_sha256", "recipe"])

    return docs.mapInArrow(run, f"doc_id {kind}, text_sha256 string, recipe array<binary>")


def _chunk_rows(docs: DataFrame, id_bytes: int) -> DataFrame:
    """(text_sha256, seq, cid, chunk) of every chunk, batch by batch."""
    def run(batches):
        for batch in batches:
            sha, seq, cid, body = [], [], [], []
            for text in batch.column(1).to_pylist():
                data = (text or "").encode().lower()
                digest = hashlib.sha256(data).hexdigest()
                for i, c in enumerate(chunks(data)):
                    sha.append(digest)
                    seq.append(i)
                    cid.append(chunk_id(c, id_bytes))
                    body.append(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sha, pa.string()), pa.array(seq, pa.int32()), pa.array(cid, pa.binary()),
                 pa.array(body, pa.binary())], names=["text_sha256", "seq", "cid", "chunk"])

    return docs.mapInArrow(run, "text_sha256 string, seq int, cid binary, chunk binary")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 id_bytes: int = 16) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row; see module."""
    require(df, id_col, text_col)
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    recipes = stored(_recipes(docs, id_bytes), "recipes")

    repeated = (recipes.select(F.explode("recipe").alias("cid"))
                .groupBy("cid").count().where("count > 1").select("cid"))
    repeated = stored(repeated, "repeated-chunks")
    rows = _chunk_rows(docs, id_bytes).join(small_enough(repeated), "cid", "left_semi")
    contents = stored(rows.select("cid", "chunk").distinct(), "repeated-contents")
    clashing = contents.groupBy("cid").count().where("count > 1").select("cid")
    clashing = stored(clashing, "clashing-chunks")
    key = F.concat_ws("", F.transform("recipe", F.hex))
    if not clashing.isEmpty():
        order = Window.partitionBy("cid").orderBy("chunk")  # the few contents of one clashing identifier
        ranked = (contents.join(small_enough(clashing), "cid", "left_semi")
                  .withColumn("rank", F.row_number().over(order)))
        patch = (rows.join(ranked, ["cid", "chunk"])
                 .select("text_sha256", F.struct("seq", "rank").alias("at")).distinct()
                 .groupBy("text_sha256").agg(F.sort_array(F.collect_list("at")).alias("ranks")))
        recipes = recipes.join(patch, "text_sha256", "left")
        key = F.concat(key, F.coalesce(F.to_json("ranks"), F.lit("")))
    listed = recipes.select("doc_id", "text_sha256", key.alias("key"))
    grouped = (listed.groupBy("key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
               .where("group_size > 1"))
    joined = listed.join(grouped, "key", "left")
    size = F.coalesce("group_size", F.lit(1).cast("bigint"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), size.alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
