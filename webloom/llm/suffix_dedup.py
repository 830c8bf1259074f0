"""Repeated byte strings of ``length`` bytes, by prefix-free parsing.

Triggers. A rolling hash is taken of every GRAM bytes. The trigger of a start
position is the last least hash of the next REACH positions, so it depends on
the bytes of the string at that position only: equal strings of ``length`` bytes
have their trigger at the same distance. The positions with one trigger are a
phrase's; triggers are about REACH / 2 bytes apart, in every text.

Parse. The string at a start is a suffix of its trigger's phrase (the bytes
before the trigger, a dictionary suffix) followed by the text from the trigger
on (a parse suffix). Two strings are equal if their dictionary suffixes and as
much of their parse suffixes are. Phrases are told apart by digests first: the
core (the bytes from the trigger that all strings of a phrase share) must occur
twice, or nothing in the phrase repeats; if the context (all bytes that its strings
cover) occurs twice, all of it repeats. One copy stands for equal contexts, so
highly repetitive text shrinks to its distinct phrases.

Order. The distinct contexts of a core are a block. The block's dictionary
suffixes are sorted backwards from the trigger and its parse suffixes forwards,
with the lengths of their common prefixes; cutting both orders where these fall
short of a distance d and of length - d gives the classes of equal strings at d.
Many blocks are sorted together, bytes decide, not hashes. A core with more than
``block`` distinct contexts (a common passage between different texts) is not
gathered: its phrases are cut into ranges of ever fewer start positions, each
judged as above (core once: dropped, context twice: repeated), down to single
strings, by plain aggregation of digests.

Removal. All bytes covered by a repeated string go, judged on the input.

Rows: one output row per input row. A null text counts as empty. Rows that
repeat an id and text are two places of the same bytes: they lose everything
from ``length`` bytes on. Matches never cross rows. An empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import discard, per_group, require, row_key, shared_path, small_enough, stored
from webloom.llm.hashing import prefix, spans

#: Bytes of the rolling hash; a trigger lies less than REACH after its start positions.
GRAM, REACH = 12, 200
#: Distinct contexts of a core that are sorted together, and contexts sorted at once.
BLOCK, AT_ONCE = 256, 8192
#: Start positions of the ranges that the phrases of a common core are cut into, step by step.
STEPS = (25, 5, 1)
#: Start positions hashed at once.
PIECE = 1 << 18
#: Most ranges or phrases in lists that may be broadcast.
LISTED = 250_000


def _last_least(h: np.ndarray, width: int) -> np.ndarray:
    """For each i the last position of the least value of h[i:i + width], by
    running minima of aligned blocks from both sides."""
    n = len(h)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    # Value and position as one number; of equal values the later position is less.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    key = np.concatenate([key, np.full(-n % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    upto = np.minimum.accumulate(key, axis=1).ravel()
    onward = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(onward[:n - width + 1], upto[width - 1:n])
    return (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)


def phrases(data: np.ndarray, bounds: np.ndarray, length: int):
    """Yields (row, trigger, first, last) of the phrases of the texts
    data[bounds[i]:bounds[i + 1]]: every start of a string of ``length`` bytes
    within a text is in first..last of one trigger. Positions are those in ``data``."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, total = 0, len(data) - length + 1
    while at < total:
        upto = min(at + PIECE, total)
        piece = data[at:upto + length - 1]
        places = np.arange(len(piece) - GRAM + 1)
        trigger = _last_least(spans(prefix(piece), places, places + GRAM), REACH)[:upto - at] + at
        owner = row[at:upto]
        start = np.flatnonzero(bounds[owner + 1] - np.arange(at, upto) >= length)
        trigger, owner, start = trigger[start], owner[start], start + at
        new = np.ones(len(start), dtype=bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        at = upto
        if len(first) and upto < total and start[-1] == upto - 1:  # the last phrase may go on
            at, first, last = int(start[first[-1]]), first[:-1], last[:-1]
        yield owner[first], trigger[first], start[first], start[last]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def parse(docs: DataFrame, length: int) -> DataFrame:
    """(dkey, t, s, e, core, context) of the phrases of (dkey, text): trigger,
    first and last start, digests of the core (it only groups) and the context."""
    core = length - REACH + 1

    def run(batches):
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
            held = column.buffers()[2]
            data = np.frombuffer(held, dtype=np.uint8)[bounds[0]:bounds[-1]] if held else np.zeros(0, dtype=np.uint8)
            bounds = bounds - bounds[0]
            view = memoryview(data)
            for row, t, s, e in phrases(data, bounds, length):
                cores = [xxhash.xxh3_64_intdigest(view[i:i + core]) for i in t.tolist()]
                contexts = [_digest(view[i:j + length]) for i, j in zip(s.tolist(), e.tolist(), strict=True)]
                base = bounds[row]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), *[pa.array((x - base).astype(np.int32)) for x in (t, s, e)],
                     pa.array(np.array(cores, dtype=np.uint64).view(np.int64)), pa.array(contexts, pa.binary())],
                    names=["dkey", "t", "s", "e", "core", "context"])

    return docs.where(F.octet_length("text") >= length).select("dkey", "text").mapInArrow(
        run, "dkey binary, t int, s int, e int, core bigint, context binary")


def _judged(ranges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Of ranges of starts (dkey, t, s, e, known, core, context): those whose
    context occurs elsewhere (dkey, s, e), and one range of each context (known:
    it repeats) where a core has several contexts, one of them not known."""
    context = ranges.groupBy("context").agg(
        F.count("*").alias("n"), F.bool_or("known").alias("known"),
        F.min(F.struct("core", "dkey", "t", "s", "e")).alias("one"))
    classes = stored(context.select("context", "one.*", (F.col("known") | (F.col("n") > 1)).alias("known")), f"{name}-contexts")
    repeated = small_enough(stored(classes.where("known").select("context"), f"{name}-repeated"))
    found = ranges.where(~F.col("known")).join(repeated, "context", "left_semi").select("dkey", "s", "e")
    cores = (classes.groupBy("core").agg(F.count("*").alias("contexts"), F.bool_and("known").alias("settled"))
             .where(~F.col("settled") & (F.col("contexts") > 1)).select("core", "contexts"))
    cores = small_enough(stored(cores, f"{name}-cores"))
    return found, stored(classes.join(cores, "core").drop("context"), f"{name}-open")


def _single(docs: DataFrame) -> DataFrame:
    """One of the rows that repeat a dkey; only these are shuffled."""
    repeated = small_enough(stored(docs.groupBy("dkey").count().where("count > 1").select("dkey"), "repeated-rows"))
    return (docs.join(repeated, "dkey", "left_anti")
            .unionByName(docs.join(repeated, "dkey", "left_semi").dropDuplicates(["dkey"])))


def _listed(lists: DataFrame, column: str) -> DataFrame:
    """Lists by row, hinted for a broadcast if they have at most LISTED entries in all."""
    total = lists.agg(F.coalesce(F.sum(F.size(column)), F.lit(0))).first()[0]
    return F.broadcast(lists) if total <= LISTED else lists


def _with_bytes(docs: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """``members`` with the bytes of their contexts."""
    lists = members.groupBy("dkey").agg(F.collect_list(F.struct("core", "contexts", "t", "s", "e", "known")).alias("members"))
    lists = stored(lists, "members")
    asked = docs.join(small_enough(lists.select("dkey")), "dkey", "left_semi")
    return (_single(asked).join(_listed(lists, "members"), "dkey")
            .select("dkey", F.encode("text", "UTF-8").alias("text"), F.inline("members"))
            .select("dkey", "core", "contexts", "t", "s", "e", "known",
                    F.substring("text", F.col("s") + 1, F.col("e") - F.col("s") + length).alias("bytes")))


def _order(rows: list[bytes], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``rows`` within their blocks, and the common prefix of each
    with its predecessor in that order (-1 at the start of a block)."""
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    width = max(1, int(lengths.max()))
    grid = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8).reshape(len(rows), width)
    head, tail = block.astype(">u4").view(np.uint8).reshape(-1, 4), lengths.astype(">u4").view(np.uint8).reshape(-1, 4)
    order = np.argsort(np.concatenate([head, grid, tail], axis=1).view(f"S{width + 8}").ravel(), kind="stable")
    grid, lengths, block = grid[order], lengths[order], block[order]
    lcp = np.full(len(rows), -1, dtype=np.int64)
    apart = grid[1:] != grid[:-1]
    same = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    lcp[1:] = np.where(block[1:] == block[:-1], np.minimum(same, np.minimum(lengths[1:], lengths[:-1])), -1)
    return order, lcp


def repeated_distances(block: np.ndarray, before: list[bytes], after: list[bytes], least: np.ndarray, length: int) -> np.ndarray:
    """For each context (dictionary suffix before its trigger, parse suffix from
    it on; its strings start at the distances least..len(before)) and distance
    whether another context of its block has the same string there."""
    m = len(block)
    most = np.array([len(b) for b in before], dtype=np.int64)
    backward, back = _order([b[::-1] for b in before], block)
    forward, ahead = _order(after, block)
    out = np.zeros((m, int(most.max()) + 1), dtype=bool)
    left, right = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for d in range(int(least.min()), out.shape[1]):
        some = np.flatnonzero((least <= d) & (most >= d))
        if len(some) > 1:
            left[backward] = np.cumsum(back < d)
            right[forward] = np.cumsum(ahead < length - d)
            _, which, count = np.unique(left[some] * (m + 1) + right[some], return_inverse=True, return_counts=True)
            out[some, d] = count[which] > 1
    return out


def _sorted_blocks(groups, length: int):
    """(dkey, s, e): ranges of repeated starts among the members of blocks."""
    def flush(held):
        block = np.repeat(np.arange(len(held)), [t.num_rows for t in held])
        table = pa.concat_tables(held)
        t, s, e = (table[c].to_numpy().astype(np.int64) for c in ("t", "s", "e"))
        text, split = table["bytes"].to_pylist(), (t - s).tolist()
        repeated = repeated_distances(block, [x[:i] for x, i in zip(text, split, strict=True)],
                                      [x[i:] for x, i in zip(text, split, strict=True)], t - e, length)
        repeated[table["known"].to_numpy()] = False
        edge = np.diff(np.pad(repeated.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        (row, near), far = np.nonzero(edge == 1), np.nonzero(edge == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [table["dkey"].combine_chunks().take(pa.array(row)), pa.array((t[row] - far).astype(np.int32)),
             pa.array((t[row] - near).astype(np.int32))], names=["dkey", "s", "e"])

    held, size = [], 0
    for table in groups:
        held.append(table.combine_chunks())
        size += table.num_rows
        if size >= AT_ONCE:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def _cut(ranges: DataFrame, step: int, length: int) -> DataFrame:
    """Ranges of starts (dkey, t, s, e, known, base, bytes: the text from base
    on) cut at multiples of ``step`` before the trigger, with digests of core and
    context. Both name their distances: strings are equal at equal distances only."""
    names = ("dkey", "t", "s", "e", "known", "base", "bytes")

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, t, s, e, known, base, data in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                for part in range((t - e) // step, (t - s) // step + 1):
                    near, far = max(part * step, t - e), min(part * step + step - 1, t - s)
                    a, b = t - part * step - base, t - part * step - step + 1 - base + length
                    core = _digest(part.to_bytes(2, "big") + data[a:b])
                    context = core if step == 1 else _digest(
                        near.to_bytes(2, "big") + far.to_bytes(2, "big") + data[t - far - base:t - near - base + length])
                    for o, v in zip(out, (key, t, t - far, t - near, known, core, context), strict=True):
                        o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, k) for o, k in zip(out, (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(),
                                                       pa.binary()), strict=True)],
                names=["dkey", "t", "s", "e", "known", "core", "context"])

    return ranges.select(*names).mapInArrow(
        run, "dkey binary, t int, s int, e int, known boolean, core binary, context binary")


def repeated_ranges(docs: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """(dkey, s, e): ranges of starts of strings of ``length`` bytes that occur
    elsewhere in (dkey, text), without order, some repeatedly."""
    spark = docs.sparkSession
    path = shared_path(spark, "phrases")  # the largest table: a row for each phrase of every text
    parse(docs, length).write.parquet(path)
    parsed = spark.read.parquet(path)
    seen = small_enough(stored(parsed.groupBy("core").count().where("count > 1").select("core"), "repeated-cores"))
    candidates = stored(parsed.join(seen, "core", "left_semi").withColumn("known", F.lit(False)), "candidates")
    discard(spark, path)
    found, open_ = _judged(candidates, "phrases")
    members = stored(_with_bytes(docs, open_, length), "contexts")
    few = members.where(F.col("contexts") <= block)
    found = found.unionByName(per_group(few.select("core", "dkey", "t", "s", "e", "known", "bytes"), ["core"], [],
                                        lambda g: _sorted_blocks(g, length), "dkey binary, s int, e int"))
    texts = members.where(F.col("contexts") > block).select("dkey", "t", F.col("s").alias("base"), "bytes")
    ranges = members.where(F.col("contexts") > block).withColumn("base", F.col("s"))
    for step in STEPS:
        parts = stored(_cut(ranges, step, length), f"ranges-{step}")
        more, open_ = _judged(parts, f"ranges-{step}")
        found = found.unionByName(more)
        ranges = open_.join(texts, ["dkey", "t"])
    return found


def _merged(ranges: DataFrame, length: int) -> DataFrame:
    """(dkey, spans): the bytes covered by the strings at the starts, as sorted disjoint [from, to)."""
    lists = ranges.groupBy("dkey").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def run(batches):
        for batch in batches:
            rows = []
            for s, e in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                s, e = np.array(s), np.array(e) + length
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order])
                new = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
                rows.append([{"from": a, "to": b} for a, b in zip(s[new].tolist(), e[np.append(new[1:], len(s)) - 1].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["dkey", "spans"])

    return lists.mapInArrow(run, "dkey binary, spans array<struct<from:int,to:int>>")


def _removed(rows: DataFrame) -> DataFrame:
    """The rows with ``kept``, the bytes of text outside of the spans."""
    def run(batches):
        for batch in batches:
            kept = []
            for data, spans_ in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data, at, out = data or b"", 0, []
                for x in spans_ or ():
                    out.append(data[at:x["from"]])
                    at = x["to"]
                kept.append(b"".join([*out, data[at:]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kept, pa.binary())], names=[*batch.schema.names, "kept"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{names}, kept binary")


def remove_repeats(df: DataFrame, length: int = 400, block: int = BLOCK) -> DataFrame:
    """(doc_id, text, spans, kept): the byte ranges [from, to) of each text
    that strings of ``length`` bytes cover which occur elsewhere, and the bytes
    that are left (cut at bytes, so perhaps within a character)."""
    require(df, "doc_id", "text")
    if length < REACH + GRAM:
        raise ValueError(f"length must be at least {REACH + GRAM}")
    docs = df.select("doc_id", row_key().alias("dkey"), "text")
    spans_ = stored(_merged(repeated_ranges(docs, length, block), length), "spans")
    joined = docs.join(_listed(spans_, "spans"), "dkey", "left")
    return _removed(joined.select("doc_id", "text", F.coalesce("spans", F.array()).alias("spans")))
