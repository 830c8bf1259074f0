"""Fuzzy line deduplication by MinHash.

Lines (split at newlines, outer blanks trimmed) are compared by the Jaccard
similarity of their sets of character shingles (``k`` = 5 characters, as 64-bit
hashes); a line shorter than a shingle is one shingle. At a threshold of 0.8 one
changed character inside a line keeps it linked from 49 characters on (99 with
k = 10); shorter lines differ too much by this measure. Signatures are banded so that a pair at the threshold shares
a band with high probability (``bands`` = 16 of ``rows`` = 5: 0.998 at 0.8,
0.9999 at 0.85; at k = 5 unrelated lines share too many bands of 3); lines that share a band are compared exactly, every pair of
a bucket once; the links form components by distributed
union-find, and of each component only the first occurrence stays. Equal
lines are one line with several occurrences and need no comparison.

Band keys are found shared within hash ranges: a task sends each range its
keys, line hashes and sketches as plain arrays, which are sorted there. A sketch
is a bit of each of SKETCH values of the signature. Buckets are sieved by
sketches where they are found: a line stays in a bucket if another line there
agrees in at least LEAST bits (a pair at 0.8 that shares a band misses that about
once in a million times; unrelated lines that share a band by chance seldom have
it), and only then becomes a row. A bucket is named by its members, so equal
buckets, as near-equal lines make in most bands, are one. Then texts are
compared, exactly. A bucket larger than BLOCK members is split into blocks that
are sieved in tasks of their own. Only ids, hashes, sketches and positions are
shuffled, the texts of lines only where they are compared, and each document once
to take its lines out.

Rows: one output row per input row, with all columns; ``text`` loses the lines,
the others stay in order and unchanged. Order of occurrences: doc_id (nulls last), a hash of the row,
line number. Blank lines are kept. A null text stays null, an empty one empty;
a text may lose all its lines and is then empty. Rows equal in doc_id and text
are one document: they lose the same lines. Extra columns that bear the names
of results (n_lines, n_dropped) are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import per_group, require, row_key, small_enough, stored
from webloom.llm.components import blocked, components
from webloom.llm.hashing import BASE, distinct, minhash, mix, mix_in, multipliers, prefix, spans

BLANKS = " \t\r"
BLOCK = 256
#: Hashes of lines already seen by a task, so that it sends a common line once.
SEEN = 500_000
#: Members up to which a bucket is compared pair by pair.
FEW = 8
#: Characters hashed at once.
CHARS = 1 << 17
#: Windows hashed at once, so that they stay in the cache.
CACHED = 1 << 14
#: Keys a task holds before it sends them; keys for each hash range.
KEYS, RANGE_KEYS = 1 << 19, 1 << 19
#: Values of a sketch, and how many two lines must share to be compared.
SKETCH, LEAST = 64, 45


def trimmed(line: Column) -> Column:
    """The line without outer blanks. ``btrim`` walks over every character, so
    it is left to the lines that begin or end with a blank."""
    outer = [line.startswith(b) | line.endswith(b) for b in BLANKS]
    return F.when(outer[0] | outer[1] | outer[2], F.btrim(line, F.lit(BLANKS))).otherwise(line)


def shingle_hashes(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all lines, and where each line's begin
    (with the end). A line shorter than k is one shingle."""
    lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    data = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    first = np.cumsum(lengths) - lengths
    counts = np.maximum(1, lengths - k + 1)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    # The values of ``spans``, for windows of one size: a sum of k products, mixed.
    codes = np.zeros(len(data) + k, dtype=np.uint64)
    np.add(data, np.uint64(1), out=codes[:len(data)])
    window = np.empty(len(data) + 1, dtype=np.uint64)
    work = np.empty(min(len(window), CACHED), dtype=np.uint64)
    for at in range(0, len(window), CACHED):
        h = window[at:at + CACHED]
        w = work[:len(h)]
        np.add(codes[at:at + len(h)], np.uint64(k), out=h)
        for j in range(1, k):
            np.multiply(codes[at + j:at + j + len(h)], np.uint64(pow(BASE, j, 1 << 64)), out=w)
            h += w
        mix_in(h, w)
    inside = np.ones(len(data) + 1, dtype=bool)
    short = np.flatnonzero(lengths < k)
    inside[-1] = False
    for j in range(1, k):  # windows over the end of a line
        inside[np.maximum(first, first + lengths - j)] = False
    inside[first[short]] = True
    hashes = window[inside]
    if len(short):
        hashes[offsets[short]] = spans(prefix(data), first[short], first[short] + lengths[short])
    return hashes, offsets


def _band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands))
    values = signature.reshape(len(signature), bands, rows).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        out = mix(out + values[:, :, r])
    return out.view(np.int64)


def _sketches(signature: np.ndarray) -> np.ndarray:
    """A bit of each of the first SKETCH values of the signature, in 64 bits. The
    bit depends on all of the value, so different minima agree in half of the cases."""
    bits = (signature[:, :SKETCH] * np.uint32(0x9E3779B1)) >> np.uint32(31)
    packed = np.packbits(bits.astype(np.uint8), axis=1)
    out = np.zeros((len(signature), 8), dtype=np.uint8)
    out[:, :packed.shape[1]] = packed
    return out.view(np.uint64).ravel()


def line_id(line: str) -> bytes:
    """16 bytes that identify a line."""
    return xxhash.xxh3_128_digest(line.encode())


def _lines(batches):
    """(hashes, lines) of the lines of texts, CHARS characters at a time, a
    common line once per task at most while it is remembered."""
    seen: set[int] = set()
    held: dict[int, str] = {}
    size = 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for line in (text or "").split("\n"):
                line = line.strip(BLANKS)
                if not line:
                    continue
                h = xxhash.xxh64_intdigest(line.encode(), 42)
                if h in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(h)
                held[h] = line
                size += len(line)
                if size >= CHARS:
                    yield np.array(list(held), dtype=np.uint64), list(held.values())
                    held, size = {}, 0
    if held:
        yield np.array(list(held), dtype=np.uint64), list(held.values())


def _dealt_bands(texts: DataFrame, k: int, bands: int, rows: int, ranges: int, seed: int) -> DataFrame:
    """(part, keys, lines, sketches): arrays of band keys (32 bits; the part holds
    the others), line hashes and sketches, dealt by key over ``ranges`` parts."""
    seeds = multipliers(bands * rows, seed)

    def run(batches):
        held: list[tuple] = []

        def flush():
            keys, lines, sketches = (np.concatenate(x) for x in zip(*held, strict=True))
            part = ((keys >> np.uint64(32)) % np.uint64(ranges)).ravel()
            order = np.argsort(part.astype(np.uint16 if ranges <= 1 << 16 else np.int64), kind="stable")
            part, keys, line = part[order], keys.ravel()[order].astype(np.uint32), order // bands
            lines, sketches = lines[line], sketches[line]
            start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            stop = np.append(start[1:], len(part))
            return pa.RecordBatch.from_arrays(
                [pa.array(part[start].astype(np.int32)),
                 *(pa.array([x[i:j].tobytes() for i, j in zip(start, stop, strict=True)], pa.binary()) for x in (keys, lines, sketches))],
                names=["part", "keys", "lines", "sketches"])

        size = 0
        for h, lines in _lines(batches):
            signature = minhash(*shingle_hashes(lines, k), seeds)
            keys = _band_keys(signature, bands, rows)
            held.append((keys.view(np.uint64), h, _sketches(signature)))
            size += keys.size
            if size >= KEYS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return texts.select("text").mapInArrow(run, "part int, keys binary, lines binary, sketches binary")


def _partners(sketches: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which members of buckets (runs of rows; ``end`` of each row's) have a
    partner by their sketches."""
    near = np.zeros(len(sketches), dtype=bool)
    at, step = np.arange(len(sketches)), 1
    while len(at := at[at + step < end[at]]):
        agree = at[np.bitwise_count(sketches[at] ^ sketches[at + step]) <= SKETCH - LEAST]
        near[agree] = near[agree + step] = True
        step += 1
    return near


def _shared_bands(groups):
    """(band, h, sketch, large): the members of buckets of a part that have a
    partner there; of buckets of more than BLOCK lines all members. The band is a hash of the
    members."""
    for table in groups:
        keys, lines, sketches = (np.frombuffer(b"".join(table[c].to_pylist()), dtype=t) for c, t in (
            ("keys", np.uint32), ("lines", np.uint64), ("sketches", np.uint64)))
        words = np.sort((keys.astype(np.uint64) << np.uint64(32)) | np.arange(len(keys), dtype=np.uint64))
        shared = np.zeros(len(keys), dtype=bool)
        shared[1:] = words[1:] >> np.uint64(32) == words[:-1] >> np.uint64(32)
        shared[:-1] |= shared[1:]
        order = (words[shared] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = order[np.lexsort((lines[order], keys[order]))]
        keys, lines, sketches = keys[order], lines[order], sketches[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])  # the same line from several tasks
        keys, lines, sketches = keys[new], lines[new], sketches[new]
        if not len(keys):
            continue
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(start, len(keys)))
        large = np.repeat(size > BLOCK, size)
        keep = large.copy()
        keep[~large] = _partners(sketches[~large], np.repeat(np.cumsum(np.where(size > BLOCK, 0, size)), size)[~large])
        if not keep.any():
            continue
        keys, lines, sketches, large = keys[keep], lines[keep], sketches[keep], large[keep]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        band = np.repeat(np.add.reduceat(mix(lines + np.uint64(1)), start), np.diff(np.append(start, len(keys))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(band.view(np.int64)), pa.array(lines.view(np.int64)), pa.array(np.where(large, sketches, 0).astype(np.uint64).view(np.int64)),
             pa.array(large)], names=["band", "h", "sketch", "large"])


def _unpacked(batches):
    """Sketches as a byte for each bit."""
    for batch in batches:
        bits = np.unpackbits(batch.column(2).to_numpy().view(np.uint8).reshape(-1, 8), axis=1)[:, :SKETCH]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in bits], pa.binary())],
                                         names=["band", "lid", "sketch"])


def _sieved(groups):
    """The members of blocks that have a partner by their sketches."""
    for group in groups:
        m = group.num_rows
        sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), dtype=np.uint8).reshape(m, SKETCH)
        across = group["block_a"][0].as_py() != group["block_b"][0].as_py()
        block = group["block"].to_numpy()
        near = np.zeros(m, dtype=bool)
        for i in range(m - 1):
            agree = (sketch[i + 1:] == sketch[i]).sum(axis=1) >= LEAST
            if across:
                agree &= block[i + 1:] != block[i]
            near[i] |= agree.any()
            near[i + 1:] |= agree
        if near.any():
            yield from group.select(["band", "block_a", "block_b", "block", "lid"]).filter(pa.array(near)).to_batches()


def local_components(sets: list[np.ndarray], wanted: np.ndarray, threshold: float) -> list[int]:
    """For each set (sorted distinct hashes) the smallest index of its
    component under Jaccard >= threshold. Components grow from a member: it is
    compared with the members outside of any component only, so each wanted
    pair is either compared or joined already, and a bucket of near-equal lines
    takes one pass, not one for each pair."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    starts = np.cumsum(size) - size
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(column.max()) + 1, dtype=np.int32)
    fits = np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :])
    wanted = (wanted | wanted.T) & fits
    free = np.ones(m, dtype=bool)
    low = list(range(m))
    for root in range(m):
        if not free[root]:
            continue
        free[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            others = np.flatnonzero(wanted[i] & free)
            if not len(others):
                continue
            own = column[starts[i]:starts[i] + size[i]]
            mark[own] = 1
            if len(others) * 4 < m:
                common = np.array([mark[column[starts[j]:starts[j] + size[j]]].sum() for j in others])
            else:
                common = np.add.reduceat(mark[column], starts)[others]
            mark[own] = 0
            for j in others[common >= threshold * (size[i] + size[others] - common)].tolist():
                free[j] = False
                low[j] = root
                queue.append(j)
    return low


def _few_components(sets: list[np.ndarray], wanted: list[tuple[int, int]], threshold: float) -> list[int]:
    """``local_components`` of a few sets, pair by pair."""
    low = list(range(len(sets)))
    for i, j in wanted:
        a, b = len(sets[i]), len(sets[j])
        if low[i] == low[j] or min(a, b) < threshold * max(a, b):
            continue
        union = len(distinct(np.concatenate([sets[i], sets[j]])))
        if a + b - union >= threshold * union:
            to, gone = min(low[i], low[j]), max(low[i], low[j])
            low = [to if x == gone else x for x in low]
    return low


def _wanted(group: pa.Table) -> list[tuple[int, int]] | np.ndarray | None:
    """The pairs of a group to compare: those that share no lower band and, of
    two blocks, one member of each. A list for FEW members, else a matrix."""
    m, band = group.num_rows, group["band"][0].as_py()
    block = group["block"].to_pylist() if group["block_a"][0].as_py() != group["block_b"][0].as_py() else None
    if m <= FEW:
        sets = [{b for b in bands if b < band} for bands in group["shared"].to_pylist()]
        return [(i, j) for i in range(m) for j in range(i + 1, m)
                if sets[i].isdisjoint(sets[j]) and (block is None or block[i] != block[j])] or None
    shared = group["shared"].combine_chunks()
    at = shared.offsets.to_numpy()
    values, row = shared.values.to_numpy()[at[0]:at[-1]], np.repeat(np.arange(m), np.diff(at))
    below = values < band
    number, column = np.unique(values[below], return_inverse=True)
    met = np.zeros((m, max(1, len(number))), dtype=np.float32)
    met[row[below], column] = 1
    wanted = np.triu((met @ met.T) == 0, 1)
    if block is not None:
        wanted &= np.not_equal.outer(block, block)
    return wanted if wanted.any() else None


def _whole_groups(batches):
    """The rows of a partition that is sorted by its first three columns, in
    tables of whole groups with CHARS characters of lines or more, each with the start of its groups."""
    def key(batch, i):
        return [batch.column(c)[i].as_py() for c in range(3)]

    def cut(table):
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for c in range(3):
            values = table.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("line").nbytes
        if size >= CHARS and key(held[0], 0) != key(batch, batch.num_rows - 1):
            table = pa.Table.from_batches(held)
            starts = cut(table)
            yield table.slice(0, starts[-1]), starts[:-1]
            held = table.slice(starts[-1]).to_batches()
            size = sum(b.column("line").nbytes for b in held)
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start[i] .. start[i] + size[i] - 1, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _numbered(number: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """Sorted 64-bit words of a number below ``n`` and the upper bits of a value, and how many bits the value has."""
    bits = 64 - max(1, (n - 1).bit_length())
    return np.sort((number.astype(np.uint64) << np.uint64(bits)) | (values >> np.uint64(64 - bits))), bits


def _pairs(table: pa.Table, start: np.ndarray, size: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows to compare within the given small groups: those that share
    no lower band and whose sets (``counts``) are not too different in size."""
    end = np.repeat(start + size, size)
    row, one, other = _ragged(start, size), [], []
    for d in range(1, FEW):
        inside = row + d < end
        row, end = row[inside], end[inside]
        one.append(row)
        other.append(row + d)
    one, other = np.concatenate(one), np.concatenate(other)
    fits = np.minimum(counts[one], counts[other]) >= threshold * np.maximum(counts[one], counts[other])
    one, other = one[fits], other[fits]
    shared = table["shared"].combine_chunks()
    at, values, band = shared.offsets.to_numpy(), shared.values.to_numpy(), table["band"].to_numpy()
    lower = np.add.reduceat(values[at[0]:at[-1]] < np.repeat(band, np.diff(at)), at[:-1] - at[0], dtype=np.int64)
    met = np.zeros(len(one), dtype=bool)
    for p in np.flatnonzero((lower[one] > 0) & (lower[other] > 0)).tolist():
        i, j = one[p], other[p]
        both = set(values[at[i]:at[i + 1]].tolist()).intersection(values[at[j]:at[j + 1]].tolist())
        met[p] = min(both) < band[i]
    return one[~met], other[~met]


def _linked(one: np.ndarray, other: np.ndarray, sets: np.ndarray, at: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets (sets[at[i]:at[i] + counts[i]], distinct values) reach the threshold."""
    a, b = counts[one], counts[other]
    pair = np.arange(len(one))
    words, bits = _numbered(np.concatenate([np.repeat(pair, a), np.repeat(pair, b)]),
                            sets[np.concatenate([_ragged(at[one], a), _ragged(at[other], b)])], len(one))
    common = np.bincount((words[1:][words[1:] == words[:-1]] >> np.uint64(bits)).astype(np.int64), minlength=len(one))
    return common >= threshold * (a + b - common)


def _compare(batches, k: int, threshold: float):
    """Of each group, the ids of its lines that are linked within it, with that
    of the first line of their local component. A pair is compared in the
    lowest band that both lines have. Many groups are compared at once: the lines
    are hashed together, and the sets of all pairs of groups of up to FEW lines are
    sorted as one array."""
    for table, start in _whole_groups(batches):
        n, lines = table.num_rows, table["line"].to_pylist()
        size = np.diff(np.append(start, n))
        hashes, offsets = shingle_hashes(lines, k)
        words, bits = _numbered(np.repeat(np.arange(n), np.diff(offsets)), hashes, n)
        words = words[np.concatenate([[True], words[1:] != words[:-1]])]
        counts = np.bincount((words >> np.uint64(bits)).astype(np.int64), minlength=n)
        at = np.cumsum(counts) - counts
        sets = words << np.uint64(64 - bits)
        low = list(range(n))
        across = table["block_a"].to_numpy()[start] != table["block_b"].to_numpy()[start]
        few = (size <= FEW) & (size > 1) & ~across
        if few.any():
            one, other = _pairs(table, start[few], size[few], counts, threshold)
            if len(one):
                linked = _linked(one, other, sets, at, counts, threshold)
                for i, j in zip(one[linked].tolist(), other[linked].tolist(), strict=True):
                    while low[i] != i:
                        i = low[i]
                    while low[j] != j:
                        j = low[j]
                    low[max(i, j)] = min(i, j)
        for first, m in zip(start[~few].tolist(), size[~few].tolist(), strict=True):
            wanted = _wanted(table.slice(first, m)) if m > 1 else None
            if wanted is not None:
                own = [sets[at[i]:at[i] + counts[i]] for i in range(first, first + m)]
                low[first:first + m] = [first + x for x in (_few_components if m <= FEW else local_components)(own, wanted, threshold)]
        gone = [i for i in range(n) if low[i] != i]
        for i in gone:  # a smaller row is settled before
            low[i] = low[low[i]]
        yield pa.RecordBatch.from_arrays([pa.array([line_id(lines[i]) for i in gone], pa.binary()),
                                          pa.array([line_id(lines[low[i]]) for i in gone], pa.binary())],
                                         names=["a", "b"])


def line_links(docs: DataFrame, n_lines: int, threshold: float, k: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(a, b): links between different lines (16-byte ids) that connect every
    component of the lines with similarity of at least ``threshold``.
    ``n_lines`` (about the lines of all texts) sets the number of hash ranges."""
    shared = stored(per_group(_dealt_bands(docs, k, bands, rows, 1 + n_lines * bands // RANGE_KEYS, seed), ["part"], [], _shared_bands,
                              "band bigint, h bigint, sketch bigint, large boolean").distinct(), "line-buckets")
    keys, whole = ["band", "block_a", "block_b"], F.lit(0)
    near = shared.where("not large").select("band", whole.alias("block_a"), whole.alias("block_b"), whole.alias("block"), "h")
    large = shared.where("large").select("band", "h", "sketch")
    if large.limit(1).count():
        members = large.mapInArrow(_unpacked, "band bigint, lid bigint, sketch binary")
        sieved = per_group(blocked(stored(members, "line-members"), "band", "lid", BLOCK), keys, [], _sieved,
                           "band bigint, block_a int, block_b int, block int, lid bigint")
        near = near.unionByName(sieved.withColumnRenamed("lid", "h"))
    # One row for each line, with the buckets and blocks that it is compared in.
    near = stored(near.groupBy("h").agg(F.collect_set("band").alias("shared"), F.collect_set(
        F.struct("band", "block_a", "block_b", "block")).alias("cells")), "line-partners")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).select(trimmed(F.col("line")).alias("line"))
    texts = (lines.select(F.xxhash64("line").alias("h"), "line").join(small_enough(near.select("h")), "h", "left_semi")
             .groupBy("h").agg(F.collect_set("line").alias("lines")))
    compared = (texts.join(near, "h").select("shared", "cells", F.explode("lines").alias("line"))
                .select("shared", "line", F.explode("cells").alias("cell")).select("cell.*", "line", "shared"))
    return (compared.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda b: _compare(b, k, threshold), "a binary, b binary").distinct())


def _places(docs: DataFrame) -> DataFrame:
    """(doc_id, dkey, line_no, lid) of the lines that are not blank."""
    def run(batches):
        for batch in batches:
            row, number, lid = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for j, line in enumerate(text.split("\n")):
                    line = line.strip(BLANKS)
                    if line:
                        row.append(i)
                        number.append(j)
                        lid.append(line_id(line))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()),
                                              pa.array(lid, pa.binary())], names=["doc_id", "dkey", "line_no", "lid"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("dkey", T.BinaryType()), T.StructField("line_no", T.IntegerType()),
                           T.StructField("lid", T.BinaryType())])
    return docs.select("doc_id", row_key().alias("dkey"), "text").mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, threshold: float = 0.8, k: int = 5, bands: int = 16, rows: int = 5,
                seed: int = 11) -> DataFrame:
    """The documents with ``text`` reduced, n_lines (lines that are not blank)
    and n_dropped; see module."""
    require(docs, "doc_id", "text")
    texts = docs.select("doc_id", "text").where("text is not null")
    places = stored(_places(texts), "line-places")
    joined = components(line_links(texts, places.count(), threshold, k, bands, rows, seed), "line-components")
    joined = stored(joined.withColumnRenamed("node", "lid"), "joined-lines")
    repeated = places.groupBy("lid").agg(F.count("*").alias("n")).where("n > 1").select("lid")
    special = stored(repeated.union(joined.select("lid")).distinct(), "repeated-lines")
    marked = stored(places.join(small_enough(special), "lid"), "repeated-places")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "dkey", "line_no")
    lines = marked.groupBy("lid").agg(F.min(place).alias("first")).join(joined, "lid", "left")
    keepers = lines.where("root is not null").groupBy("root").agg(F.min("first").alias("keeper"))
    lines = lines.join(keepers, "root", "left").select("lid", F.coalesce("keeper", "first").alias("keeper"))
    dropped = (marked.join(lines, "lid")
               .where((F.col("dkey") != F.col("keeper.dkey")) | (F.col("line_no") != F.col("keeper.line_no")))
               .groupBy("dkey").agg(F.collect_set("line_no").alias("dropped")))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    gone = F.col("__dropped")
    all_lines = F.split("text", "\n")
    kept = F.array_join(F.filter(all_lines, lambda line, i: ~F.array_contains(gone, i)), "\n")
    return (docs.select(*rest, row_key().alias("__key"))
            .join(dropped.select(F.col("dkey").alias("__key"), F.col("dropped").alias("__dropped")).hint("shuffle_hash"),
                  "__key", "left")
            .select(*[F.when(gone.isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c)
                      for c in rest],
                    F.coalesce(F.size(F.filter(all_lines, lambda line: F.ltrim(line, F.lit(BLANKS)) != "")),
                               F.lit(0)).cast("bigint").alias("n_lines"),
                    F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias("n_dropped")))
