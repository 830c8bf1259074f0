"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

Each match of the split pattern is merged separately. A segment tree over the
byte positions of a piece holds, per node, the leftmost minimum of
(rank, position) over its pairs; the root is the next merge. A merge changes
three leaves (the merged pair, its left neighbour's and the dead right one)
and updates their paths to the root. Pieces are merged in lock-step by length
class, one numpy operation per tree level for all of them.

Rows: every input row gives one output row. A null text counts as empty (no
ids). Repeated rows and ids, nulls in other columns and extra columns do not
matter: only the id and text columns are read. Equal ranks are resolved
leftmost first, as in the public tokenizer library.
"""

from __future__ import annotations

import base64
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from webloom.llm.common import require

#: Distinct pieces whose ids are remembered per Python worker (memory bound only).
CACHE_PIECES = 100_000
#: Characters of texts split at once (a longer text is split alone).
CHARS = 1 << 19
#: Tree cells merged at once.
CELLS = 1 << 18
NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Ranks as arrays: pair table, token bytes. The files hold some 50,000
    tokens, so the object (about 6 MB) is safe to broadcast."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], NONE)
        self.merged = np.append(np.array(merged, dtype=np.int64)[order], NONE)

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)


def merge_pieces(vocab: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(pieces)
    by_size: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        whole = vocab.ranks.get(piece)
        if whole is not None:
            out[i] = whole.to_bytes(4, "little")
        else:
            by_size.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
    for size, members in by_size.items():
        step = max(1, CELLS // (2 * size))
        for lo in range(0, len(members), step):
            part = members[lo:lo + step]
            for i, ids in zip(part, _merge(vocab, [pieces[i] for i in part], size), strict=True):
                out[i] = ids
    return out


def _merge(vocab: Vocabulary, pieces: list[bytes], size: int) -> list[bytes]:
    """Merge pieces of at most ``size`` bytes (a power of two) in lock-step."""
    n = len(pieces)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
    data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), dtype=np.uint8)
    pos = np.arange(size, dtype=np.int64)
    used = pos < lengths[:, None]
    ids = vocab.byte_ids[data].reshape(n, size)
    alive = used.copy()
    tree = np.full((n, 2 * size), NONE, dtype=np.int64)
    pair = vocab.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, size - 1)
    tree[:, size:2 * size - 1] = np.where(used[:, 1:] & (pair != NONE), pair * size + pos[:-1], NONE)
    level = size
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    following = np.tile(pos + 1, (n, 1)).ravel()
    previous = np.tile(pos - 1, (n, 1)).ravel()
    flat, cells, live = ids.ravel(), tree.ravel(), alive.ravel()
    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        best = cells[rows * 2 * size + 1]
        token, at = best // size, best % size
        base = rows * size
        dead = following[base + at]
        after, before = following[base + dead], previous[base + at]
        flat[base + at] = token
        live[base + dead] = False
        following[base + at] = after
        inside = after < lengths[rows]
        previous[(base + after)[inside]] = at[inside]
        right = np.full(len(rows), NONE, dtype=np.int64)
        r = vocab.pair_ranks(token[inside], flat[(base + after)[inside]])
        right[inside] = np.where(r != NONE, r * size + at[inside], NONE)
        has = before >= 0
        left = vocab.pair_ranks(flat[(base + before)[has]], token[has])
        left = np.where(left != NONE, left * size + before[has], NONE)
        root = rows * 2 * size
        cells[root + size + at] = right
        cells[root + size + dead] = NONE
        cells[(root + size + before)[has]] = left
        node = np.concatenate([at, dead, before[has]]) + size
        root = np.concatenate([root, root, root[has]])
        while size > 1 and node[0] > 1:
            node >>= 1
            cells[root + node] = np.minimum(cells[root + 2 * node], cells[root + 2 * node + 1])
        rows = rows[cells[rows * 2 * size + 1] != NONE]
    packed = flat[live].astype("<u4").tobytes()
    ends = np.cumsum(alive.sum(axis=1)) * 4
    return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.split = regex.compile(vocab.pattern).findall
        self.known: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        out, held, size = [], [], 0
        for text in texts:
            if held and size + len(text or "") > CHARS:
                out += self._encode(held)
                held, size = [], 0
            held.append(text)
            size += len(text or "")
        return out + self._encode(held)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        """Only pieces that repeat within the texts are remembered: most
        distinct pieces occur once and would fill the memory."""
        known = self.known
        pieces = [self.split(t) if t else [] for t in texts]
        counts = Counter(chain.from_iterable(pieces))
        ids = {p: known.get(p) for p in counts}
        new = [p for p, found in ids.items() if found is None]
        ids.update(zip(new, merge_pieces(self.vocab, [p.encode() for p in new]), strict=True))
        if len(known) + len(new) > CACHE_PIECES:
            known.clear()
            new = list(ids)
        known.update((p, ids[p]) for p in new if counts[p] > 1)
        get = ids.__getitem__
        return [b"".join(map(get, doc)) for doc in pieces]


def load_vocabulary(spark: SparkSession, path: str, pattern: str):
    """Read the rank file on the driver and broadcast it (its size is that of
    the vocabulary, not of the data); executors need no such file."""
    return spark.sparkContext.broadcast(Vocabulary.load(path, pattern))


def encode(df: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long, ids binary): the ids as little-endian unsigned
    32-bit integers, the layout of token files. No shuffle."""
    require(df, id_col, text_col)
    part = df.select(id_col, text_col)
    kind = part.schema[0].dataType.simpleString()

    def run(batches):
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            ids = encoder.encode_batch(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[id_col, "n_tokens", "ids"])

    return part.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids binary")


def decode(df: DataFrame, vocabulary) -> DataFrame:
    """Add ``decoded`` (binary) to the columns of a frame with ``ids``; a
    column of that name is replaced, null ids decode to no bytes."""
    require(df, "ids")
    part = df.drop("decoded")
    at = part.columns.index("ids")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema]

    def run(batches):
        token = vocabulary.value.tokens.__getitem__
        for batch in batches:
            out = [b"".join(map(token, np.frombuffer(x or b"", dtype="<u4").tolist()))
                   for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return part.mapInArrow(run, ", ".join([*fields, "decoded binary"]))
