"""Similarity self-join of documents by the Jaccard similarity of their word
n-grams, by chosen paths.

Documents with equal n-gram sets are one class; classes are joined. A class is
embedded as ``tokens`` MinHash values. At each node of a random recursion a
token is chosen with probability ``branching / tokens``, by a hash of the node
and the token, so similar sets follow the same paths and unrelated ones part.
Buckets of at most LIMIT classes are compared by brute force, and so are
larger ones whose sets are similar on the whole (splitting would only multiply
them), in blocks; the others are split on further tokens, down to ``depth``
levels. The recursion is repeated
``runs`` times; runs are chosen so that a pair at the threshold meets with the
target recall. A pair that meets several times is compared in the bucket with
the lowest path only. MinHash estimates sort out pairs far below the threshold,
the others are decided by their exact n-gram sets.

Only hashes move, and n-gram sets only of classes with a candidate. Rows grow
with documents, not with pairs: buckets yield counts and a spanning forest.
Links of a document: all documents of its class but itself, and those of
every class with similarity of at least the threshold.

Rows: one output row per input row. Texts of fewer than n words, but not none,
are one n-gram. Texts without words (null, empty) have no class: no links,
class_id their own doc_id. ``class_id`` is the smallest doc_id of the component
(nulls last), ``kept`` marks its one row that stays, the first by doc_id and a
hash of the row. Rows equal in doc_id and text are counted as documents but
marked alike. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import per_group, require, row_key, small_enough, stored
from webloom.llm.components import blocked, components
from webloom.llm.hashing import intersections, minhash, mix, multipliers, shingles

LIMIT = 64
BLOCK = 256
SEED = 23
#: MinHash tokens of an embedded set; the estimate's standard error is 0.05 at 0.8.
TOKENS = 64
#: Mean similarity from which a large bucket is compared and not split, and the tokens and members it is estimated by.
DENSE, PROBES, DRAWN = 0.4, 8, 4
#: Candidates may lie this many standard errors below the threshold.
SLACK = 5.0


def runs_for(recall: float, threshold: float, branching: float, depth: int) -> int:
    """Repetitions after which a pair at the threshold has met in a bucket of
    any depth with probability ``recall``: a pair goes on along a Poisson
    number of shared tokens with mean branching * threshold per level."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-branching * threshold * alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def _documents(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, dkey, cls, n_grams, sketch) per document."""
    seeds = multipliers(TOKENS, SEED)
    part = docs.select("doc_id", row_key().alias("dkey"), "text")
    kind = part.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sets = [shingles((t or "").encode(), n) for t in batch.column(2).to_pylist()]
            sizes = np.array([len(s) for s in sets])
            some = np.flatnonzero(sizes)
            sketch, cls = [None] * len(sets), [None] * len(sets)
            if len(some):
                starts = np.concatenate([[0], np.cumsum(sizes[some])])
                mins = minhash(np.concatenate([sets[i] for i in some]), starts, seeds)
                for row, i in enumerate(some.tolist()):
                    sketch[i] = mins[row].tobytes()
                    cls[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cls, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(sketch, pa.binary())], names=["doc_id", "dkey", "cls", "n_grams", "sketch"])

    return part.mapInArrow(run, f"doc_id {kind}, dkey binary, cls binary, n_grams int, sketch binary")


def _choose(nodes: np.ndarray, sketches: np.ndarray, branching: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of the tokens chosen at each row's node."""
    token = sketches.astype(np.uint64) + (np.arange(TOKENS, dtype=np.uint64) << np.uint64(32))
    h = mix(mix(token) + nodes[:, None])
    rows, cols = np.nonzero((h >> np.uint64(32)) < np.uint64(int(branching / TOKENS * (1 << 32))))
    return rows, mix(h[rows, cols] ^ np.uint64(0x5851F42D4C957F2D))


def _paths(rows: DataFrame, branching: float, runs: int | None = None) -> DataFrame:
    """(cls, path): one level of paths; from the roots of all runs, or from
    the ``path`` of each row."""
    roots = mix(np.arange(1, (runs or 0) + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)
            if runs:
                nodes = [np.full(len(sketches), r) for r in roots]
            else:
                nodes = [batch.column(2).to_numpy().view(np.uint64)]
            for node in nodes:
                at, path = _choose(node, sketches, branching)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(path.view(np.int64))],
                                                 names=["cls", "path"])

    columns = ["cls", "sketch"] + ([] if runs else ["path"])
    return rows.select(*columns).mapInArrow(run, "cls binary, path bigint")


def _dense(large: DataFrame) -> DataFrame:
    """(path): large buckets with a mean similarity of at least DENSE, estimated
    by the probed tokens in which members agree with DRAWN ones drawn by hash.
    One row a member is made, whatever the size of the bucket."""
    drawn = large.groupBy("path").agg(*[
        F.min_by("sketch", F.xxhash64("cls", F.lit(i))).alias(f"drawn{i}") for i in range(DRAWN)])

    def token(column, i):
        return F.substring(column, 4 * i + 1, 4)

    agree = sum([(token("sketch", i) == token(f"drawn{j}", i)).cast("int") for i in range(PROBES) for j in range(DRAWN)],
                F.lit(0))
    return (large.join(drawn, "path").groupBy("path").agg(F.avg(agree).alias("mean"))
            .where(F.col("mean") >= DENSE * PROBES * DRAWN).select("path"))


def _leaves(classes: DataFrame, branching: float, runs: int, depth: int) -> DataFrame:
    """(path, cls) of all buckets with two or more classes."""
    level = stored(_paths(classes, branching, runs).distinct(), "paths")
    leaves = None
    for at in range(1, depth + 1):
        counts = level.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        sized = stored(level.join(counts, "path"), "bucket-sizes")
        final = sized if at == depth else sized.where(F.col("n") <= LIMIT)
        final = final.select("path", "cls")
        leaves = final if leaves is None else leaves.unionByName(final)
        large = sized.where(F.col("n") > LIMIT)
        if at == depth or large.isEmpty():
            break
        large = stored(large.join(classes.select("cls", "sketch"), "cls"), "large-buckets")
        dense = stored(_dense(large), "dense-buckets")
        leaves = leaves.unionByName(large.join(dense, "path", "left_semi").select("path", "cls"))
        level = stored(_paths(large.join(dense, "path", "left_anti"), branching).distinct(), "paths")
    return leaves


def _candidates(groups, cut: float):
    """Pairs to verify of each group: of each row, the partners listed after it."""
    for group in groups:
        cls = group["cls"].to_pylist()
        m = len(cls)
        block = group["block"].to_numpy()
        sketches = np.frombuffer(b"".join(group["sketch"].to_pylist()), dtype=np.uint32).reshape(m, TOKENS)
        path = group["path"][0].as_py()
        lists = group["paths"].to_pylist()
        index: dict[int, int] = {}
        earlier = [[index.setdefault(p, len(index)) for p in ps if p < path] for ps in lists]
        met = np.zeros((m, max(1, len(index))), dtype=np.float32)
        for i, ps in enumerate(earlier):
            met[i, ps] = 1
        wanted = (met @ met.T) == 0
        wanted &= np.triu(np.ones((m, m), dtype=bool), 1)
        if group["block_a"][0].as_py() != group["block_b"][0].as_py():
            wanted &= block[:, None] != block[None, :]
        out = []
        for i in np.flatnonzero(wanted.any(axis=1)).tolist():
            others = np.flatnonzero(wanted[i])
            same = (sketches[others] == sketches[i]).mean(axis=1)
            found = others[same >= cut]
            if len(found):
                out.append((i, found.tolist()))
        if not out:
            continue
        partners = [[] for _ in range(m)]
        for i, found in out:
            partners[i] = [cls[j] for j in found]
        used = sorted({i for i, _ in out} | {j for _, found in out for j in found})
        yield pa.RecordBatch.from_arrays(
            [group[c].combine_chunks().take(pa.array(used)) for c in ("path", "block_a", "block_b", "cls", "copies")]
            + [pa.array([partners[i] for i in used], pa.list_(pa.binary()))],
            names=["path", "block_a", "block_b", "cls", "copies", "partners"])


def _verify(groups, threshold: float):
    """Per class of a group: links found here, documents behind them, and the
    smallest class of its local component."""
    for group in groups:
        cls = group["cls"].to_pylist()
        at = {c: i for i, c in enumerate(cls)}
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["grams"].to_pylist()]
        copies = group["copies"].to_pylist()
        common = intersections(sets)
        links, behind, parent = [0] * len(cls), [0] * len(cls), list(range(len(cls)))

        def find(i, parent=parent):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i, partners in enumerate(group["partners"].to_pylist()):
            for j in [at[p] for p in partners]:
                both = common[i, j]
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    links[i] += 1
                    links[j] += 1
                    behind[i] += copies[j]
                    behind[j] += copies[i]
                    a, b = find(i), find(j)
                    parent[a] = b
        kept = [i for i in range(len(cls)) if links[i]]
        if kept:
            low: dict[int, bytes] = {}
            for i in kept:
                r = find(i)
                low[r] = min(low.get(r, cls[i]), cls[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array([cls[i] for i in kept], pa.binary()), pa.array([low[find(i)] for i in kept], pa.binary()),
                 pa.array([links[i] for i in kept], pa.int64()), pa.array([behind[i] for i in kept], pa.int64())],
                names=["cls", "low", "links", "behind"])


def class_links(docs: DataFrame, classes: DataFrame, n: int, threshold: float, branching: float, runs: int,
                depth: int) -> DataFrame:
    """(cls, low, links, behind), partial per bucket."""
    leaves = _leaves(classes, branching, runs, depth)
    leaves = stored(leaves, "leaves")
    own = leaves.groupBy("cls").agg(F.collect_list("path").alias("paths"))
    members = (blocked(leaves, "path", "cls", BLOCK).join(own, "cls")
               .join(classes.select("cls", "sketch", "copies"), "cls"))
    keys = ["path", "block_a", "block_b"]
    cut = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / TOKENS)
    found = stored(per_group(members, keys, ["cls"], lambda g: _candidates(g, cut),
                             "path bigint, block_a int, block_b int, cls binary, copies bigint, partners array<binary>"),
                   "candidates")
    needed = found.select("cls").distinct().join(classes.select("cls", "sample"), "cls")
    needed = small_enough(stored(needed.select("cls", F.col("sample").alias("dkey")), "needed-sets"))
    texts = docs.select(row_key().alias("dkey"), "text").join(needed, "dkey").select("cls", "text")

    def grams(batches):
        for batch in batches:
            out = [shingles(t.encode(), n).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["cls", "grams"])

    sets = (texts.mapInArrow(grams, "cls binary, grams binary").groupBy("cls").agg(F.first("grams").alias("grams")))
    return per_group(found.join(sets, "cls"), keys, ["cls"], lambda g: _verify(g, threshold),
                     "cls binary, low binary, links bigint, behind bigint")


def similar_documents(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.99999,
                      branching: float = 2.0, depth: int = 4) -> DataFrame:
    """(doc_id, dkey, n_grams, class_id, copies, n_links, n_text_links, kept);
    ``dkey`` is the row's hash, n_text_links counts linked classes."""
    require(docs, "doc_id", "text")
    runs = runs_for(recall, threshold, branching, depth)
    rows = stored(_documents(docs, n), "shingled")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "dkey")
    classes = stored(rows.where("cls is not null").groupBy("cls").agg(
        F.count("*").alias("copies"), F.min(first).alias("first"), F.min("dkey").alias("sample"),
        F.first("sketch").alias("sketch")), "classes")
    found = stored(class_links(docs, classes, n, threshold, branching, runs, depth), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"), F.sum("behind").alias("behind"))
    joined = components(found.select(F.col("cls").alias("a"), F.col("low").alias("b")), "classes-joined")
    whole = (classes.select("cls", "copies", "first").join(links, "cls", "left")
             .join(joined.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("root", F.coalesce("root", "cls")))
    firsts = whole.groupBy("root").agg(F.min("first").alias("keeper"))
    whole = whole.join(firsts, "root").where("copies > 1 or links > 0").select("cls", "copies", "links", "behind", "keeper")
    out = rows.select("doc_id", "dkey", "cls", "n_grams").join(whole, "cls", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "doc_id", "dkey", "n_grams",
        F.when(F.col("keeper").isNull(), F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"),
        (F.coalesce(F.col("copies") - 1, zero) + F.coalesce("behind", zero)).alias("n_links"),
        F.coalesce("links", zero).alias("n_text_links"),
        (F.col("keeper").isNull() | (F.col("keeper.dkey") == F.col("dkey"))).alias("kept"))
