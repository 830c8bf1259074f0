"""Hard-negative mining with anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster with center c whose members
lie within the angle t of it, a candidate x at the angle a from c cannot score
more than |m| |x| cos(max(0, a - t)) with any member m. So the cluster sorts the
candidates once by |x| cos(max(0, a - t)); every member walks that one list from
the top and stops where |m| times the bound is below what it already has: the
rest is certified to be worse, no score is missed. The walk is done twice: for
the positives of each anchor (its ``positives`` best rows of the same label),
then for the negatives (of each positive the ``negatives`` best rows of another
label that score between ``low`` and ``high`` percent of it).

Lists are cut into blocks of candidates (by a hash, so a common vector or label
is spread), and clusters are packed into batches of anchors; a task walks the
lists of one block and batch. The first block goes first; what it gives bounds
the walks of all others. Stopping saves work only: results are exact for any
clustering, which is fitted on at most ``sample`` anchors.

Rows: rows with a null vec_id, label or vector or with a null, NaN or infinite
component take no part. Components become floor(256 * x), scores are integers
(exact below 2^52 in size). Vectors of unequal length are compared as if the
shorter one ended in zeros. Repeated rows are rows of their own, as anchors too,
and each other's candidates. Equal scores go by vec_id; an anchor without rows of
its label, or without rows in the range, gives no output row, and an empty
table none. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import per_group, require, stored

#: Candidates of a block, anchors of a batch, candidates scored at a step of a walk.
BLOCK, BATCH, STRIDE = 1024, 2048, 128
#: Hits of a walk beyond which all but the best are dropped.
HELD = 1 << 19
NONE = -(1 << 62)


def vectors(df: DataFrame, label: Column | None = None) -> DataFrame:
    """(uid, vec_id, label, x): the rows that take part, with integer
    components, filled up with zeros to the longest vector."""
    require(df, "vec_id", "label", "embedding")
    fit = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                   & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fit)
    rows = stored(rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col("label") if label is None else label).cast("bigint").alias("label"),
        F.transform("embedding", lambda c: F.floor(c.cast("double") * 256).cast("bigint")).alias("x")), "vectors")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x"))))


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.maximum(norm, 1e-300)[:, None], norm


def centers(anchors: DataFrame, sample: int, seed: int = 3) -> np.ndarray:
    """Directions fitted by spherical k-means on at most ``sample`` anchors, about half the root of their number."""
    rows = anchors.orderBy(F.xxhash64("uid", F.lit(seed)), "uid").limit(sample).select("x").collect()
    x = np.array([r.x for r in rows], dtype=np.float64).reshape(len(rows), len(rows[0].x) if rows else 1)
    u, _ = _units(x)
    k = max(1, int(np.sqrt(len(rows)) / 2))
    c = u[:k].copy()
    for _ in range(8 if len(rows) else 0):
        near = np.argmax(u @ c.T, axis=1)
        for i in range(k):
            if (near == i).any():
                c[i] = u[near == i].sum(axis=0)
        c, _ = _units(c)
    return c


def _clustered(anchors: DataFrame, c: np.ndarray) -> DataFrame:
    def run(batches):
        for b in batches:
            x = _matrix(b.column("x"), b.num_rows)
            near = np.argmax(_units(x)[0] @ c.T, axis=1) if x.size else np.zeros(b.num_rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32))], names=[*b.schema.names, "cluster"])

    return anchors.mapInArrow(run, "uid bigint, vec_id bigint, label bigint, x array<bigint>, cluster int")


def _batched(anchors: DataFrame) -> DataFrame:
    """Adds ``batch``: small clusters share one, a large one is dealt over several by a hash."""
    spark = anchors.sparkSession
    sizes = anchors.groupBy("cluster").count().orderBy("cluster").collect()  # one row a cluster: half the root of the sample
    plan, batch, used = [], 0, 0
    for row in sizes:
        parts = -(-row["count"] // BATCH)
        if used and (parts > 1 or used + row["count"] > BATCH):
            batch, used = batch + 1, 0
        plan.append((row["cluster"], batch, parts))
        batch, used = (batch + parts, 0) if parts > 1 else (batch, used + row["count"])
    table = spark.createDataFrame(plan, "cluster int, first int, parts int")
    return (anchors.join(F.broadcast(table), "cluster")
            .withColumn("batch", (F.col("first") + F.pmod(F.xxhash64("uid"), F.col("parts"))).cast("int"))
            .drop("first", "parts"))


def _matrix(column, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, len(flat) // max(1, n))


def _best(member: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best hits of each member: larger score, then smaller vec_id."""
    order = np.lexsort((vec_id, -score, member))
    owner = member[order]
    first = np.searchsorted(owner, owner, side="left")
    return order[np.arange(len(order)) - first < k]


def _walk(own: dict, lists: dict, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int, same: bool):
    """The k best candidates of each member (of ``own``) and each of its ranges
    [low, high] (matrices of a column a range) with at least ``floor``: arrays member, range, candidate, score."""
    u, norm = _units(own["x"])
    c = u.sum(axis=0)
    c = c / max(np.sqrt((c * c).sum()), 1e-300)
    spread = np.arccos(np.clip(u[norm > 0] @ c, -1, 1)).max(initial=0.0)
    cu, cnorm = _units(lists["x"])
    bound = cnorm * np.cos(np.clip(np.arccos(np.clip(cu @ c, -1, 1)) - spread - 1e-6, 0, np.pi))
    order = np.argsort(-bound, kind="stable")
    slack = 0.5 + 1e-9 * norm * cnorm.max(initial=0.0)
    floor = np.maximum(floor, low)
    m, ranges = floor.shape
    best = np.full((ranges, m, k), NONE, dtype=np.int64)
    active = np.arange(m)
    hits: list[list[np.ndarray]] = [[], [], [], []]

    def cut():
        member, rank, cand, score = (np.concatenate(h) if h else np.zeros(0, dtype=np.int64) for h in hits)
        keep = _best(member * ranges + rank, score, lists["vec_id"][cand], k)
        hits[:] = [[a[keep]] for a in (member, rank, cand, score)]
        return len(keep)

    held = 0
    for at in range(0, len(order), STRIDE):
        reach = norm[active] * bound[order[at]] + slack[active]
        active = active[(reach[:, None] >= floor[active]).any(axis=1)]
        if not len(active):
            break
        some = order[at:at + STRIDE]
        score = np.rint(own["x"][active] @ lists["x"][some].T).astype(np.int64)
        label = own["label"][active][:, None] == lists["label"][some][None, :]
        usable = (label & (own["uid"][active][:, None] != lists["uid"][some][None, :])) if same else ~label
        for j in range(ranges):
            hit = usable & (score >= floor[active, j][:, None]) & (score <= high[active, j][:, None])
            i, s = np.nonzero(hit)
            if not len(i):
                continue
            for h, v in zip(hits, (active[i], np.full(len(i), j), some[s], score[i, s]), strict=True):
                h.append(v)
            held += len(i)
            found = np.where(hit, score, NONE)
            merged = np.concatenate([best[j, active], found], axis=1)
            best[j, active] = -np.partition(-merged, k - 1, axis=1)[:, :k]
            floor[active, j] = np.maximum(floor[active, j], best[j, active].min(axis=1))
        if held > HELD:
            held = cut()
    cut()
    return [h[0] for h in hits]


def _walks(groups, k: int, same: bool):
    """Hits (uid of the anchor, range, uid and vec_id of the candidate, score) of a block and batch."""
    for table in groups:
        kind = table["kind"].to_numpy()
        x = _matrix(table["x"], len(kind))
        row = {n: table[n].to_numpy() for n in ("uid", "vec_id", "label", "cluster")} | {"x": x}
        lists = {n: v[kind == 1] for n, v in row.items()}
        limits = [table[n].combine_chunks().filter(pa.array(kind == 0)).to_pylist() for n in ("low", "high", "floor")]
        members = {n: v[kind == 0] for n, v in row.items()}
        for cluster in np.unique(members["cluster"]):
            of = np.flatnonzero(members["cluster"] == cluster)
            own = {n: v[of] for n, v in members.items()}
            given = [[limit[i] for i in of] for limit in limits]
            width = max(len(g) for g in given[0])
            if not width or not len(lists["uid"]):
                continue
            # A member with fewer ranges gets impossible ones; they end no later than the others.
            low, high, floor = (np.array([g + [fill] * (width - len(g)) for g in part], dtype=np.int64)
                                for part, fill in zip(given, (-NONE, NONE, -NONE), strict=True))
            member, rank, cand, score = _walk(own, lists, low, high, floor, k, same)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own["uid"][member]), pa.array(rank.astype(np.int32)), pa.array(lists["uid"][cand]),
                 pa.array(lists["vec_id"][cand]), pa.array(score)],
                names=["anchor", "place", "found_uid", "found", "score"])


def _search(anchors: DataFrame, rows: DataFrame, blocks: int, k: int, same: bool, name: str) -> DataFrame:
    """The k best hits of each range of each anchor: (anchor, place, found_uid,
    found, score, nth). ``anchors`` has arrays low, high: its ranges."""
    limits = ("low", "high", "floor")
    candidates = rows.select(F.pmod(F.xxhash64("uid", F.lit(5)), F.lit(blocks)).cast("int").alias("block"), "uid", "vec_id",
                             "label", "x")
    batches = (anchors.agg(F.max("batch")).first()[0] or 0) + 1
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "found", "found_uid")

    def walked(asked: DataFrame, first: int, last: int) -> DataFrame:
        dealt = (asked.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last))))
                 .select("block", "batch", F.lit(0).alias("kind"), "uid", "vec_id", "label", "cluster", "x", *limits))
        met = (candidates.where(F.col("block").between(first, last))
               .withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
               .select("block", "batch", F.lit(1).alias("kind"), "uid", "vec_id", "label", F.lit(-1).alias("cluster"), "x",
                       *[F.lit(None).cast("array<bigint>").alias(c) for c in limits]))
        hits = per_group(dealt.unionByName(met), ["block", "batch"], ["kind"], lambda g: _walks(g, k, same),
                         "anchor bigint, place int, found_uid bigint, found bigint, score bigint")
        return stored(hits, name)

    none = F.transform("low", lambda _: F.lit(NONE).cast("bigint"))
    hits = walked(anchors.withColumn("floor", none), 0, 0)
    if blocks > 1:
        last = F.when(F.count("*") >= k, F.min("score"))  # the k-th best of the first block
        known = (hits.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
                 .groupBy("anchor", "place").agg(last.alias("least")).where("least is not null")
                 .groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("known")))
        asked = (anchors.join(known, F.col("uid") == F.col("anchor"), "left")
                 .withColumn("floor", F.transform("low", lambda _, i: F.coalesce(F.col("known")[i], F.lit(NONE).cast("bigint")))))
        hits = hits.unionByName(walked(asked, 1, blocks - 1))
    return stored(hits.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k), f"{name}-best")


def mine(df: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, sample: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); see module. ``is_anchor`` is a condition on vec_id,
    ``label`` an expression that replaces the label."""
    rows = stored(vectors(df, label), "integer-vectors")
    anchors = rows.where(is_anchor)
    anchors = stored(_batched(stored(_clustered(anchors, centers(anchors, sample)), "clustered-anchors")), "anchors")
    blocks = max(1, -(-rows.count() // BLOCK))
    everything = anchors.withColumn("low", F.array(F.lit(NONE).cast("bigint"))).withColumn("high", F.array(F.lit(-NONE).cast("bigint")))
    best = _search(everything, rows, blocks, positives, True, "positives")
    # Floors and ceilings of low% and high% of the score; integers of either sign.
    ranges = (best.select("anchor", "nth", F.expr(f"-floor(-({low} * score) / 100)").cast("bigint").alias("least"),
                          F.expr(f"floor({high} * score / 100)").cast("bigint").alias("most"))
              .groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "least", "most"))).alias("ranges")))
    asked = (anchors.join(ranges, F.col("uid") == F.col("anchor"))
             .withColumn("low", F.col("ranges.least")).withColumn("high", F.col("ranges.most")).drop("ranges", "anchor"))
    found = _search(stored(asked, "ranges"), rows, blocks, negatives, False, "negatives")
    own = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (found.join(best.select("anchor", (F.col("nth") - 1).alias("place"), F.col("found").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["anchor", "place"]).join(own, "anchor")
            .select("anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("found").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
