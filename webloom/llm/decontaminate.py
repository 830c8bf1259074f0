"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every window of 10 words the smallest hash of its six 5-grams is kept, once
per run of windows with the same minimum. A passage of 10 words shared by a
document and an item has the same minimum in both, so joining the kept
fingerprints finds every shared passage. A hit is then extended to the windows
of its run, whose words are compared with the item windows themselves: results
are exact. Items of fewer than 10 words are one window, found by the hash of
their whole word sequence.

Words are maximal runs of 0-9, a-z and non-ASCII characters after lower-casing
A-Z. The fingerprints of the benchmark are broadcast only after counting them
(FINGERPRINTS); beyond that both sides are shuffled by fingerprint.

Rows: one output row per document row. Null and empty texts have no words; a
null item has none either. Repeated items count once (by item_id); a null
item_id is listed as ``null``. Repeated document rows give equal rows. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import require, row_key, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window, words of a hashed gram, grams per window.
WINDOW, GRAM = 10, 5
GRAMS = WINDOW - GRAM + 1
#: Most benchmark fingerprints that may be broadcast (8 bytes and a few integers each).
FINGERPRINTS = 1_000_000


def words(text: Column) -> Column:
    # lower() has a fast path and equals the A-Z mapping on ASCII texts.
    small = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(small, F.lit(WORD), F.lit(0))


def _range(low: int, high: Column) -> Column:
    return F.when(high >= low, F.sequence(F.lit(low), high)).otherwise(F.array().cast("array<int>"))


def _whole(size: int) -> Column:
    """The hash of every ``size`` consecutive words."""
    return F.transform(_range(0, F.col("n_words") - size), lambda i: F.struct(
        F.xxhash64(F.lit(size), *[F.get("h", i + j) for j in range(size)]).alias("hash"), i.alias("from"),
        i.alias("to"), F.lit(size).alias("size")))


def fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Add ``n_words`` and ``prints``: array of (hash, from, to, size), the
    windows of ``size`` words that start at from..to (0-based). ``df`` has
    ``words``. Each step is a column of its own: what a later lambda indexes
    is computed once per row."""
    df = (df.withColumn("n_words", F.size("words"))
          .withColumn("h", F.transform("words", lambda w: F.xxhash64(w))))
    # Explode the result with explode_outer: for explode the optimizer infers a filter and
    # pushes it through these steps, which repeats them many times over.
    df = df.withColumn("g", F.transform(_range(0, F.col("n_words") - GRAM), lambda i: F.xxhash64(
        *[F.get("h", i + j) for j in range(GRAM)])))
    df = df.withColumn("m", F.transform(_range(0, F.col("n_words") - WINDOW), lambda i: F.least(
        *[F.get("g", i + j) for j in range(GRAMS)])))
    df = df.withColumn("s", F.filter(_range(0, F.col("n_words") - WINDOW), lambda i: (
        (i == 0) | (F.get("m", i) != F.get("m", i - 1)))))
    runs = F.transform("s", lambda at, j: F.struct(
        F.get("m", at).alias("hash"), at.alias("from"),
        (F.coalesce(F.get("s", j + 1), F.col("n_words") - WINDOW + 1) - 1).alias("to"), F.lit(WINDOW).alias("size")))
    lists = [runs]
    lists += [_whole(size) for size in short]
    return df.withColumn("prints", F.concat(*lists)).drop("h", "g", "m", "s")


def _text(array: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(array, start + 1, size), " ")


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """(fingerprints: hash and size; windows: size, window, item ids; the word
    counts below WINDOW that occur)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             words(F.coalesce("text", F.lit(""))).alias("words")).where(F.size("words") > 0)
    items = stored(items, "benchmark-words")
    short = sorted(r[0] for r in items.where(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())
    whole = F.size("words")
    windows = (items.select("item", "words", F.explode(
        F.sequence(F.lit(0), F.greatest(whole - WINDOW, F.lit(0)))).alias("at"), F.least(whole, F.lit(WINDOW)).alias("size"))
        .groupBy("size", _text(F.col("words"), F.col("at"), F.col("size")).alias("window"))
        .agg(F.sort_array(F.collect_set("item")).alias("items")))
    prints = (fingerprints(items, short).select(F.explode_outer("prints").alias("p"), "n_words").select("p.hash", "p.size", "n_words")
              .where((F.col("size") == WINDOW) | (F.col("size") == F.col("n_words"))).select("hash", "size").distinct())
    return stored(prints, "benchmark-prints"), stored(windows, "benchmark-windows"), short


def contamination(documents: DataFrame, benchmark: DataFrame, most_broadcast: int = FINGERPRINTS) -> DataFrame:
    """(doc_id, dkey, n_words, n_hit, n_items, items_sha256, contaminated)."""
    require(documents, "doc_id", "text")
    require(benchmark, "item_id", "text")
    prints, windows, short = benchmark_windows(benchmark)
    count = prints.count()
    docs = documents.select("doc_id", row_key().alias("dkey"), words(F.coalesce("text", F.lit(""))).alias("words"))
    printed = fingerprints(docs, short)
    # One more print per document, which matches nothing, keeps documents without hits.
    none = F.array(F.struct(F.lit(None).cast("bigint").alias("hash"), F.lit(-1).alias("from"), F.lit(-1).alias("to"),
                            F.lit(0).alias("size")))
    rows = printed.select("doc_id", "dkey", "n_words", "words", F.explode_outer(F.concat(none, "prints")).alias("p"))
    known = prints.select("hash", "size", F.lit(True).alias("known"))
    on = (F.col("p.hash") == F.col("hash")) & (F.col("p.size") == F.col("size"))
    span = F.slice("words", F.col("p.from") + 1, F.col("p.to") - F.col("p.from") + F.col("p.size"))
    shape = ["doc_id", "dkey", "n_words", F.col("p.from").alias("from"), F.col("p.to").alias("to"), F.col("p.size").alias("size")]
    base = F.col("p.size") == 0
    if count <= most_broadcast:
        hits = rows.join(F.broadcast(known), on, "left").where(base | F.col("known")).select(
            *shape, F.when(~base, span).alias("span"))
    else:
        ids = rows.drop("words").join(known, on, "left").where(base | F.col("known")).select(*shape)
        ids = stored(ids, "hits")
        again = docs.select(F.col("dkey").alias("k"), "words").dropDuplicates(["k"])
        extended = (ids.where("size > 0").join(again, F.col("dkey") == F.col("k")).select(
            "doc_id", "dkey", "n_words", "from", "to", "size",
            F.slice("words", F.col("from") + 1, F.col("to") - F.col("from") + F.col("size")).alias("span")))
        hits = ids.where("size = 0").withColumn("span", F.lit(None).cast("array<string>")).unionByName(extended)
    # Extend each hit to the windows of its run and compare their words.
    tried = hits.withColumn("at", F.explode(F.sequence(F.col("from"), F.col("to")))).select(
        "doc_id", "dkey", "n_words", "at", "size",
        F.when(F.col("size") > 0, _text(F.col("span"), F.col("at") - F.col("from"), F.col("size"))).alias("window"))
    items = windows.select(F.col("window").alias("w"), F.col("size").alias("s"), "items")
    if count <= most_broadcast:
        items = F.broadcast(items)
    matched = tried.join(items, (F.col("window") == F.col("w")) & (F.col("size") == F.col("s")), "left").where(
        (F.col("size") == 0) | F.col("items").isNotNull())
    hit = F.col("size") > 0
    per_doc = matched.groupBy("dkey").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").cast("bigint").alias("n_words"),
        F.sum(F.when(~hit, 1).otherwise(0)).alias("copies"),
        F.sort_array(F.collect_set(F.when(hit, F.struct("at", (F.col("at") + F.col("size")).alias("end"))))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["at"], a["end"]))).alias("n"),
                              F.greatest(a["end"], s["end"]).alias("end")))["n"]
    return (per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "dkey", "n_words", covered.cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated")))
