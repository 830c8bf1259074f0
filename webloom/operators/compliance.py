"""Compliance (G1-G3): rule-based PII redaction and terms-of-service flags.

PII rules and a small lexicon are native expressions. A large lexicon is
indexed by literals that its patterns require, so each text meets only the
patterns it may match."""

from __future__ import annotations

from functools import reduce
from itertools import batched

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Redaction patterns (Java and RE2 compatible) and their tokens,
# applied in this order, each with a cheap necessary condition that lets most
# texts skip the full pattern (exact: no match is possible without it).
PII_RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]", ("contains", "@")),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]", ("rlike", r"\d-\d\d-\d")),
    ("phone", r"(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\b\d{3}[ .-])\d{3}[ .-]\d{4}\b", "[PHONE]",
     ("rlike", r"\d[ .-]\d{4}")),
)
#: Lexicon rows compiled into one expression; a longer lexicon is applied in such blocks.
LEXICON_BLOCK = 1000


def redact_pii(df: DataFrame, text_col: str = "content") -> DataFrame:
    """G1: replaces emails, SSNs and phone numbers (in that order) and counts
    each kind; adds n_email, n_ssn, n_phone, pii_redacted."""
    from webloom.session import spread
    out = spread(df)
    cur = F.col(text_col)
    counts = []
    for kind, pat, token, (how, probe) in PII_RULES:
        maybe = cur.contains(probe) if how == "contains" else cur.rlike(probe)
        n = F.when(maybe, F.regexp_count(cur, F.lit(pat))).otherwise(F.lit(0))
        out = out.withColumn(f"n_{kind}", n.cast("long"))
        cur = F.when(F.col(f"n_{kind}") > 0, F.regexp_replace(cur, pat, token)).otherwise(cur)
        out = out.withColumn(text_col, cur)
        cur = F.col(text_col)
        counts.append(F.col(f"n_{kind}"))
    return out.withColumn("pii_redacted", sum(counts[1:], counts[0]))


def tos_flags(df: DataFrame, lexicon: DataFrame, key_col: str = "url",
              text_col: str = "content") -> DataFrame:
    """(key, clause, severity) for every lexicon pattern found in the
    text. A lexicon of up to LEXICON_BLOCK rows is compiled into one array
    expression; of a larger one each pattern is tried only on the texts that
    have its required literal (``_indexed_flags``). An empty one flags nothing."""
    from webloom.session import spread
    rules = lexicon.select("clause", "pattern", "severity")
    few = rules.limit(LEXICON_BLOCK + 1).collect()
    if len(few) > LEXICON_BLOCK:
        return _indexed_flags(df.select(key_col, text_col), rules, key_col, text_col)
    texts = spread(df.select(key_col, text_col), key_col)
    return _compiled_flags(texts, few, key_col, text_col)


def _compiled_flags(texts: DataFrame, rules, key_col: str, text_col: str) -> DataFrame:
    none = texts.where(F.lit(False)).select(
        key_col, F.lit(None).cast("string").alias("clause"), F.lit(None).cast("string").alias("severity"))
    return reduce(DataFrame.unionByName,
                  [_block_flags(texts, block, key_col, text_col) for block in batched(rules, LEXICON_BLOCK)] or [none])


def _with_grams(rules: DataFrame) -> DataFrame:
    """The rules with the n-gram that stands for their required literal, NULL
    without a literal of three characters."""
    def run(batches):
        import pyarrow as pa

        from webloom.functions.literals import literal_gram, required_literal
        for b in batches:
            grams = [None if p is None else literal_gram(required_literal(p)) for p in b.column("pattern").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(grams, pa.int64())], names=[*b.schema.names, "gram"])

    return rules.mapInArrow(run, "clause string, pattern string, severity string, gram bigint")


def _gram_bitmap(grams: DataFrame) -> bytes:
    """A bitmap of fixed size (BITS bits), set at the hashes of the n-grams."""
    from webloom.functions.literals import BITS
    bit = (F.col("gram").bitwiseAND(F.lit(BITS - 1)) + 1).alias("bit")
    parts = (grams.select(bit).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())  # BITS / 8 bytes at most
    out = bytearray(BITS // 8)
    for r in parts:
        out[(r.bucket - 1) * 4096:(r.bucket - 1) * 4096 + len(r.bits)] = r.bits
    return bytes(out)


def _indexed_flags(df: DataFrame, rules: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """A required-literal index: one pass over the texts looks up all n-grams of
    a text in a bitmap of the patterns' n-grams; those found are joined with the
    patterns they stand for, and only these are matched. Patterns without a
    literal are compiled into expressions, LEXICON_BLOCK at a time."""
    from webloom.session import spread, stored
    rules = stored(_with_grams(rules.where("pattern is not null")), "lexicon")
    indexed = rules.where("gram is not null")
    bitmap = _gram_bitmap(indexed)
    key_type = dict(df.dtypes)[key_col]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from webloom.functions.literals import BITS, GRAMS, gram_hashes
        bits = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), bitorder="little").astype(bool)
        for b in batches:
            found = []
            for text in b.column(1).to_pylist():
                grams = np.concatenate([gram_hashes(text or "", size) for size in GRAMS])
                found.append(np.unique(grams[bits[grams & np.uint64(BITS - 1)]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int64()))], names=["key", "text", "grams"])

    texts = spread(df.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")), "key")
    hits = texts.mapInArrow(run, f"key {key_type}, text string, grams array<bigint>").where("size(grams) > 0")
    hits = stored(hits.withColumn("row", F.monotonically_increasing_id()), "lexicon-hits")
    tried = (hits.select("row", F.explode("grams").alias("gram")).join(indexed, "gram")
             .select("row", "clause", "pattern", "severity"))
    flags = (hits.select("row", "key", "text").join(tried, "row").where(F.expr("text rlike pattern"))
             .select(F.col("key").alias(key_col), "clause", "severity"))
    rest = rules.where("gram is null").select("clause", "pattern", "severity").toLocalIterator()
    return flags.unionByName(_compiled_flags(df, rest, key_col, text_col))


def _block_flags(texts: DataFrame, rules: tuple, key_col: str, text_col: str) -> DataFrame:
    hits = F.filter(F.array(*[
        F.struct(F.lit(r["clause"]).alias("clause"), F.lit(r["severity"]).alias("severity"),
                 F.col(text_col).rlike(r["pattern"]).alias("hit")) for r in rules]),
        lambda x: x["hit"])
    return (texts.select(key_col, F.explode(hits).alias("f"))
            .select(key_col, F.col("f.clause").alias("clause"), F.col("f.severity").alias("severity")))


def compliance_gate(pages: DataFrame, flags: DataFrame, key_col: str = "url"):
    """Per crawl, ``compliant`` (no blocking flag) plus the pages a block
    turns into ``tos`` skips. ``pages``: crawl_id, key; ``flags``: key,
    clause, severity. Returns (summary, tos_skips)."""
    f = flags.groupBy(key_col).agg(
        F.max((F.col("severity") == "block").cast("int")).alias("_block"),
        F.max((F.col("severity") == "warn").cast("int")).alias("_warn"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("severity") == "block",
                                                        F.col("clause")))), ",").alias("_clauses"))
    j = pages.select("crawl_id", key_col).join(f, key_col, "left")
    summary = j.groupBy("crawl_id").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count(F.when(F.col("_block") == 1, 1)).alias("n_blocked"),
        F.count(F.when(F.col("_warn") == 1, 1)).alias("n_warned"),
    ).withColumn("compliant", F.col("n_blocked") == 0)
    skips = j.filter(F.col("_block") == 1).select(
        "crawl_id", key_col, F.lit("tos").alias("reason"), F.col("_clauses").alias("detail"))
    return summary, skips
