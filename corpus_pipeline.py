"""Cleaning a document table into token ids, as five stages.

Each stage works on all documents that the one before kept and returns the
columns of ``documents`` (the last one: token ids). ``run`` writes every
stage's result to shared storage and reads it back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import bpe, decontaminate, fuzzy_lines, jaccard_join, toxicity
from webloom.llm.common import row_key, small_enough, stored, table
from webloom.session import configure


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The documents whose row key is not among ``rejected`` (column dkey)."""
    keyed = docs.select("*", row_key().alias("__key"))
    gone = small_enough(stored(rejected.select(F.col("dkey").alias("__key")).distinct(), "rejected"))
    return keyed.join(gone, "__key", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut; trained on the labels' training rows."""
    configure(spark)
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon, "__score").where(F.col("__score") < toxicity.CUT).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an earlier document or line has;
    n_chars follows the text. A document that loses all its lines, a copy, is
    dropped; one without any line to begin with stays."""
    configure(spark)
    reduced = fuzzy_lines.dedup_lines(docs).where("n_dropped = 0 or n_dropped < n_lines")
    return reduced.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c)
                            for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, and one row of those that
    repeat its doc_id and text, which ``kept`` marks alike. Documents without
    words are in no group and stay."""
    configure(spark)
    found = stored(jaccard_join.similar_documents(docs).select("dkey", "n_grams", "kept"), "near-copies")
    rest = _without(docs, found.where(~F.col("kept"))).select("*", row_key().alias("__key"))
    repeated = (found.where("kept and n_grams > 0").groupBy(F.col("dkey").alias("__key")).agg(F.count("*").alias("n"))
                .where("n > 1").select("__key"))
    repeated = small_enough(stored(repeated, "repeated-rows"))
    single = rest.join(repeated, "__key", "left_anti")
    one = rest.join(repeated, "__key", "left_semi").dropDuplicates(["__key"])
    return single.unionByName(one).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    configure(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): little-endian unsigned 32-bit
    token ids, and the digest of the bytes they decode to, which is that of the
    text (of no bytes for a null text) if the ids are right. The ids are stored
    between the two steps: in one task each would have a Python worker of its
    own, and an executor twice as many, which stay for the stages that follow."""
    configure(spark)
    vocabulary = bpe.load_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    decoded = bpe.decode(stored(bpe.encode(docs, vocabulary), "token-ids"), vocabulary)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: Training, fuzzy joins and BPE have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
