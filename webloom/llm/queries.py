"""Registered queries of the training-data operators: each applies its
operator with production parameters to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import (bpe, chat, decontaminate, divergence, exact, fuzzy_lines, hard_negatives, html_text,
                         jaccard_join, sharding, suffix_dedup, toxicity, warc)
from webloom.llm.common import shared_path, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.chat_digests(chat.chat_windows(turns.unionByName(probe)))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabulary = bpe.load_vocabulary(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    decoded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("dkey")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_path(spark, "shards")
    sharded = sharding.shard(docs, 24)
    sharding.write_shards(sharded, path)
    return sharding.read_shards(spark, path, sharded.schema).drop("text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_warc(spark, path))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents")).drop("dkey")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(docs)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return left.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat, op2_bpe, op3_decontaminate, op4_toxicity, op5_shards, op6_warc, op7_jaccard_join,
                            op8_line_dedup, op9_exact_dedup, op10_html_text, op11_divergence, op12_suffix_dedup, op13_hard_negatives)}
