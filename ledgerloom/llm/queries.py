"""The operators as named queries over whole tables, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe, decontaminate, langid, licenses, linededup, packing, quality, resampling, sharding, simhash, syncmers, trie, urls,
)
from ledgerloom.llm.common import table

RANKS_FILE = "byte_bpe_50k.tiktoken"
PIECES_FILE = "piece_bpe_32k.model"
WORDS_FILE = "word_bpe_49k.json"
RULES = (("net/", True), ("example.net/en/", False), ("example.com/de/", True), ("org/fr/", False))
KINDS = {"low": "quality = 0", "toxic": "toxic = 1"}


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
        "copies",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_urls(table(spark, sf_dir, "pages"), RULES).withColumnRenamed("id", "page_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "edits", "start", "end")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.repeated_runs(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.explode("cuts").alias("cut"),
    ).select("doc_id", F.col("cut.first").alias("first_line"), F.col("cut.last").alias("last_line"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path(PIECES_FILE)
    langs, chances = langid.trained(docs, path)
    found = langid.identified(docs, langs, chances, path)
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce(langid.held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), KINDS)
    keep = (F.col("p_low") < 0.5) & (F.col("p_toxic") < 0.5)
    return found.select(F.col("id").alias("doc_id"), "p_low", "p_toxic", keep.alias("keep"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encoded(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN, with_ids=False
    )
    return found.withColumnRenamed("id", "doc_id")


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.neighbour_fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("prefix")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS_FILE))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {
    query.__name__: query
    for query in (
        op1_simhash, op2_url_filter, op3_decontaminate, op4_line_dedup, op5_langid, op6_quality, op7_sharding, op8_bpe,
        op9_syncmers, op10_licenses, op11_prefix_trie, op12_resampling, op13_packing,
    )
}
ORACLE: dict[str, str] = {}
