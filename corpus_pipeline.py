"""A corpus pipeline: each stage reads what the one before it wrote.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a frame with the columns of ``documents``, the last one the tokens.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, langid, linededup, simhash
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import PIECES_FILE, RANKS_FILE
from ledgerloom.session import shared_folder

#: States and words that a worker keeps while it encodes; workers of the stages before may still hold memory of their own.
HELD_STATES = HELD_WORDS = 100_000
#: Below this posterior a text is in none of the learned languages clearly enough.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; ``und`` and unclear ones go. Labels stay as they are."""
    path = public_tokenizers.path(PIECES_FILE)
    langs, chances = langid.trained(docs, path)
    decided = langid.decision(F.col("text"), langs, chances, path)
    return docs.filter((decided["lang_pred"] != langid.UNDETERMINED) & (decided["score"] >= LEAST_SCORE))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that stand earlier in the corpus."""
    return linededup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (three-word shingles, at most 2 of 64 bits): the one with the smallest id, then text."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests that show they decode to its text."""
    found = bpe.encoded(docs, public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN, max_states=HELD_STATES, max_pieces=HELD_WORDS)
    return found.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: No stage but the filters can be said in SQL (XXH64, forward algorithm, BPE); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}-{name}"
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
