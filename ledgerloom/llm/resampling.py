"""Importance resampling towards a target text distribution, on hashed n-gram features.

A document's weight is how much likelier its features are in the target than in
the corpus, and documents are drawn without replacement by the highest weight plus
Gumbel noise. Two narrow passes read the texts: one counts feature buckets, one
looks up the gain of every feature and adds the gains up per document.

Inside a task Arrow does the work per batch: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn texts into
word indices. Indices shifted by one place form the n-grams, the distinct ones get
a CRC, and taken gains are reduced by segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_type, named, numbered_in_order, release, text_of
from ledgerloom.session import checkpointed

BUCKETS = 10_000
NGRAM = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: What stands between words: ASCII other than letters and digits. Capitals are lower-cased before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Texts are worked on in groups of so many bytes; a longer text is a group of its own.
GROUP_BYTES = 2 << 20


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Start and length of runs of texts of up to ``most`` bytes together, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop - start
        start = stop


def word_indices(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Index of every word in the batch's dictionary, the text it stands in, and the dictionary."""
    parts = pc.split_pattern_regex(pc.fill_null(pc.ascii_lower(texts), ""), BETWEEN)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    coded = pc.list_flatten(parts).dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if b"" in words:  # text that begins or ends with a separator
        real = index != words.index(b"")
        index, owner = index[real], owner[real]
    return index, owner, words


def features(texts: pa.Array, ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram of up to ``ngram`` words, and every text's number of words."""
    index, owner, words = word_indices(texts)
    n_words = np.bincount(owner, minlength=len(texts))
    sums = np.array([zlib.crc32(word) for word in words], dtype=np.int64)
    found, owners = [sums[index] % buckets], [owner]
    gram, crcs = index, sums
    for size in range(2, ngram + 1):
        if len(index) < size:
            break
        inside = owner[size - 1 :] == owner[: len(owner) - size + 1]
        # the n-gram of one word less (its number) and the word behind it
        pairs = gram[: len(index) - size + 1] * len(words) + index[size - 1 :]
        coded = pa.array(pairs).dictionary_encode()
        distinct = coded.dictionary.to_numpy()
        spaced = [zlib.crc32(b" ", crc) for crc in crcs.tolist()]
        crcs = np.array(
            [zlib.crc32(words[last], spaced[first]) for first, last in zip(*(x.tolist() for x in np.divmod(distinct, len(words))))],
            dtype=np.int64,
        )
        gram = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found.append((crcs % buckets)[gram[inside]])
        owners.append(owner[size - 1 :][inside])
    return np.concatenate(found), np.concatenate(owners), n_words


def bucket_counts(docs: DataFrame, text_column: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``: features of all texts per bucket, summed up in each task first. Empty buckets have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column("text")
            for start, length in groups(texts):
                total += np.bincount(features(texts.slice(start, length), ngram, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    counted = docs.select(text_of(f"`{text_column}`").alias("text")).mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, floor(1000 ln((t+1)(S+b) / ((s+1)(T+b)))), from the counts of corpus and target.

    The result has ``buckets`` entries, however large the tables are.
    """
    spark = corpus.sparkSession
    counts = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    rows = sorted(counts.collect())
    s, t = (np.array([row[name] for row in rows], dtype=np.float64) for name in ("s", "t"))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(
    docs: DataFrame, gains: np.ndarray, id_column: str = "doc_id", text_column: str = "text", ngram: int = NGRAM,
) -> DataFrame:
    """``id``, ``n_features``, ``n_words`` and ``weight``, the floored mean gain of a text's features (none: 0)."""
    narrow = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    schema = pa.schema(
        [("id", arrow_type(narrow, "id")), ("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts = batch.column("text")
            for start, length in groups(texts):
                at, owner, n_words = features(texts.slice(start, length), ngram, len(gains))
                number = np.bincount(owner, minlength=length)
                total = np.zeros(length, dtype=np.int64)
                np.add.at(total, owner, gains[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, length), pa.array(number), pa.array(n_words), pa.array(total // np.maximum(number, 1))],
                    schema=schema,
                )

    return narrow.mapInArrow(run, narrow.select("id").schema.add("n_features", "long").add("n_words", "long").add("weight", "long"))


def gumbel(id_column: str, seed: int) -> Column:
    """Thousandths of a Gumbel draw from the id: floor(-1000 ln(-ln((h + 0.5) / 2 ** 32)))."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    ngram: int = NGRAM,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document; ``rank`` is null if it is not drawn.

    Of the N documents with at least ``least_words`` words floor(``percent`` N /
    100) are drawn, by score and then by smaller id. Null or empty text has no
    feature and weight 0. A null id draws like the empty id and comes first among
    equal scores; repeated rows are documents of their own and take ranks one after
    another. An empty table gives no rows, an empty target gains from smoothing
    alone. Other columns are ignored. A task holds one group of texts (2 MB, or one
    longer text) and some ten times its size in indices.
    """
    gains = bucket_gains(bucket_counts(docs, text_column, ngram, buckets), bucket_counts(target, target_column, ngram, buckets), buckets)
    scored = checkpointed(
        weighed(docs, gains, id_column, text_column, ngram).withColumn("score", F.col("weight") + gumbel("id", seed))
    )
    fit = scored.filter(F.col("n_words") >= least_words)
    drawn = fit.count() * percent // 100
    ordered = numbered_in_order(fit.withColumn("_down", -F.col("score")), "rank", "_down", "id")
    kept = ordered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["id", "n_features", "weight", "score", "rank"]
    return kept.select(*columns).unionByName(rest.select(*columns))
