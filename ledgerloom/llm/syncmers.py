"""Document fingerprints from closed syncmers.

A k-mer of characters is an anchor if the smallest of its inner substrings stands
at its first or last place. That depends on the k-mer alone, so equal passages
have equal anchors wherever they stand. A document's fingerprint is a sketch of
its anchors: their hashes fall into bins, each bin keeps its smallest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import named, text_of
from ledgerloom.session import checkpointed

K, S = 24, 8
BINS = 128
_CHUNK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint16(0xFFFF)
BUCKET_ROWS = 8_000
MAX_BUCKETS = 4_096


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * _MIX
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values


def _rolled(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive values, by doubling: a window is two overlapping or adjacent halves."""
    if length == 1:
        return _mixed(codes + np.uint64(1))
    half = length // 2
    inner = _rolled(codes, half)
    out = inner[: len(codes) - length + 1] * np.uint64(0xD6E8FEB86659FD93) + inner[half : len(codes) - length + 1 + half]
    if length % 2:
        out = out * np.uint64(0xA0761D6478BD642F) + codes[length - 1 :]
    return _mixed(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's closed syncmers, in text order; a text shorter than k is one anchor, an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if len(codes) < k:
        return np.zeros(1, dtype=np.int64), _rolled(codes, len(codes))
    places, hashes = [], []
    for start in range(0, len(codes) - k + 1, _CHUNK):
        part = codes[start : start + _CHUNK + k - 1]
        inner = _rolled(part, s)
        least = _least(inner, k - s + 1)
        count = len(part) - k + 1
        at = np.flatnonzero((inner[:count] == least) | (inner[k - s : k - s + count] == least))
        # an anchor's hash mixes the inner substrings that cover it
        value = inner[at]
        for shift in range(s, k, s):
            value = _mixed(value * np.uint64(0xD6E8FEB86659FD93) + inner[at + min(shift, k - s)])
        places.append(at + start)
        hashes.append(value)
    return np.concatenate(places), np.concatenate(hashes)


def fingerprint(text: str, k: int = K, s: int = S, bins: int = BINS) -> str:
    """The sketch as hex: per bin 16 bits of the smallest anchor hash, ffff for a bin without any."""
    _, hashes = anchors(text, k, s)
    rest = hashes // np.uint64(bins)
    least = np.full(bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, (hashes % np.uint64(bins)).astype(np.int64), rest)
    short = (_mixed(least) % np.uint64(0xFFFF)).astype(np.uint16)
    short[least == np.iinfo(np.uint64).max] = _EMPTY
    return short.astype(">u2").tobytes().hex()


def likeness(left: str, right: str) -> float:
    """Share of bins, of those that either fingerprint fills, in which both agree; two empty fingerprints are alike."""
    a, b = (np.frombuffer(bytes.fromhex(x), dtype=">u2") for x in (left, right))
    filled = (a != _EMPTY) | (b != _EMPTY)
    return float(np.count_nonzero((a == b) & filled) / np.count_nonzero(filled)) if filled.any() else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(part.column(name).to_pylist() for name in ("bucket", "extra", "id", "text")), strict=True)


def _compared(batches: Iterator[pa.RecordBatch], schema: pa.Schema, k: int, s: int, bins: int) -> Iterator[pa.RecordBatch]:
    """Each row against the one after it; a bucket's last row meets the row lent by the next bucket."""
    rows = []
    before = None
    for row in _sorted_rows(batches):
        bucket, extra, _, text = row
        mark = fingerprint(text, k, s, bins)
        if before is not None and before[0] == bucket and not before[1]:
            own_text, own_mark = before[3], before[4]
            other = edited(own_text, text)
            other_mark = fingerprint(other, k, s, bins)
            rows.append(
                (before[2], len(own_text), hashlib.sha256(other.encode()).hexdigest(), own_mark, other_mark,
                 likeness(own_mark, other_mark), likeness(own_mark, mark))
            )
        before = (*row, mark)
        if len(rows) == 2048:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def neighbour_fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    k: int = K,
    s: int = S,
    bins: int = BINS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Fingerprints of every whole text and of its text edited with the next document's.

    The next document has the next smaller id; after the last comes the first.
    Returns ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    Ids are cut into at most ``MAX_BUCKETS`` ranges of about ``bucket_rows`` rows;
    every text is shuffled once, to its range, and sorted there (a long range
    spills; only two rows are held at a time). The first row of each range is also lent
    to the range before it. Null text is empty text, and has an empty sketch.
    Null ids come last; rows with equal ids follow each other by text, and the
    next of a repeated row is its repetition. A lone row is its own next. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), text_of(f"`{text_column}`").alias("text"))
    ids = checkpointed(base.select("id"))
    count = ids.count()
    pieces = min(MAX_BUCKETS, max(1, -(-count // bucket_rows)))
    wanted = [i / pieces for i in range(1, pieces)]
    edges = sorted(set(ids.approxQuantile("id", wanted, 0.1 / pieces))) if wanted else []
    bucket = _bucket(edges)
    tops = {row[0]: row[1] for row in ids.groupBy(bucket.alias("bucket")).agg(F.max("id")).collect()}
    filled = sorted(tops)
    lends = spark.createDataFrame(
        [(tops[at], filled[i - 1], at) for i, at in enumerate(filled)], "top long, target int, bucket int"
    )
    rows = base.withColumn("bucket", bucket)
    extras = (
        rows.join(F.broadcast(lends), ["bucket"])
        .filter(F.col("id").eqNullSafe(F.col("top")))
        .select(F.col("target").alias("bucket"), F.lit(True).alias("extra"), "id", "text")
    )
    work = rows.select("bucket", F.lit(False).alias("extra"), "id", "text").unionByName(extras)
    ordered = work.repartitionById(len(edges) + 1, F.col("bucket")).sortWithinPartitions(
        F.col("bucket"), F.col("extra"), F.col("id").desc_nulls_last(), F.col("text")
    )
    schema = pa.schema(
        [("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    return ordered.mapInArrow(
        partial(_compared, schema=schema, k=k, s=s, bins=bins),
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def _bucket(edges: list[float]):
    """Bucket 0 holds the largest ids, the last the smallest and null ones; found by halving the list of edges."""

    def node(low: int, high: int):
        if low == high:
            return F.lit(len(edges) - low)
        middle = (low + high) // 2
        return F.when(F.col("id") >= F.lit(int(edges[middle])), node(middle + 1, high)).otherwise(node(low, middle))

    return F.when(F.col("id").isNull(), F.lit(len(edges))).otherwise(node(0, len(edges)))
