"""Union, exact de-duplication and summaries of record tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.scale import BROADCAST_ROWS, HOT_ROWS, is_small, join_group_facts
from ledgerloom.session import checkpointed

SEMANTIC = ("instruction", "context", "output", "category")
TARGET_ROWS = 100_000
#: Bits of the filter that is broadcast when the repeated digests are not: 32 MB.
FILTER_SLOTS = 1 << 28


def merge(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; ``source_ord`` remembers which frame came first."""
    marked = [frame.withColumn("source_ord", F.lit(at)) for at, frame in enumerate(frames)]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), marked)


def digest(df: DataFrame, columns: Sequence[str] = SEMANTIC) -> Column:
    """256-bit fingerprint of some columns, 32 bytes wide in a shuffle.

    Strings go in as they are behind their length, so that borders count and a
    null differs from an empty text; values with inner structure as JSON.
    """

    def part(name: str) -> Column:
        kind, value = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, T.BinaryType):
            text = F.hex(value)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            text = F.to_json(F.struct(value))
        else:
            text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(name) for name in columns]), 256))


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("_digest"), F.lit(slots))


def repeat_filter(repeated: DataFrame, slots: int = FILTER_SLOTS) -> DataFrame:
    """A bit array of ``slots`` bits with the slots of the digests in ``repeated`` set.

    Rows are blocks of 32,768 bits (``_block``, ``_bits``); blocks without a bit
    are left out, so all of it never takes more than ``slots`` / 8 bytes. Blocks are
    put together map-side, a task sends each of its blocks once.
    """
    return repeated.groupBy(F.bitmap_bucket_number(_slot(slots)).alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_slot(slots))).alias("_bits")
    )


def _may_repeat(slots: int) -> Column:
    """Whether the bit of the row's digest is set in the block joined to it."""
    place = F.bitmap_bit_position(_slot(slots))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def exact_dedup(
    df: DataFrame, order: Sequence[str], columns: Sequence[str] = SEMANTIC, max_rows: int = BROADCAST_ROWS,
    slots: int = FILTER_SLOTS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keep the first of equal rows.

    A narrow pass over digests and order keys, combined map-side, finds the first
    row of every repeated digest. That list is written and measured: up to
    ``max_rows`` (and 64 MB) it is broadcast and the wide rows stay where they
    are. Beyond that a bit array of the repeated digests is broadcast, never more
    than ``slots`` / 8 bytes (32 MB). Rows whose bit is not set are unique and go on
    where they are; only possible repeats are shuffled to meet the list, and only
    digests with more than ``hot_rows`` rows are salted, by the order key. While
    repeated digests are few beside ``slots`` a unique row is shuffled with
    probability repeated / ``slots``; beyond, more of them are, with the same result.

    ``df`` is read twice (three times beyond ``max_rows``) and must give the same
    rows each time. ``order`` must name a total order; equal rows that also agree
    in it all stay.
    """
    place = F.struct(*[F.col(name) for name in order])
    keyed = df.withColumn("_digest", digest(df, columns))
    firsts = checkpointed(
        keyed.groupBy("_digest").agg(F.min(place).alias("_earliest"), F.count("*").alias("_size")).filter(F.col("_size") > 1)
    )
    if is_small(firsts, max_rows):
        met = keyed.join(F.broadcast(firsts.drop("_size")), "_digest", "left")
    else:
        bits = checkpointed(repeat_filter(firsts, slots))
        seen = keyed.join(F.broadcast(bits), F.bitmap_bucket_number(_slot(slots)) == F.col("_block"), "left")
        marked = seen.withColumn("_may_repeat", _may_repeat(slots)).drop("_block", "_bits")
        repeats = marked.filter("_may_repeat").drop("_may_repeat")
        shuffled = join_group_facts(repeats, firsts, "_digest", "_size", order, hot_rows=hot_rows).drop("_size")
        unique = marked.filter(~F.col("_may_repeat")).drop("_may_repeat")
        met = unique.withColumn("_earliest", F.lit(None).cast(firsts.schema["_earliest"].dataType)).unionByName(shuffled)
    kept = met.filter(F.col("_earliest").isNull() | place.eqNullSafe(F.col("_earliest")))
    return kept.select(*[F.col(f"`{name}`") for name in df.columns])


def category_source_counts(df: DataFrame) -> DataFrame:
    """Rows per category, per source and overall, in one pass."""
    named = df.select("category", F.coalesce("source", F.lit("unknown")).alias("source"))
    kind = F.grouping_id("category", "source")
    return (
        named.groupingSets([["category"], ["source"], []], "category", "source")
        .agg(kind.alias("_kind"), F.count("*").alias("rows"))
        .select(
            F.when(F.col("_kind") == 1, "category")
            .when(F.col("_kind") == 2, "source")
            .otherwise("total")
            .alias("kind"),
            F.when(F.col("_kind") == 1, F.coalesce("category", F.lit("unknown")))
            .when(F.col("_kind") == 2, F.col("source"))
            .otherwise("samples")
            .alias("name"),
            "rows",
        )
    )


def merge_summary(
    df: DataFrame, columns: Sequence[str] = SEMANTIC, target: int = TARGET_ROWS
) -> DataFrame:
    """Rows before and after de-duplication, from fingerprints alone."""
    return (
        df.select(digest(df, columns).alias("_digest"))
        .groupBy("_digest")
        .agg(F.count("*").alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("before_deduplication"),
            F.count("*").alias("after_deduplication"),
        )
        .withColumn("target_met", F.col("after_deduplication") >= target)
    )
