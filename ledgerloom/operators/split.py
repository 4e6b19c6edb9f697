"""Exact stratified splits, seeded order, and limits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.draws import order_key
from ledgerloom.operators.scale import broadcast_if_small, running_cuts

SPLITS = ("train", "validation", "test")
BUCKET_DIGITS = 3
ROWS_PER_PARTITION = 1_000_000


def allocated(total: Column, ratios: Sequence[float]) -> list[Column]:
    """Largest-remainder shares of ``total`` as one whole-number column per ratio.

    Left-over units go to the largest fractional parts, the earlier split first
    on ties. A wanted split that would stay empty then takes one unit from the
    (first) largest one, if there are enough units for every wanted split.
    """
    exact = [total * F.lit(float(ratio)) for ratio in ratios]
    whole = [F.floor(share).cast("bigint") for share in exact]
    part = [share - floor for share, floor in zip(exact, whole)]
    spare = total - sum(whole[1:], whole[0])
    shares: list[Column] = []
    for at, floor in enumerate(whole):
        ahead = F.lit(0)
        for other in range(len(whole)):
            if other != at:
                wins = part[other] >= part[at] if other < at else part[other] > part[at]
                ahead = ahead + wins.cast("int")
        shares.append(floor + (ahead < spare).cast("bigint"))
    wanted = [at for at, ratio in enumerate(ratios) if ratio > 0]
    enough = total >= len(wanted)
    held = F.aggregate(
        F.array(*[F.lit(at) for at in wanted]),
        F.array(*shares),
        lambda counts, at: _fed(counts, at, enough),
    )
    return [F.element_at(held, at + 1) for at in range(len(ratios))]


def _fed(held: Column, at: Column, enough: Column) -> Column:
    """``held`` after split ``at``, if empty, took one unit from the first largest split."""
    donor = F.array_position(held, F.array_max(held)) - 1
    moved = F.transform(
        held,
        lambda count, spot: F.when(spot == at, count + 1).when(spot == donor, count - 1).otherwise(count),
    )
    return F.when(enough & (F.get(held, at) == 0) & (F.array_max(held) > 1), moved).otherwise(held)


def check_ratios(ratios: Sequence[float]) -> None:
    if round(sum(ratios), 6) != 1.0:
        raise ValueError("split ratios must sum to 1")


def allocate_counts(
    totals: DataFrame, total: str, ratios: Sequence[float], names: Sequence[str] = SPLITS
) -> DataFrame:
    """Add one allocation column per split name."""
    shares = allocated(F.col(total).cast("bigint"), ratios)
    return totals.select("*", *[share.alias(name) for share, name in zip(shares, names)])


def stratified_split(
    df: DataFrame,
    ratios: Sequence[float] = (0.8, 0.1, 0.1),
    seed: int = 42,
    stratum: str = "category",
    row_id: str = "id",
    tie_break: Sequence[str] = (),
    bucket_digits: int | None = None,
) -> DataFrame:
    """Add a ``split`` column whose sizes per stratum follow ``allocate_counts``.

    Rows are ordered inside a stratum by a seeded hash of their id. Two narrow
    passes over (stratum, id) find the hash keys where each stratum is to be
    cut; the wide rows are then labelled by comparing their own key with those
    cuts. The payload is never shuffled or sorted. A stratum is cut into
    16 ** ``bucket_digits`` buckets, by default at least as many as the square
    root of the number of rows, so that neither the buckets of a stratum nor the
    rows of a bucket become large; the rows are counted for that. ``row_id`` and ``tie_break`` together must be
    unique within a stratum.
    """
    check_ratios(ratios)
    ids = [row_id, *tie_break]
    if bucket_digits is None:
        root = math.isqrt(df.count())
        bucket_digits = max(BUCKET_DIGITS, -(-root.bit_length() // 4))

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_order", order_key(seed, F.col(row_id)))

    narrow = keyed(df.select(stratum, *ids)).withColumn(
        "_bucket", F.substring("_order", 1, bucket_digits)
    ).withColumn("_one", F.lit(1).cast("bigint"))
    first, second, _ = allocated(F.col("total"), ratios)
    cuts = running_cuts(
        narrow,
        [stratum],
        ["_bucket"],
        ["_order", *ids],
        "_one",
        targets={"train": first, "held": first + second},
    )
    labelled = broadcast_if_small(cuts, [stratum], keyed(df))
    mine = F.struct("_order", *ids)
    split = (
        F.when(mine <= F.col("train_key"), SPLITS[0])
        .when(mine <= F.col("held_key"), SPLITS[1])
        .otherwise(SPLITS[2])
    )
    return labelled.withColumn("split", split).drop("_order", "train_key", "held_key")


def shuffled(df: DataFrame, seed: int = 42, row_id: str = "id", partitions: int | None = None) -> DataFrame:
    """Rows in a reproducible random order.

    The order is that of a seeded hash. Hashes are uniform, so the partition a
    row belongs to follows from its leading 32 bits: one exchange, without the
    extra pass over the data that a range sort needs to sample its bounds. Rows
    are sorted within partitions, and the partitions follow each other, so the
    order is the same for every partition count. Without a given count the rows
    are counted, and a partition gets ``ROWS_PER_PARTITION`` of them at most, on
    average; wide rows want more ``partitions``.
    """
    if partitions is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-df.count() // ROWS_PER_PARTITION))
    count = partitions
    keyed = df.withColumn("_order", order_key(seed, F.col(row_id)))
    leading = F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint")
    place = F.shiftright(leading * F.lit(count), 32).cast("int")
    return keyed.repartitionById(count, place).sortWithinPartitions("_order", row_id).drop("_order")


def first_rows(
    df: DataFrame, limit: int, order: Sequence[str], categories: Sequence[str] | None = None, column: str = "category"
) -> DataFrame:
    """The first ``limit`` rows in order, after keeping only some categories."""
    kept = df if categories is None else df.filter(F.col(column).isin(*categories))
    return kept.orderBy(*order).limit(limit)


def split_sizes(df: DataFrame, batch: int = 4, accumulation: int = 4, epochs: int = 3) -> DataFrame:
    """Rows per split and the optimiser steps that follow from them."""
    per_epoch = F.floor(F.col("rows") / F.lit(batch * accumulation)).cast("bigint")
    return df.groupBy("split").agg(F.count("*").alias("rows")).select(
        "split",
        "rows",
        per_epoch.alias("steps_per_epoch"),
        (per_epoch * epochs).alias("total_steps"),
    )
