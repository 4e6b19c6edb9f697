"""Building blocks that keep hot keys and long groups off single tasks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


HOT_ROWS = 1_000_000


def is_small(facts: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a written table has at most so many rows and bytes of content."""
    count = facts.count()
    if count > max_rows:
        return False
    if not any(re.search("string|binary|array|map|variant", field.dataType.simpleString()) for field in facts.schema):
        return True
    content = F.octet_length(F.to_json(F.struct(*[F.col(f"`{name}`") for name in facts.columns])))
    return (facts.agg(F.sum(content)).first()[0] or 0) <= max_bytes


def _row_hash(rows: DataFrame, row_key: Sequence[str] | None) -> Column:
    """Hash that spreads the rows of one key: of ``row_key``, or else of all columns of fixed width."""
    names = row_key or [
        field.name for field in rows.schema
        if not re.search("string|binary|array|map|struct|variant", field.dataType.simpleString())
    ]
    return F.xxhash64(*[F.col(f"`{name}`") for name in names or rows.columns[:1]])


def broadcast_if_small(
    df: DataFrame, keys: Sequence[str], rows: DataFrame, max_rows: int = BROADCAST_ROWS, salts: int = 64,
    hot_rows: int = HOT_ROWS, row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Left-join per-key facts ``df`` onto ``rows`` after measuring ``df``.

    ``df`` is materialised once in the checkpoint folder and measured there. Up
    to ``max_rows`` and 64 MB of content it is broadcast and ``rows`` is not
    shuffled at all. Beyond that both sides are shuffled on the keys. A narrow
    count finds the keys with more than ``hot_rows`` rows; only their facts are
    copied, ``salts`` times or as often as brings them under ``hot_rows``, and
    only their rows are spread, by ``row_key``, so that no key (not even one
    holding a third of the rows) ends up in one task.
    """
    facts = checkpointed(df)
    renamed = facts.select(
        *[F.col(key).alias(f"_fact_{key}") for key in keys],
        *[F.col(name) for name in facts.columns if name not in keys],
    )
    match = [F.col(key).eqNullSafe(F.col(f"_fact_{key}")) for key in keys]
    fact_keys = [f"_fact_{key}" for key in keys]
    if is_small(facts, max_rows):
        return rows.join(F.broadcast(renamed), match, "left").drop(*fact_keys)
    copies = F.greatest(F.lit(salts), F.ceil(F.col("_rows") / hot_rows)).cast("int")
    hot = checkpointed(
        rows.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows).select(
            *[F.col(key).alias(f"_hot_{key}") for key in keys], copies.alias("_copies")
        )
    )
    hot_keys = [f"_hot_{key}" for key in keys]
    of_rows = [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    of_facts = [F.col(f"_fact_{key}").eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    spread = F.coalesce(F.pmod(_row_hash(rows, row_key), F.col("_copies").cast("long")).cast("int"), F.lit(0))
    salted = rows.join(F.broadcast(hot), of_rows, "left").withColumn("_salt", spread).drop("_copies", *hot_keys)
    every = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    copied = renamed.join(F.broadcast(hot), of_facts, "left").withColumn("_fact_salt", F.explode(every)).drop("_copies", *hot_keys)
    joined = salted.join(copied, [*match, F.col("_salt") == F.col("_fact_salt")], "left")
    return joined.drop("_salt", "_fact_salt", *fact_keys)


def join_group_facts(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    size: str,
    row_key: Sequence[str],
    hot_rows: int = 1_000_000,
    salts: int = 256,
) -> DataFrame:
    """Left-join per-key facts (one row per key, group size in ``size``) onto rows; a null key meets its own facts.

    Keys above ``hot_rows`` are salted, with as many salts as bring a key's rows
    per salt under ``hot_rows`` (``salts`` at least); all other keys stay unsalted
    and uncopied. There can be at most total rows / ``hot_rows`` hot keys; their
    list is measured before it is broadcast.
    """
    copies = F.greatest(F.lit(salts), F.ceil(F.col(size) / hot_rows)).cast("int")
    sized = facts.withColumn("_salts", F.when(F.col(size) > hot_rows, copies).otherwise(F.lit(1)))
    hot = sized.filter(F.col("_salts") > 1).select(key, F.col("_salts").alias("_hot_salts"))
    spread = F.pmod(F.xxhash64(*[F.col(name) for name in row_key]), F.col("_hot_salts").cast("long")).cast("int")
    salted = (
        broadcast_if_small(hot, [key], rows)
        .withColumn("_salt", F.coalesce(spread, F.lit(0)))
        .drop("_hot_salts")
    )
    copied = (
        sized.withColumn("_fact_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        .drop("_salts")
        .withColumnRenamed(key, "_fact_key")
    )
    match = F.col(key).eqNullSafe(F.col("_fact_key")) & (F.col("_salt") == F.col("_fact_salt"))
    return salted.join(copied, match, "left").drop("_salt", "_fact_salt", "_fact_key")


def running_cuts(
    rows: DataFrame,
    group: Sequence[str],
    bucket: Sequence[str],
    order: Sequence[str],
    weight: str,
    targets: dict[str, Column],
) -> DataFrame:
    """Per group, the order keys at which running weights reach the targets.

    ``bucket`` must be a prefix of the ordering (coarse first), ``order`` a total
    order within a group. Each target is a column over ``total``, the group's
    weight. The result has for every target ``<name>_key``, the order key (a
    struct) of the first row whose running weight reaches it; rows up to that
    key are the ones needed to fill the target. A target of zero, or one beyond
    the total, has no key, and a group without any key has no row.

    Only per-bucket sums are shuffled and sorted for whole groups. Rows are
    ordered just inside the single bucket where a target falls, so the work per
    task is bounded by the bucket size, not by the group size. The list of those
    buckets is written out first, so that the join picking their rows knows how
    small it is and leaves all other rows where they are.
    """
    keys = list(group)
    per_bucket = rows.groupBy(*keys, *bucket).agg(F.sum(weight).alias("_weight"))
    whole = Window.partitionBy(*keys)
    running = whole.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    placed = per_bucket.select(
        *keys,
        *bucket,
        "_weight",
        F.coalesce(F.sum("_weight").over(running), F.lit(0)).alias("_before"),
        F.sum("_weight").over(whole).alias("total"),
    )
    goals = [
        F.struct(F.lit(name).alias("name"), goal.cast("bigint").alias("goal"))
        for name, goal in targets.items()
    ]
    wanted = placed.withColumn("_goal", F.explode(F.array(*goals)))
    holds_goal = (F.col("_before") < F.col("_goal.goal")) & (
        F.col("_goal.goal") <= F.col("_before") + F.col("_weight")
    )
    spots = checkpointed(
        wanted.filter(holds_goal).select(
            *[F.col(name).alias(f"_spot_{name}") for name in [*keys, *bucket]],
            F.col("_goal.name").alias("_name"),
            (F.col("_goal.goal") - F.col("_before")).alias("_missing"),
        )
    )
    same_spot = [F.col(name).eqNullSafe(F.col(f"_spot_{name}")) for name in [*keys, *bucket]]
    near = rows.join(spots, same_spot).select(*keys, *bucket, *order, weight, "_name", "_missing")
    inside = Window.partitionBy(*keys, *bucket, "_name").orderBy(*order)
    reached = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    first = (F.col("_reached") >= F.col("_missing")) & (
        F.col("_reached") - F.col(weight) < F.col("_missing")
    )
    return (
        near.withColumn("_reached", reached)
        .filter(first)
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col("_name") == name, F.struct(*order))).alias(f"{name}_key")
                for name in targets
            ]
        )
    )
