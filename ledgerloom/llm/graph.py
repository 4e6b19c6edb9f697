"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star pass over ``links`` (a, b) with a > b; joins may be split by adaptive execution."""
    near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = near.join(least, "a")
    if large:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    to_low = joined.filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return to_low.unionByName(least.select("a", F.col("low").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every linked node, from undirected ``links`` (a, b).

    Large-star and small-star passes alternate until the links no longer change;
    then every node points straight at the smallest node of its component. Sums
    are combined before each shuffle, so a hub of any degree sends one row per
    task to the aggregation, and its rows in the join can be split. The driver
    sees one row (count and hash sum) per pass. Null ends and self links are
    ignored; no links give no rows.
    """
    current = checkpointed(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        current = checkpointed(_star(_star(current, True).distinct(), False).distinct())
