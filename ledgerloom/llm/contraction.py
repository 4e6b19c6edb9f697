"""Subtree sums of a forest by parallel tree contraction.

Rounds of joins alternate two steps. Rake: every leaf gives its sums to its
parent and leaves. Compress: in a chain of nodes with one child each, all but the
last leave; the last one takes their place and remembers on the edge above it what
they hold. A round ends every leaf and every chain, so the number of rounds grows
with the logarithm of the number of nodes, however deep the forest is. Then the
compressed nodes are put back in reverse order: what a node held down to the last
of its chain, plus that one's own total, is its total.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed

#: Chains are first contracted inside stretches of so many depths of one path.
STRETCH = 4096
KEY = ("path", "depth")


def _edge(weight: str) -> str:
    return f"{weight}_above"


def _single() -> Column:
    """A node that chains may pass through: one child, and not a root."""
    return (F.col("kids") == 1) & F.col("up").isNotNull()


def _raked(active: DataFrame, weights: Sequence[str]) -> DataFrame:
    """The inner nodes, with the sums of the leaves below them; sums are combined before the shuffle."""
    leaves = active.filter((F.col("kids") == 0) & F.col("up").isNotNull())
    given = leaves.groupBy(F.col("up").alias("path"), F.col("up_depth").alias("depth")).agg(
        F.count("*").alias("_left"), *[F.sum(F.col(w) + F.col(_edge(w))).alias(f"_given_{w}") for w in weights]
    )
    inner = active.filter(F.col("kids") > 0).join(given, list(KEY), "left")
    return inner.select(
        *KEY, "up", "up_depth", (F.col("kids") - F.coalesce("_left", F.lit(0))).alias("kids"),
        *[(F.col(w) + F.coalesce(f"_given_{w}", F.lit(0))).alias(w) for w in weights],
        *[_edge(w) for w in weights],
    )


def _along_paths(inner: DataFrame, weights: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Chains inside a stretch of one path: what stays, and what left for which node of the same path."""
    stretch = ["path", "_stretch"]
    down = Window.partitionBy(*stretch).orderBy("depth")
    run = Window.partitionBy(*stretch, "_run")
    from_last = run.orderBy(F.desc("depth"))
    lead_is_child = (F.lead("up").over(down) == F.col("path")) & (F.lead("up_depth").over(down) == F.col("depth"))
    followed = _single() & F.lead(_single()).over(down) & lead_is_child
    marked = (
        inner.withColumn("_stretch", F.floor(F.col("depth") / STRETCH))
        .select("*", F.coalesce(followed, F.lit(False)).alias("_goes"), *[F.lead(_edge(w)).over(down).alias(f"_next_{w}") for w in weights])
        .withColumn("_run", F.coalesce(F.sum(F.when(F.col("_goes"), 0).otherwise(1)).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    held = {w: F.when(F.col("_goes"), F.col(w) + F.col(f"_next_{w}")).otherwise(0) for w in weights}
    runs = checkpointed(
        marked.select(
            *KEY, "kids", *weights, "_goes", F.max("depth").over(run).alias("to_depth"),
            F.min(F.struct("depth", "up", "up_depth", *[_edge(w) for w in weights])).over(run).alias("_top"),
            *[F.sum(held[w]).over(from_last).alias(f"_held_{w}") for w in weights],
            *[F.sum(held[w]).over(run).alias(f"_all_{w}") for w in weights],
        )
    )
    stay = runs.filter(~F.col("_goes")).select(
        *KEY, F.col("_top.up").alias("up"), F.col("_top.up_depth").alias("up_depth"), "kids", *weights,
        *[(F.col(f"_top.{_edge(w)}") + F.col(f"_all_{w}")).alias(_edge(w)) for w in weights],
    )
    gone = runs.filter("_goes").select(
        *KEY, F.col("path").alias("to_path"), "to_depth", *[F.col(f"_held_{w}").alias(w) for w in weights]
    )
    return stay, gone


def _across_paths(stay: DataFrame, weights: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Chains that are left, by pointer doubling: each join round halves the way to the last of the chain."""
    child = stay.filter(_single()).select(
        F.col("up").alias("path"), F.col("up_depth").alias("depth"), F.col("path").alias("to_path"),
        F.col("depth").alias("to_depth"), *[F.col(_edge(w)) for w in weights],
    )
    links = checkpointed(
        stay.filter(_single()).select(*KEY, *weights).join(child, list(KEY)).select(
            *KEY, "to_path", "to_depth", *[(F.col(w) + F.col(_edge(w))).alias(w) for w in weights]
        )
    )
    if links.isEmpty():
        return stay, None
    pointers, moving = links, True
    while moving:
        further = pointers.select(
            F.col("path").alias("to_path"), F.col("depth").alias("to_depth"), F.col("to_path").alias("_path"),
            F.col("to_depth").alias("_depth"), *[F.col(w).alias(f"_{w}") for w in weights],
        )
        pointers = checkpointed(
            pointers.join(further, ["to_path", "to_depth"], "left").select(
                *KEY, F.coalesce("_path", "to_path").alias("to_path"), F.coalesce("_depth", "to_depth").alias("to_depth"),
                *[(F.col(w) + F.coalesce(f"_{w}", F.lit(0))).alias(w) for w in weights],
                F.col("_path").isNotNull().alias("_moved"),
            )
        )
        moving = not pointers.filter("_moved").isEmpty()
    gone = pointers.drop("_moved")
    tops = gone.join(links.select(F.col("to_path").alias("path"), F.col("to_depth").alias("depth")), list(KEY), "left_anti")
    above = stay.select(*KEY, "up", "up_depth", *[_edge(w) for w in weights])
    placed = tops.join(above, list(KEY)).select(
        F.col("to_path").alias("path"), F.col("to_depth").alias("depth"), F.col("up").alias("_up"),
        F.col("up_depth").alias("_up_depth"), *[(F.col(w) + F.col(_edge(w))).alias(f"_{w}") for w in weights],
    )
    rest = stay.join(gone.select(*KEY), list(KEY), "left_anti").join(placed, list(KEY), "left")
    left = rest.select(
        *KEY, F.coalesce("_up", "up").alias("up"), F.coalesce("_up_depth", "up_depth").alias("up_depth"), "kids", *weights,
        *[F.coalesce(f"_{w}", _edge(w)).alias(_edge(w)) for w in weights],
    )
    return checkpointed(left), gone


def subtree_sums(forest: DataFrame, weights: Sequence[str]) -> DataFrame:
    """``path``, ``depth`` and, for every weight, its sum over the node's subtree, the node included.

    ``forest`` has one row per node: its key (``path``, ``depth``), the key of its
    parent (``up``, ``up_depth``; ``up`` is null for a root), its number of children
    (``kids``) and the weights, none of them null. Nodes of one path lie on one
    way down, at different depths; paths only make the work cheaper. No rows
    give no rows.

    A parent of any number of leaves gets one sum per task; a chain of any length
    is contracted in stretches of 4096 depths and then by doubling, so a node is
    waited for by at most that many others when nodes are put back, and by the
    stretches of its chain.
    """
    active = checkpointed(
        forest.select(*KEY, "up", "up_depth", "kids", *weights, *[F.lit(0).cast("long").alias(_edge(w)) for w in weights])
    )
    ended: list[DataFrame] = []
    compressed: list[DataFrame] = []
    while True:
        ended.append(active.filter(F.col("kids") == 0).select(*KEY, *weights))
        inner = checkpointed(_raked(active, weights))
        if inner.isEmpty():
            break
        stay, gone = _along_paths(inner, weights)
        compressed.append(gone)
        active, gone = _across_paths(stay, weights)
        if gone is not None:
            compressed.append(gone)
    for gone in reversed(compressed):
        known = reduce(DataFrame.unionByName, ended).select(
            F.col("path").alias("to_path"), F.col("depth").alias("to_depth"), *[F.col(w).alias(f"_{w}") for w in weights]
        )
        back = gone.join(known, ["to_path", "to_depth"])
        ended.append(checkpointed(back.select(*KEY, *[(F.col(w) + F.col(f"_{w}")).alias(w) for w in weights])))
    return reduce(DataFrame.unionByName, ended)
