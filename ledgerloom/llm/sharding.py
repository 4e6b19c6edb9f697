"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Keys lie on a ring of 64-bit positions. Every shard owns many points of the ring
and a key belongs to the next point clockwise; if that point's shard is full, the
key goes on to the next point whose shard has room. Load is counted in bytes.

Keys are not walked one by one. The ring is cut into cells, the bytes of each cell
are summed, and a cell above a fixed share of all bytes is cut again by the row's
own hash, so that no unit exceeds that share unless a single row does. Walking
the units clockwise on the driver then costs the same for any number of rows.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import named, text_of
from ledgerloom.session import checkpointed

CELL_BITS = 14
QUANTA = 32_768
VIRTUAL_NODES = 128
SLACK = 0.001


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[list[int], list[int]]:
    """Sorted positions of the virtual nodes and the shard of each; a shard's points don't depend on the others."""
    points = sorted(
        (xxhash.xxh64_intdigest(f"shard {shard} node {node}", 42), shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    )
    return [at for at, _ in points], [shard for _, shard in points]


def walk(units: list[tuple[int, int]], shards: int, capacity: float, virtual_nodes: int) -> list[int]:
    """Shard of every unit (position, bytes): the ring's, or clockwise the next one with room.

    Units of over a 64th of the capacity are placed first, then the others, each
    in ring order, so that small ones fill what large ones leave. A unit that fits
    nowhere goes to the least loaded shard; as long as that happens with small
    units only, no shard exceeds the capacity by more than one of them.
    """
    positions, owners = ring(shards, virtual_nodes)
    loads = [0] * shards
    out = [0] * len(units)
    for at in sorted(range(len(units)), key=lambda i: (units[i][1] * 64 <= capacity, i)):
        position, size = units[at]
        node = bisect_left(positions, position)
        for step in range(len(owners)):
            shard = owners[(node + step) % len(owners)]
            if loads[shard] + size <= capacity:
                break
        else:
            shard = min(range(shards), key=loads.__getitem__)
        loads[shard] += size
        out[at] = shard
    return out


def _low_bits(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, 64 - bits).cast("int")


def sharded(
    docs: DataFrame,
    shards: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    slack: float = SLACK,
    virtual_nodes: int = VIRTUAL_NODES,
    quanta: int = QUANTA,
) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``unit`` of every row.

    A row's size is its text's UTF-8 bytes plus one (null text: one), its ring
    position the hash of its text, so equal texts stay together as long as their
    shard has room. A shard is full at ``1 + slack`` times the mean bytes, which
    can only be exceeded by the unit that fits nowhere (see ``walk``); a unit is
    about 1/``quanta`` of all bytes and of all rows at most, or one row's ``(id, text)`` and its repetitions. Slots count each shard's rows from 0
    without gaps, ordered by unit, text hash and id.

    Null ids are hashed like any other value; identical rows share a unit and get
    different slots. A single shard takes all rows. An empty table gives no rows.
    Other columns are ignored. The driver gets the sums of at most 2 ** 14 cells
    plus 4 x ``quanta`` parts; rows are shuffled once, without their texts.
    """
    text = text_of(f"`{text_column}`")
    narrow = checkpointed(
        docs.select(
            *named(id=id_column),
            (F.coalesce(F.octet_length(F.col(f"`{text_column}`").cast("string")), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("position"),
        ).withColumn("own", F.xxhash64(F.col("id").cast("string"), "position", "size"))
    )
    cell = _low_bits(F.col("position"), CELL_BITS)
    cells = narrow.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    total = sum(row["size"] for row in cells)
    quantum, rows_quantum = max(1, total // quanta), max(1, sum(row["n"] for row in cells) // quanta)
    parts = {row["cell"]: max(-(-row["size"] // quantum), -(-row["n"] // rows_quantum)) for row in cells}
    heavy = {at: min(1 << 20, count) for at, count in parts.items() if count > 1}
    spark = docs.sparkSession
    cuts = spark.createDataFrame(sorted(heavy.items()), "cell int, parts int")
    placed = narrow.withColumn("cell", cell).join(F.broadcast(cuts), "cell", "left").withColumn(
        "part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod("own", F.col("parts").cast("long"))).cast("int")
    )
    sums = placed.groupBy("cell", "part").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sums.sort(key=lambda row: (row["cell"], row["part"]))
    units = [(row["cell"] << (64 - CELL_BITS), row["size"]) for row in sums]
    chosen = walk(units, shards, total / shards * (1 + slack), virtual_nodes)
    taken = [0] * shards
    plan = []
    for unit, (row, shard) in enumerate(zip(sums, chosen, strict=True)):
        plan.append((row["cell"], row["part"], unit, shard, taken[shard]))
        taken[shard] += row["n"]
    where = spark.createDataFrame(plan, "cell int, part int, unit int, shard int, first long")
    order = Window.partitionBy("unit").orderBy("position", "id", "text_crc32", "size")
    return placed.join(F.broadcast(where), ["cell", "part"]).select(
        "id", "size", "text_crc32", "shard",
        (F.col("first") + F.row_number().over(order) - 1).alias("slot"), "unit",
    )
