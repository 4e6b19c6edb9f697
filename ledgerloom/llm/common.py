"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def named(**columns: Column | str) -> list[Column]:
    """Select list from parameters; plain names are quoted, so dots and clashes are harmless."""
    return [(F.col(f"`{value}`") if isinstance(value, str) else value).alias(name) for name, value in columns.items()]


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return to_arrow_type(df.schema[name].dataType)


_HELD: dict[Hashable, Any] = {}


def release(keep: Hashable = None) -> None:
    """Give back what the worker holds for other operators than ``keep``."""
    if _HELD.keys() - {keep}:
        for key in _HELD.keys() - {keep}:
            del _HELD[key]
        pa.default_memory_pool().release_unused()


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """The worker's one large object, kept between its tasks until another operator's tasks come.

    Spark uses Python workers again for later stages; the caches of an operator
    that is done would else sit beside those of the next one.
    """
    release(key)
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def over_batches(
    rows: Callable[[pa.RecordBatch], dict[str, list | pa.Array]], schema: pa.Schema, size: int = 512,
    keep: Hashable = None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from one that turns a batch of up to ``size`` rows into columns.

    Memory holds one batch at a time, and of the objects held between tasks only ``keep``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep)
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                columns = rows(batch.slice(start, size))
                yield pa.RecordBatch.from_arrays(
                    [
                        value if isinstance(value, pa.Array) else pa.array(value, field.type)
                        for field, value in ((field, columns[field.name]) for field in schema)
                    ],
                    schema=schema,
                )

    return run


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """``df`` cut into ranges of ``order`` and sorted, as a checkpoint that keeps its partitions.

    Partition k + 1 goes on where partition k ends. Rows that agree in all of
    ``order`` are dealt out by where they were read, so a key of any size is cut
    like all others; they may stand in any order among themselves.
    """
    shared_folder(df.sparkSession)
    dealt = df.withColumn("_read", F.monotonically_increasing_id())
    return dealt.repartitionByRange(*order, "_read").sortWithinPartitions(*order, "_read").drop("_read").checkpoint()


def numbered_in_order(df: DataFrame, number: str, *order: str) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1 without gaps.

    Rows are counted per sorted partition; the driver adds up one count per
    partition, and each row adds its place inside the partition.
    """
    rows = in_order(df, *order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    before, total = [], 0
    for part, count in sorted(rows.groupBy("_part").count().collect()):
        before.append((part, total))
        total += count
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before long")
    inside = F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33)
    return rows.join(F.broadcast(offsets), "_part").withColumn(number, F.col("_before") + inside + 1).drop("_part", "_at", "_before")
