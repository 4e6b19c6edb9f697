"""Streaming form of the decision request: files in, decisions out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.render import SYSTEM_TEXT
from ledgerloom.operators.responses import decide

REQUEST_SCHEMA = "id STRING, instruction STRING, context STRING"


def read_requests(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Request files (JSONL) as they arrive."""
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def start_decisions(
    requests: DataFrame,
    generate: Callable[[Column], Column],
    output: str,
    checkpoint: str,
    available_now: bool = False,
    system_text: str = SYSTEM_TEXT,
) -> StreamingQuery:
    """Decide every arriving request and append the result as Parquet.

    Stateless, so a restart from ``checkpoint`` continues where it stopped and
    the file sink keeps each batch exactly once. ``checkpoint`` and ``output``
    must be folders all executors share.
    """
    writer = (
        decide(requests, generate, system_text)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
