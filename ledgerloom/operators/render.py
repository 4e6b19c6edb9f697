"""Prompt and training text, token truncation, and length statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.json_text import indented
from ledgerloom.functions.text import round_exact

SYSTEM_TEXT = (
    "Judge the case below by the figures and rules it states. Answer in two lines, "
    "the first starting with 'Decision:' and the second with 'Reason:'."
)

# The turn markers of the chat format.
BEGIN = "<|begin_of_text|>"
HEADER = "<|start_header_id|>{role}<|end_header_id|>\n"
END_TURN = "<|eot_id|>"


def prompt(instruction: Column, context_text: Column, system_text: str = SYSTEM_TEXT) -> Column:
    """System turn, user turn with the context, and an open assistant turn."""
    opening = BEGIN + HEADER.format(role="system") + system_text + "\n"
    opening += END_TURN + HEADER.format(role="user") + "Instruction: "
    closing = "\n" + END_TURN + HEADER.format(role="assistant")
    return F.concat(
        F.lit(opening), instruction, F.lit("\nContext:\n"), context_text, F.lit(closing)
    )


def training_text(prompt_text: Column, output: Column) -> Column:
    return F.concat(prompt_text, output, F.lit("\n" + END_TURN))


def enriched(
    records: DataFrame,
    context_text: Callable[[Column], Column] = indented,
    token_count: Callable[[Column], Column] | None = None,
    system_text: str = SYSTEM_TEXT,
) -> DataFrame:
    """Records plus ``prompt``, ``text`` and, with a counter, ``token_count``.

    ``context_text`` turns the canonical context into prompt text (indented by
    default; the identity keeps it compact and inside the JVM). ``token_count``
    is any column function, for example a pandas UDF around a tokenizer.
    """
    shown = records.withColumn(
        "prompt", prompt(F.col("instruction"), context_text(F.col("context")), system_text)
    )
    full = shown.withColumn("text", training_text(F.col("prompt"), F.col("output")))
    return full if token_count is None else full.withColumn("token_count", token_count(F.col("text")))


def length_stats(df: DataFrame, length: Column, by: Sequence[str] = (), *more: Column) -> DataFrame:
    """Smallest, largest and average length; nulls where nothing was counted. ``more`` adds aggregates to the pass."""
    stats = df.groupBy(*by).agg(
        F.min(length).cast("bigint").alias("min"),
        F.max(length).cast("bigint").alias("max"),
        F.avg(length).alias("avg"),
        *more,
    )
    return stats.withColumn("avg", round_exact(F.col("avg"), 2))


def token_rows(
    df: DataFrame, tokens: Column, max_length: int = 2048, keep: Sequence[str] = ()
) -> DataFrame:
    """Model columns only: truncated token ids and labels equal to them."""
    return df.select(*keep, F.slice(tokens, 1, max_length).alias("input_ids")).withColumn(
        "labels", F.col("input_ids")
    )
