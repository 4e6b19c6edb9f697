"""Reproducible random draws that do not depend on partitioning.

Each draw hashes (seed, row index, field name), so a re-run task or another
partition count gives the same value. ``rand(seed)`` has no such property.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import sql_text


def order_key(seed: int, row_id: Column) -> Column:
    """Hex sort key of a seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))


class Draws:
    """SQL for the draws of one seed and one row-index column.

    SQL text rather than columns: fields may refer to fields drawn before them,
    and bounds such as ``budget * 0.35D`` read as they are meant.
    """

    def __init__(self, seed: int, index: str):
        self.seed = seed
        self.index = index

    def unit(self, field: str) -> str:
        """Uniform in [0, 1) with 32 bits."""
        digest = f"md5(concat_ws('|', '{self.seed}', cast({self.index} AS STRING), '{field}'))"
        return f"(cast(conv(substring({digest}, 1, 8), 16, 10) AS DOUBLE) / 4294967296D)"

    def uniform(self, field: str, low: float | str, high: float | str) -> str:
        """Uniform between two bounds, rounded to cents."""
        start, stop = (at if isinstance(at, str) else f"{float(at)}D" for at in (low, high))
        exact = f"({start}) + (({stop}) - ({start})) * {self.unit(field)}"
        return f"floor(({exact}) * 100D + 0.5D) / 100D"

    def integer(self, field: str, low: int, high: int) -> str:
        """Whole number, both ends included."""
        return f"{low}L + floor({self.unit(field)} * {high - low + 1}D)"

    def choice(self, field: str, options: Sequence[str]) -> str:
        listed = ", ".join(sql_text(option) for option in options)
        return f"element_at(array({listed}), cast(floor({self.unit(field)} * {len(options)}D) AS INT) + 1)"

    def flag(self, field: str) -> str:
        return f"{self.unit(field)} < 0.5D"
