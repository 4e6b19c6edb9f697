"""Raw records -> canonical records, with violations instead of a crash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.json_text import canonical_context, context_json, null_paths, quote
from ledgerloom.functions.text import SPACE, decision_text, squeeze, squeeze_lines

REQUIRED = ("instruction", "context", "output", "category")
COLUMNS = ("id", "instruction", "context", "output", "category", "source")


def semantic_key(category: Column, context: Column, instruction: Column, output: Column) -> Column:
    """Sorted-key JSON of the four fields that make two records the same."""
    pieces = (
        ("category", quote(category)),
        ("context", context),
        ("instruction", quote(instruction)),
        ("output", quote(output)),
    )
    body: list[Column] = []
    for at, (name, value) in enumerate(pieces):
        body += [F.lit(("{" if at == 0 else ", ") + f'"{name}": '), value]
    return F.concat(*body, F.lit("}"))


def content_id(category: Column, context: Column, instruction: Column, output: Column) -> Column:
    """``{category}-`` and the first 16 hex digits of the key's md5."""
    digest = F.md5(semantic_key(category, context, instruction, output))
    return F.concat(category, F.lit("-"), F.substring(digest, 1, 16))


def _context_columns(df: DataFrame) -> tuple[Column, Column]:
    """Canonical context text and the list of what is wrong with it."""
    kind = df.schema["context"].dataType
    raw = F.col("context")
    if isinstance(kind, T.StructType):
        nulls = F.transform(
            null_paths(raw, kind), lambda path: F.concat(F.lit("null found in "), path)
        )
        problems = F.when(raw.isNull(), F.array(F.lit("context is missing"))).otherwise(nulls)
        return context_json("context", kind), problems
    text = raw if isinstance(kind, T.StringType) else F.to_json(raw)
    checked = canonical_context(text)
    return checked["json"], checked["problems"]


def canonical_records(
    df: DataFrame, source: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Normalise every field and list each record's ``violations``.

    ``context`` may be a struct (handled by generated expressions) or free-form
    JSON text, a variant or a map (handled by one Arrow UDF). Other columns are
    dropped unless named in ``keep``, which is how ordinals travel along. The
    id of a record without one is the hash of its content, taken before a bare
    output is wrapped into a decision.
    """
    missing = sorted(set(REQUIRED) - set(df.columns))
    if missing:
        raise ValueError(f"records lack the required columns {missing}")
    context, problems = _context_columns(df)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    given_id = squeeze(text("id")) if "id" in df.columns else F.lit("")
    if source is not None:
        origin = F.lit(source)
    elif "source" in df.columns:
        origin = F.nullif(squeeze(text("source")), F.lit(""))
    else:
        origin = F.lit(None).cast("string")
    # What is wrong is read off the raw columns, where a filter on it is cheap;
    # squeezing changes neither of these markers.
    bare = ~text("output").rlike(rf"(?U)^{SPACE}*+Decision:")
    found = F.array_compact(
        F.array(
            *[
                F.when(F.col(name).isNull(), f"{name} is missing")
                for name in REQUIRED
                if name != "context"
            ],
            F.when(
                ~text("instruction").rlike(rf"(?U)[^{SPACE[1:]}"),
                "instruction is empty",
            ),
            F.when(~bare & ~text("output").contains("Reason:"), "output has no reason line"),
        )
    )
    clean = df.select(
        given_id.alias("id"),
        squeeze(text("instruction")).alias("instruction"),
        context.alias("context"),
        squeeze_lines(text("output")).alias("output"),
        squeeze(text("category")).alias("category"),
        origin.alias("source"),
        F.concat(problems, found).alias("violations"),
        bare.alias("_bare"),
        *keep,
    )
    hashed = content_id(*[F.col(name) for name in ("category", "context", "instruction", "output")])
    wrapped = decision_text(F.lit("ANSWER"), F.col("output"))
    return clean.select(
        F.when(F.col("id") == "", hashed).otherwise(F.col("id")).alias("id"),
        "instruction",
        "context",
        F.when(F.col("_bare"), wrapped).otherwise(F.col("output")).alias("output"),
        "category",
        "source",
        "violations",
        *keep,
    )


def accepted(records: DataFrame) -> DataFrame:
    """Records without violations."""
    return records.filter(F.size("violations") == 0).drop("violations")


def rejected(records: DataFrame) -> DataFrame:
    """Records with violations, for a quarantine table."""
    return records.filter(F.size("violations") > 0)


def strict(records: DataFrame) -> DataFrame:
    """All records; the job fails on the first one with a violation."""
    message = F.concat(F.lit("record "), F.col("id"), F.lit(": "), F.array_join("violations", "; "))
    checked = F.when(F.size("violations") == 0, F.col("id")).otherwise(
        F.raise_error(message).cast("string")
    )
    return records.withColumn("id", checked).drop("violations")
