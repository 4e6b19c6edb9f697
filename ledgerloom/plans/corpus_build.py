"""The dataset build: raw records -> merged, unique, rendered, split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions.json_text import indented
from ledgerloom.operators.corpus import TARGET_ROWS, category_source_counts, exact_dedup, merge
from ledgerloom.operators.records import accepted, canonical_records
from ledgerloom.operators.render import SYSTEM_TEXT, enriched, length_stats
from ledgerloom.operators.split import stratified_split
from ledgerloom.session import checkpointed
from ledgerloom.sources.files import POSITION, read_records, write_splits, write_summary

SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class Corpus:
    """``records`` carries a ``split`` column; the others are small summaries. ``write_build`` writes all of it."""

    records: DataFrame
    merge_summary: DataFrame
    counts: DataFrame
    split_sizes: DataFrame
    token_stats: DataFrame | None
    ratios: Sequence[float]


def merged_records(frames: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Canonical, valid records of all frames, in frame order, repeats included."""
    return merge([accepted(canonical_records(frame, keep=order)) for frame in frames])


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written once, and how many rows it had; they are counted while they are written."""
    seen = Observation()
    written = checkpointed(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return written, seen.get["rows"]


def build_corpus(
    frames: Sequence[DataFrame],
    order: Sequence[str] = POSITION,
    ratios: Sequence[float] = (0.8, 0.1, 0.1),
    seed: int = 42,
    context_text: Callable[[Column], Column] = indented,
    token_count: Callable[[Column], Column] | None = None,
    system_text: str = SYSTEM_TEXT,
) -> Corpus:
    """Merge, keep the first of equal records, split exactly, and render.

    The canonical records are written to the checkpoint folder once: both passes
    of de-duplication read them again, and the count before it comes from there.
    The unique ones are written too, for the two passes of the split and the
    summaries. Rendering comes last and is a projection, so its large texts are
    never shuffled; with a token counter its result is written as well, so that
    no text is rendered and counted twice.
    """
    everything, before = _counted(merged_records(frames, order))
    unique, after = _counted(exact_dedup(everything, ["source_ord", *order]))
    labelled = stratified_split(unique, ratios, seed, tie_break=("source_ord", *order))
    records = enriched(labelled, context_text, token_count, system_text)
    stats = None
    if token_count is not None:
        records = checkpointed(records)
        stats = length_stats(records, F.col("token_count"))
    return Corpus(
        records=records.drop("source_ord", *order),
        merge_summary=unique.sparkSession.createDataFrame(
            [(before, after, after >= TARGET_ROWS)],
            "before_deduplication bigint, after_deduplication bigint, target_met boolean",
        ),
        counts=category_source_counts(unique),
        split_sizes=labelled.groupBy("split").agg(F.count("*").alias("rows")),
        token_stats=stats,
        ratios=tuple(ratios),
    )


def write_build(
    built: Corpus, path: str, sources: Sequence[str] = (), tokenizer: str | None = None, mode: str = "errorifexists"
) -> DataFrame:
    """Write the splits to ``path/records``, then one report object to ``path/report``; the report as a one-row frame.

    Sizes of the splits and token figures are taken in the pass that writes the
    records, so nothing is scanned for them; category and source counts read two
    columns. The report is published last: where it stands, the data is complete.
    Token figures are null without a token counter or without records; a record
    without a category or source counts as ``unknown``. Category and source names
    are gathered in one row, as the report lists them all.
    """
    seen = Observation()
    metrics = [F.count(F.when(F.col("split") == name, 1)).alias(name) for name in SPLITS]
    if "token_count" in built.records.columns:
        count = F.col("token_count").cast("bigint")
        metrics += [F.min(count).alias("least"), F.max(count).alias("most"), F.sum(count).alias("all"), F.count(count).alias("counted")]
    write_splits(built.records.observe(seen, *metrics), f"{path}/records", mode)
    found = seen.get
    average = round(found["all"] / found["counted"], 2) if found.get("counted") else None
    merged = built.merge_summary.first()

    def by_name(kind: str) -> Column:
        named = F.collect_list(F.when(F.col("kind") == kind, F.struct("name", "rows")))
        return F.map_from_entries(F.sort_array(named))

    def struct(names: Sequence[str], values: Sequence, kind: str) -> Column:
        return F.struct(*[F.lit(value).cast(kind).alias(name) for name, value in zip(names, values, strict=True)])

    tokens = struct(("min", "max"), (found.get("least"), found.get("most")), "bigint")
    report = built.counts.groupBy("kind", "name").agg(F.sum("rows").alias("rows")).agg(
        *[F.lit(merged[name]).alias(name) for name in built.merge_summary.columns],
        F.struct(
            F.coalesce(F.max(F.when(F.col("kind") == "total", F.col("rows"))), F.lit(0)).alias("samples"),
            by_name("category").alias("categories"), by_name("source").alias("sources"),
        ).alias("dataset_summary"),
        F.lit(list(sources)).cast("array<string>").alias("sources"),
        struct(SPLITS, [found[name] for name in SPLITS], "bigint").alias("split_sizes"),
        struct(SPLITS, built.ratios, "double").alias("ratios"),
        F.lit(tokenizer).cast("string").alias("tokenizer_id"),
        tokens.withField("avg", F.lit(average).cast("double")).alias("token_stats"),
    )
    report = checkpointed(report)
    write_summary(report, f"{path}/report", mode)
    return report


def build_from_files(spark, paths: Sequence[str], **options) -> Corpus:
    """The build over canonical JSONL files, first path first."""
    return build_corpus([read_records(spark, path) for path in paths], **options)
