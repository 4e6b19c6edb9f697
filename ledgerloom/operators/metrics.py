"""Evaluation of predicted responses against gold records.

Both sides are parsed before they meet, so the join moves labels and
fingerprints rather than whole texts. A gold record without a prediction counts
as an empty response.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import comparable
from ledgerloom.operators.responses import explanation, raw_decision

BUDGET_CATEGORIES = ("budget_reasoning", "multi_transaction_budgeting")


def scored(gold: DataFrame, predictions: DataFrame, with_text: bool = False) -> DataFrame:
    """Per-record results: labels and match flags, optionally the explanations.

    There is one result per gold record: of several predictions with one id the
    least by label, fingerprint and explanation counts.
    """

    def side(text: str, prefix: str) -> list[Column]:
        columns = [
            raw_decision(F.col(text)).alias(f"{prefix}_decision"),
            F.sha2(comparable(F.col(text)), 256).alias(f"_{prefix}_print"),
        ]
        if with_text:
            columns.append(explanation(F.col(text)).alias(f"{prefix}_explanation"))
        return columns

    truth = gold.select("id", "category", *side("output", "expected"))
    said = predictions.select("id", *side("response", "predicted"))
    least = said.groupBy("id").agg(F.min(F.struct(*said.columns[1:])).alias("_least"))
    answers = least.select("id", "_least.*")
    empty = F.sha2(F.lit(""), 256)
    joined = truth.join(answers, "id", "left").withColumn(
        "predicted_decision", F.coalesce("predicted_decision", F.lit("UNKNOWN"))
    )
    if with_text:
        joined = joined.withColumn(
            "predicted_explanation", F.coalesce("predicted_explanation", F.lit(""))
        )
    return (
        joined.withColumn("decision_match", F.col("expected_decision") == F.col("predicted_decision"))
        .withColumn(
            "exact_match", F.col("_expected_print") == F.coalesce("_predicted_print", empty)
        )
        .drop("_expected_print", "_predicted_print")
    )


def _share(hits: Column, of: Column) -> Column:
    return hits / F.greatest(of, F.lit(1))


def _of(results: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    return results if categories is None else results.filter(F.col("category").isin(*categories))


def accuracy(results: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Share of records whose canonical labels agree."""
    return _of(results, categories).agg(
        F.count("*").alias("samples"),
        _share(F.count_if("decision_match"), F.count("*")).alias("accuracy"),
    )


def reasoning_report(results: DataFrame) -> DataFrame:
    """Label accuracy and exact-text rate."""
    return results.agg(
        F.count("*").alias("samples"),
        _share(F.count_if("decision_match"), F.count("*")).alias("reasoning_accuracy"),
        _share(F.count_if("exact_match"), F.count("*")).alias("exact_match_rate"),
    )


def _recall(label: str) -> Column:
    gold = F.col("expected_decision") == label
    return _share(F.count_if(gold & (F.col("predicted_decision") == label)), F.count_if(gold))


def label_recall(
    results: DataFrame, label: str = "REJECT", categories: Sequence[str] | None = None
) -> DataFrame:
    return _of(results, categories).agg(
        F.count_if(F.col("expected_decision") == label).alias("gold"), _recall(label).alias("recall")
    )


def budget_report(results: DataFrame, categories: Sequence[str] = BUDGET_CATEGORIES) -> DataFrame:
    return _of(results, categories).agg(
        F.count("*").alias("samples"),
        _share(F.count_if("decision_match"), F.count("*")).alias("budget_decision_accuracy"),
        _recall("REJECT").alias("reject_recall"),
    )


def precision_recall_f1(
    results: DataFrame,
    positive: str = "MANUAL_REVIEW",
    categories: Sequence[str] | None = ("fraud_detection",),
) -> DataFrame:
    gold = F.col("expected_decision") == positive
    said = F.col("predicted_decision") == positive
    counts = _of(results, categories).agg(
        F.count("*").alias("samples"),
        _share(F.count_if(gold & said), F.count_if(said)).alias("precision"),
        _share(F.count_if(gold & said), F.count_if(gold)).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / F.greatest(both, F.lit(1e-9)))
    return counts.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def by_category(results: DataFrame, positive: str = "MANUAL_REVIEW", rejecting: str = "REJECT") -> DataFrame:
    """Every metric per category and overall, from one pass over the results."""
    gold = F.col("expected_decision") == positive
    said = F.col("predicted_decision") == positive
    return results.rollup("category").agg(
        F.grouping("category").cast("int").alias("overall"),
        F.count("*").alias("samples"),
        _share(F.count_if("decision_match"), F.count("*")).alias("accuracy"),
        _share(F.count_if("exact_match"), F.count("*")).alias("exact_match_rate"),
        _recall(rejecting).alias("reject_recall"),
        _share(F.count_if(gold & said), F.count_if(said)).alias("precision"),
        _share(F.count_if(gold & said), F.count_if(gold)).alias("recall"),
    )


def pass_rate(scenarios: DataFrame, responses: DataFrame) -> DataFrame:
    """Share of scenarios whose upper-cased response contains the expected label.

    A scenario with several responses passes if all of them do; one without any fails.
    """
    # The labels looked for are few and short, so responses meet them, not the other way
    # round: only a flag per (name, label) goes on to the scenarios.
    wanted = scenarios.select("name", "expected").distinct()
    found = (
        responses.join(wanted, "name")
        .groupBy("name", "expected")
        .agg(F.min(F.upper("response").contains(F.col("expected"))).alias("_found"))
    )
    joined = scenarios.select("name", "expected").join(found, ["name", "expected"], "left")
    passed = F.coalesce(F.col("_found"), F.lit(False))
    return joined.agg(
        F.count("*").alias("scenarios"),
        F.count_if(passed).alias("passed"),
        _share(F.count_if(passed), F.count("*")).alias("pass_rate"),
    )
