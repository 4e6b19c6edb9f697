"""Decision labels, their three buckets, and confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import BLANKS, has_words, round_exact

# Label buckets and hedging words.
APPROVE_LABELS = (
    "APPROVE", "ALLOW", "DEDUCTIBLE", "NO_ALERT", "NORMAL", "HEALTHY", "BUY", "PASS",
    "ACCRETIVE", "WITHIN_BUDGET",
)
REJECT_LABELS = (
    "REJECT", "DENY", "DECLINE", "NON_DEDUCTIBLE", "ALERT", "OUTLIER", "AVOID", "FAIL",
    "DISTRESSED", "DILUTIVE", "FRAUD",
)
HEDGES = ("maybe", "unclear", "likely", "possibly", "appears", "suggests", "estimate")

# How a response spells its parts.
DECISION_PATTERN = rf"Decision:[{BLANKS}]*([^\n]+)"
REASON_PATTERN = rf"Reason:[{BLANKS}]*([^\n]+)"
CONFIDENCE_PATTERN = rf"Confidence:[{BLANKS}]*([01](?:\.\d+)?)"


def canonical_label(label: Column) -> Column:
    """UPPER_SNAKE form; nothing left over means UNKNOWN.

    White space needs no squeezing first: like all else that is neither letter
    nor digit it ends up in an underscore.
    """
    snake = F.regexp_replace(F.upper(label), "[^A-Z0-9]++", "_")
    return F.coalesce(F.nullif(F.btrim(snake, F.lit("_")), F.lit("")), F.lit("UNKNOWN"))


def bucket_of_canonical(label: Column) -> Column:
    """approve / reject / review for a label that is canonical already."""
    return (
        F.when(label.isin(*APPROVE_LABELS) | label.startswith("APPROVE"), "approve")
        .when(label.isin(*REJECT_LABELS) | label.startswith("REJECT"), "reject")
        .otherwise("review")
    )


def decision_bucket(label: Column) -> Column:
    return bucket_of_canonical(canonical_label(label))


def confidence(label: Column, explanation: Column) -> Column:
    """Heuristic confidence of a canonical label and its explanation."""
    lowered = F.lower(explanation)
    hedged = F.lit(False)
    for hedge in HEDGES:
        hedged = hedged | lowered.contains(hedge)
    score = (
        F.lit(0.56)
        + F.when((label != "") & (label != "UNKNOWN"), 0.14).otherwise(0.0)
        + F.when(has_words(explanation, 10), 0.10).otherwise(0.0)
        + F.when(has_words(explanation, 20), 0.06).otherwise(0.0)
        - F.when(hedged, 0.12).otherwise(0.0)
        + F.when(bucket_of_canonical(label) != "review", 0.05).otherwise(0.0)
    )
    return round_exact(F.least(F.greatest(score, F.lit(0.05)), F.lit(0.99)), 4)
