"""Bulk generation of decision scenarios.

Index ``i`` belongs to category ``i % 12``. Each category is one projection over
the indices it owns (``spark.range`` with a step of 12, so nothing is generated
to be filtered away), and every field is a hash draw of (seed, index, field).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.draws import Draws
from ledgerloom.functions.json_text import context_json
from ledgerloom.functions.text import decision_text
from ledgerloom.operators import wording
from ledgerloom.operators.rules import verdict
from ledgerloom.operators.split import shuffled

ROWS_PER_TASK = 20_000

# Each step maps field names to SQL; a step may refer to fields of earlier steps.
Fields = dict[str, str]


def _budget(draw: Draws) -> list[Fields]:
    return [
        {"budget": draw.uniform("budget", 500, 12_000)},
        {
            "remaining": draw.uniform("remaining", 0, "budget"),
            "amount": draw.uniform("amount", 25, "greatest(50D, budget * 0.35D)"),
            "purchase": draw.choice("purchase", wording.PURCHASES),
            "department": draw.choice("department", wording.DEPARTMENTS),
        },
    ]


def _expense(draw: Draws) -> list[Fields]:
    vendors = [vendor for vendor, _ in wording.VENDOR_BUCKETS]
    buckets = [bucket for _, bucket in wording.VENDOR_BUCKETS]
    return [
        {
            "vendor": draw.choice("vendor", vendors),
            "bucket": draw.choice("vendor", buckets),
            "amount": draw.uniform("amount", 40, 5_000),
            "team": draw.choice("team", wording.DEPARTMENTS),
        },
        {"memo": "concat(vendor, ' renewal or payment')"},
    ]


def _fraud(draw: Draws) -> list[Fields]:
    return [
        {
            "amount": draw.uniform("amount", 20, 8_000),
            "velocity_24h": draw.integer("velocity_24h", 1, 9),
            "geo_mismatch": draw.flag("geo_mismatch"),
            "new_device": draw.flag("new_device"),
            "after_hours": draw.flag("after_hours"),
            "card_present": draw.flag("card_present"),
        }
    ]


def _policy(draw: Draws) -> list[Fields]:
    return [
        {
            "amount": draw.uniform("amount", 20, 7_500),
            "policy_limit": draw.uniform("policy_limit", 500, 5_000),
            "vendor_approved": draw.flag("vendor_approved"),
            "receipt_attached": draw.flag("receipt_attached"),
            "expense_type": draw.choice("expense_type", wording.POLICY_EXPENSES),
        },
        {
            "manager_approval_required": "amount > 1000",
            "manager_approved": f"amount <= 1000 OR {draw.flag('manager_approved')}",
        },
    ]


def _tax(draw: Draws) -> list[Fields]:
    return [
        {
            "expense_type": draw.choice("expense_type", wording.TAX_EXPENSES),
            "amount": draw.uniform("amount", 30, 3_500),
            "business_use_percent": draw.integer("business_use_percent", 0, 100),
            "receipt_attached": draw.flag("receipt_attached"),
            "jurisdiction": "'US'",
        }
    ]


def _spend(draw: Draws) -> list[Fields]:
    return [
        {
            "budget": draw.uniform("budget", 2_000, 50_000),
            "actual_spend": draw.uniform("actual_spend", 1_000, 60_000),
            "period": draw.choice("period", wording.PERIODS),
            "cost_center": draw.choice("cost_center", wording.COST_CENTERS),
        },
        {"forecast_spend": draw.uniform("forecast_spend", "actual_spend - 2500D", "actual_spend + 8000D")},
    ]


def _investment(draw: Draws) -> list[Fields]:
    return [
        {
            "industry": draw.choice("industry", wording.INDUSTRIES),
            "revenue_growth_pct": draw.uniform("revenue_growth_pct", -15, 45),
            "gross_margin_pct": draw.uniform("gross_margin_pct", 20, 85),
            "net_margin_pct": draw.uniform("net_margin_pct", -25, 30),
            "debt_to_ebitda": draw.uniform("debt_to_ebitda", 0, 6),
            "valuation_multiple_ev_revenue": draw.uniform("valuation_multiple", 3, 20),
            "peer_multiple_ev_revenue": draw.uniform("peer_multiple", 4, 16),
            "free_cash_flow_positive": draw.flag("free_cash_flow_positive"),
        }
    ]


def _loan(draw: Draws) -> list[Fields]:
    return [
        {
            "loan_amount": draw.uniform("loan_amount", 25_000, 1_500_000),
            "dscr": draw.uniform("dscr", 0.7, 2.4),
            "collateral_coverage": draw.uniform("collateral_coverage", 0.5, 2.2),
            "fico_score": draw.integer("fico_score", 540, 820),
            "recent_delinquencies": draw.integer("recent_delinquencies", 0, 4),
            "leverage_ratio": draw.uniform("leverage_ratio", 1.0, 6.0),
        }
    ]


def _ratios(draw: Draws) -> list[Fields]:
    return [
        {
            "current_ratio": draw.uniform("current_ratio", 0.6, 3.0),
            "quick_ratio": draw.uniform("quick_ratio", 0.4, 2.6),
            "debt_to_equity": draw.uniform("debt_to_equity", 0.1, 3.5),
            "interest_coverage": draw.uniform("interest_coverage", 0.3, 10.0),
            "operating_margin_pct": draw.uniform("operating_margin_pct", -12, 35),
        }
    ]


def _batch(draw: Draws) -> list[Fields]:
    vendors = [vendor for vendor, _ in wording.VENDOR_BUCKETS]
    lines = [
        f"named_struct('amount', {draw.uniform(f'amount_{at}', 150, 'budget * 0.18D')},"
        f" 'type', {draw.choice(f'type_{at}', wording.TRANSACTION_TYPES)},"
        f" 'vendor', {draw.choice(f'vendor_{at}', vendors)})"
        for at in range(5)
    ]
    return [
        {
            "budget": draw.uniform("budget", 5_000, 60_000),
            "_lines": draw.integer("lines", 2, 5),
        },
        {
            "committed_spend": draw.uniform("committed_spend", 0, "budget * 0.8D"),
            "transactions": f"slice(array({', '.join(lines)}), 1, cast(_lines AS INT))",
        },
    ]


def _anomaly(draw: Draws) -> list[Fields]:
    return [
        {
            "baseline_mean_amount": draw.uniform("baseline_mean", 200, 5_000),
            "recurring_vendor": draw.flag("recurring_vendor"),
        },
        {
            "baseline_std_amount": draw.uniform(
                "baseline_std", 20, "greatest(50D, baseline_mean_amount * 0.35D)"
            ),
            "observed_amount": draw.uniform("observed", 20, "baseline_mean_amount * 4D"),
        },
    ]


def _deal(draw: Draws) -> list[Fields]:
    return [
        {
            "purchase_price": draw.uniform("purchase_price", 10_000_000, 250_000_000),
            "expected_synergies": draw.uniform("expected_synergies", 500_000, 20_000_000),
            "target_ebitda": draw.uniform("target_ebitda", 1_000_000, 30_000_000),
            "financing_cost_pct": draw.uniform("financing_cost_pct", 3, 12),
            "equity_dilution_pct": draw.uniform("equity_dilution_pct", 0, 18),
            "post_close_leverage": draw.uniform("post_close_leverage", 1.2, 6.0),
        }
    ]


class Scenario:
    """How one category draws its fields and which rule judges them."""

    def __init__(
        self,
        rule: str,
        draw: Callable[[Draws], list[Fields]],
        renamed: dict[str, str] | None = None,
        facts: tuple[str, ...] = (),
        hidden: tuple[str, ...] = (),
    ):
        self.rule = rule
        self.draw = draw
        self.renamed = renamed or {}
        self.facts = facts
        self.hidden = hidden


SCENARIOS: dict[str, Scenario] = {
    "budget_reasoning": Scenario("budget", _budget),
    "expense_classification": Scenario("expense", _expense, hidden=("bucket",)),
    "fraud_detection": Scenario("fraud", _fraud),
    "policy_compliance": Scenario("policy", _policy),
    "tax_deduction_advice": Scenario("tax", _tax),
    "spending_alerts": Scenario("spend_alert", _spend, facts=("variance_pct",)),
    "investment_analysis": Scenario(
        "investment",
        _investment,
        renamed={
            "valuation_multiple": "valuation_multiple_ev_revenue",
            "peer_multiple": "peer_multiple_ev_revenue",
        },
    ),
    "loan_evaluation": Scenario("loan", _loan),
    "financial_ratios": Scenario("ratios", _ratios),
    "multi_transaction_budgeting": Scenario(
        "batch", _batch, facts=("remaining_budget", "proposed_total"), hidden=("_lines",)
    ),
    "anomaly_detection": Scenario(
        "anomaly",
        _anomaly,
        renamed={
            "baseline_mean": "baseline_mean_amount",
            "baseline_std": "baseline_std_amount",
            "observed": "observed_amount",
            "recurring": "recurring_vendor",
        },
        facts=("z_score",),
    ),
    "corporate_finance_reasoning": Scenario("deal", _deal),
}


def typed_scenarios(indices: DataFrame, category: str, seed: int = 42, index: str = "id") -> DataFrame:
    """One category's scenarios with a struct context, one row per index."""
    scenario = SCENARIOS[category]
    frame = indices.select(F.col(index).alias("_index"))
    draw = Draws(seed, "_index")
    names: list[str] = []
    for step in scenario.draw(draw):
        frame = frame.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in step.items()])
        names += list(step)
    found = verdict(scenario.rule, **scenario.renamed)
    frame = frame.withColumns({name: found.facts[name] for name in scenario.facts})
    shown = sorted((set(names) | set(scenario.facts)) - set(scenario.hidden))
    return frame.select(
        F.format_string(f"{category}-%06d", F.col("_index")).alias("id"),
        F.struct(*shown).alias("context"),
        decision_text(found.decision, found.reason).alias("output"),
        found.decision.alias("decision"),
    )


def scenarios(indices: DataFrame, category: str, seed: int = 42, index: str = "id") -> DataFrame:
    """One category's scenarios as canonical records (context as canonical JSON)."""
    typed = typed_scenarios(indices, category, seed, index)
    kind = typed.schema["context"].dataType
    return typed.select(
        "id",
        F.lit(wording.INSTRUCTIONS[category]).alias("instruction"),
        context_json("context", kind).alias("context"),
        F.col("output"),
        F.lit(category).alias("category"),
        F.lit("synthetic").alias("source"),
    )


def generate(spark: SparkSession, size: int, seed: int = 42, shuffle: bool = True) -> DataFrame:
    """``size`` scenarios, balanced over the categories, in seeded random order.

    Tasks are sized by rows: each has to set up its category's long projection,
    which should not cost more than the rows it makes.
    """
    categories = list(SCENARIOS)
    tasks = max(1, math.ceil(size / len(categories) / ROWS_PER_TASK))
    parts = [
        scenarios(spark.range(at, size, len(categories), tasks), category, seed)
        for at, category in enumerate(categories)
    ]
    everything = reduce(DataFrame.unionByName, parts)
    return shuffled(everything, seed) if shuffle else everything
