"""Decision rules: deterministic column expressions usable on any table.

``apply_rule(df, "fraud", amount="value")`` adds ``decision``, ``reason`` and
the facts the rule derived. Inputs default to columns named like the inputs;
keyword arguments point them at other column names or expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.json_text import float_text
from ledgerloom.functions.text import fill, money, round_exact
from ledgerloom.operators.scale import HOT_ROWS, broadcast_if_small, join_group_facts
from ledgerloom.operators.wording import REASONS, VENDOR_BUCKETS
from ledgerloom.session import checkpointed

DAY_MICROS = 86_400 * 1_000_000
#: Parts into which the velocity's crowded time buckets are cut.
FINER = 1_000


@dataclass(frozen=True)
class Verdict:
    decision: Column
    reason: Column
    facts: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    inputs: tuple[str, ...]
    judge: Callable[..., Verdict]


def _met(*conditions: Column) -> Column:
    """How many of the conditions hold; an unknown one counts as not met."""
    points = [F.coalesce(condition.cast("int"), F.lit(0)) for condition in conditions]
    return sum(points[1:], points[0])


def _lacking(condition: Column) -> Column:
    """True unless the condition is known to hold."""
    return ~F.coalesce(condition, F.lit(False))


def _all(*conditions: Column) -> Column:
    joined = conditions[0]
    for condition in conditions[1:]:
        joined = joined & condition
    return joined


def judge_budget(amount: Column, remaining: Column) -> Verdict:
    difference = round_exact(remaining - amount, 2)
    words = {"amount": money(amount), "remaining": money(remaining)}
    fits = amount <= remaining
    return Verdict(
        F.when(fits, "APPROVE").otherwise("REJECT"),
        F.when(fits, fill(REASONS["budget_approve"], difference=money(difference), **words)).otherwise(
            fill(REASONS["budget_reject"], difference=money(F.abs(difference)), **words)
        ),
        {"difference": difference},
    )


def judge_fraud(
    amount: Column,
    velocity_24h: Column,
    geo_mismatch: Column,
    new_device: Column,
    after_hours: Column,
    card_present: Column,
) -> Verdict:
    score = _met(
        velocity_24h >= 5, geo_mismatch, new_device, after_hours, amount >= 5000, _lacking(card_present)
    )
    risky = score >= 4
    return Verdict(
        F.when(risky, "MANUAL_REVIEW").otherwise("ALLOW"),
        F.when(risky, fill(REASONS["fraud_review"], score=score)).otherwise(
            fill(REASONS["fraud_allow"], score=score)
        ),
        {"risk_score": score},
    )


def judge_policy(
    amount: Column,
    policy_limit: Column,
    vendor_approved: Column,
    receipt_attached: Column,
    manager_approved: Column,
) -> Verdict:
    tests = (
        (_lacking(vendor_approved), F.lit(REASONS["policy_vendor"])),
        (amount > policy_limit, fill(REASONS["policy_limit"], excess=money(amount - policy_limit))),
        ((amount > 1000) & _lacking(manager_approved), F.lit(REASONS["policy_manager"])),
        ((amount > 75) & _lacking(receipt_attached), F.lit(REASONS["policy_receipt"])),
    )
    broken = _met(*[test for test, _ in tests])
    problems = F.concat_ws("; ", *[F.when(test, problem) for test, problem in tests])
    return Verdict(
        F.when(broken > 0, "REJECT").otherwise("APPROVE"),
        F.when(broken > 0, fill(REASONS["policy_reject"], problems=problems)).otherwise(
            REASONS["policy_approve"]
        ),
        {"violations": broken},
    )


def judge_tax(expense_type: Column, business_use_percent: Column, receipt_attached: Column) -> Verdict:
    deductible = (
        (business_use_percent >= 50) & ~expense_type.contains("family vacation") & receipt_attached
    )
    words = {"expense_type": expense_type}
    return Verdict(
        F.when(deductible, "DEDUCTIBLE").otherwise("NON_DEDUCTIBLE"),
        F.when(
            deductible, fill(REASONS["tax_deductible"], percent=business_use_percent, **words)
        ).otherwise(fill(REASONS["tax_not_deductible"], **words)),
    )


def judge_spend(budget: Column, actual_spend: Column, forecast_spend: Column) -> Verdict:
    variance = round_exact(F.try_divide(forecast_spend - budget, budget) * 100, 2)
    over = (actual_spend > budget) | (forecast_spend > budget * 1.05) | (variance > 10)
    words = {"forecast": money(forecast_spend), "budget": money(budget)}
    return Verdict(
        F.when(over, "ALERT").otherwise("NO_ALERT"),
        F.when(over, fill(REASONS["spend_alert"], variance=float_text(variance), **words)).otherwise(
            fill(REASONS["spend_quiet"], **words)
        ),
        {"variance_pct": variance},
    )


def judge_investment(
    revenue_growth_pct: Column,
    gross_margin_pct: Column,
    net_margin_pct: Column,
    debt_to_ebitda: Column,
    valuation_multiple: Column,
    peer_multiple: Column,
    free_cash_flow_positive: Column,
) -> Verdict:
    score = _met(
        revenue_growth_pct >= 15,
        gross_margin_pct >= 50,
        net_margin_pct >= 10,
        debt_to_ebitda <= 2.5,
        valuation_multiple <= peer_multiple,
        free_cash_flow_positive,
    )
    return Verdict(
        F.when(score >= 5, "BUY").when(score >= 3, "HOLD").otherwise("AVOID"),
        F.when(score >= 5, REASONS["invest_buy"])
        .when(score >= 3, REASONS["invest_hold"])
        .otherwise(REASONS["invest_avoid"]),
        {"quality_score": score},
    )


def _three_way(first: Column, second: Column, labels: Sequence[str], reasons: Sequence[str]) -> Verdict:
    def pick(values: Sequence[str]) -> Column:
        return F.when(first, values[0]).when(second, values[1]).otherwise(values[2])

    return Verdict(pick(labels), pick([REASONS[name] for name in reasons]))


def judge_loan(
    dscr: Column,
    collateral_coverage: Column,
    fico_score: Column,
    recent_delinquencies: Column,
    leverage_ratio: Column,
) -> Verdict:
    sound = _all(
        dscr >= 1.3, collateral_coverage >= 1.2, fico_score >= 680, recent_delinquencies == 0
    )
    barred = (dscr < 1.0) | (fico_score < 620) | (recent_delinquencies >= 2) | (leverage_ratio > 4.5)
    return _three_way(
        sound, barred, ("APPROVE", "REJECT", "REVIEW"), ("loan_approve", "loan_reject", "loan_review")
    )


def judge_ratios(
    current_ratio: Column,
    quick_ratio: Column,
    debt_to_equity: Column,
    interest_coverage: Column,
    operating_margin_pct: Column,
) -> Verdict:
    healthy = _all(
        current_ratio >= 1.2,
        quick_ratio >= 1.0,
        debt_to_equity <= 1.5,
        interest_coverage >= 3.0,
        operating_margin_pct >= 8,
    )
    return Verdict(
        F.when(healthy, "HEALTHY").otherwise("DISTRESSED"),
        F.when(healthy, REASONS["ratios_healthy"]).otherwise(REASONS["ratios_distressed"]),
    )


def judge_batch_total(budget: Column, committed_spend: Column, proposed_total: Column) -> Verdict:
    """A batch whose lines are rows: pass in their (exact) sum."""
    remaining = round_exact(budget - committed_spend, 2)
    fits = proposed_total <= remaining
    words = {"total": money(proposed_total), "remaining": money(remaining)}
    return Verdict(
        F.when(fits, "APPROVE").otherwise("REJECT"),
        F.when(fits, fill(REASONS["batch_approve"], **words)).otherwise(
            fill(REASONS["batch_reject"], **words)
        ),
        {"remaining_budget": remaining, "proposed_total": round_exact(proposed_total, 2)},
    )


def judge_batch(budget: Column, committed_spend: Column, transactions: Column) -> Verdict:
    """A batch stands or falls as one; the unrounded sum is what is compared."""
    total = F.aggregate(
        transactions, F.lit(0.0), lambda done, item: done + item["amount"].cast("double")
    )
    return judge_batch_total(budget, committed_spend, total)


def judge_anomaly(
    baseline_mean: Column, baseline_std: Column, observed: Column, recurring: Column
) -> Verdict:
    z = round_exact((observed - baseline_mean) / F.greatest(baseline_std, F.lit(1.0)), 2)
    outlier = (F.abs(z) >= 2.5) & _lacking(recurring)
    words = {"z": float_text(z)}
    return Verdict(
        F.when(outlier, "OUTLIER").otherwise("NORMAL"),
        F.when(outlier, fill(REASONS["anomaly_outlier"], **words)).otherwise(
            fill(REASONS["anomaly_normal"], **words)
        ),
        {"z_score": z},
    )


def judge_deal(
    purchase_price: Column,
    expected_synergies: Column,
    target_ebitda: Column,
    financing_cost_pct: Column,
    equity_dilution_pct: Column,
    post_close_leverage: Column,
) -> Verdict:
    proxy = expected_synergies + target_ebitda * 0.2 - purchase_price * (financing_cost_pct / 100)
    accretive = _all(proxy > 0, equity_dilution_pct <= 8, post_close_leverage <= 4.0)
    dilutive = (proxy < 0) | (post_close_leverage > 5.0) | (equity_dilution_pct > 12)
    return _three_way(
        accretive,
        dilutive,
        ("ACCRETIVE", "DILUTIVE", "REVIEW"),
        ("deal_accretive", "deal_dilutive", "deal_review"),
    )


def judge_expense(vendor: Column, bucket: Column, amount: Column, team: Column) -> Verdict:
    """``bucket`` is the vendor's catalogue entry; without one the label is UNKNOWN."""
    known = F.coalesce(bucket, F.lit("unknown"))
    words = {"amount": money(amount), "vendor": vendor, "bucket": known, "team": team}
    return Verdict(F.upper(known), fill(REASONS["expense"], **words))


RULES: dict[str, Rule] = {
    "budget": Rule(("amount", "remaining"), judge_budget),
    "expense": Rule(("vendor", "bucket", "amount", "team"), judge_expense),
    "fraud": Rule(
        ("amount", "velocity_24h", "geo_mismatch", "new_device", "after_hours", "card_present"),
        judge_fraud,
    ),
    "policy": Rule(
        ("amount", "policy_limit", "vendor_approved", "receipt_attached", "manager_approved"),
        judge_policy,
    ),
    "tax": Rule(("expense_type", "business_use_percent", "receipt_attached"), judge_tax),
    "spend_alert": Rule(("budget", "actual_spend", "forecast_spend"), judge_spend),
    "investment": Rule(
        (
            "revenue_growth_pct", "gross_margin_pct", "net_margin_pct", "debt_to_ebitda",
            "valuation_multiple", "peer_multiple", "free_cash_flow_positive",
        ),
        judge_investment,
    ),
    "loan": Rule(
        ("dscr", "collateral_coverage", "fico_score", "recent_delinquencies", "leverage_ratio"),
        judge_loan,
    ),
    "ratios": Rule(
        (
            "current_ratio", "quick_ratio", "debt_to_equity", "interest_coverage",
            "operating_margin_pct",
        ),
        judge_ratios,
    ),
    "batch": Rule(("budget", "committed_spend", "transactions"), judge_batch),
    "batch_total": Rule(("budget", "committed_spend", "proposed_total"), judge_batch_total),
    "anomaly": Rule(("baseline_mean", "baseline_std", "observed", "recurring"), judge_anomaly),
    "deal": Rule(
        (
            "purchase_price", "expected_synergies", "target_ebitda", "financing_cost_pct",
            "equity_dilution_pct", "post_close_leverage",
        ),
        judge_deal,
    ),
}


def register_rule(name: str, inputs: Sequence[str], judge: Callable[..., Verdict]) -> None:
    """Add a rule of your own next to the built-in ones."""
    RULES[name] = Rule(tuple(inputs), judge)


def verdict(name: str, **inputs: Column | str) -> Verdict:
    rule = RULES[name]
    unknown = set(inputs) - set(rule.inputs)
    if unknown:
        raise ValueError(f"rule {name} has no inputs {sorted(unknown)}")
    given = {at: inputs.get(at, at) for at in rule.inputs}
    return rule.judge(
        **{at: F.col(value) if isinstance(value, str) else value for at, value in given.items()}
    )


def apply_rule(df: DataFrame, name: str, **inputs: Column | str) -> DataFrame:
    """``df`` plus ``decision``, ``reason`` and the rule's derived facts.

    Inputs given as expressions become columns of a projection of their own, so
    each is computed once however often the rule looks at it.
    """
    computed = {f"_input_{at}": value for at, value in inputs.items() if isinstance(value, Column)}
    named = {at: f"_input_{at}" if f"_input_{at}" in computed else value for at, value in inputs.items()}
    found = verdict(name, **named)
    return df.withColumns(computed).select(
        *[F.col(at) for at in df.columns if at not in found.facts],
        *[value.alias(at) for at, value in found.facts.items()],
        found.decision.alias("decision"),
        found.reason.alias("reason"),
    )


def vendor_catalogue(df: DataFrame) -> DataFrame:
    """The built-in vendor catalogue (ten rows, whatever the data) as a table."""
    rows = ", ".join(f"('{vendor}', '{bucket}')" for vendor, bucket in VENDOR_BUCKETS)
    return df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS catalogue(vendor, bucket)")


def classify_expense(
    df: DataFrame,
    vendor: str = "vendor",
    amount: Column | str = "amount",
    team: Column | str = "team",
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """Expense class by equi-join with a (vendor, bucket) catalogue.

    Only the built-in ten-row catalogue is force-broadcast. A catalogue passed
    in is joined without a hint: its size decides at run time. A vendor listed
    more than once counts with the least of its buckets, so rows never multiply.
    """
    if catalogue is None:
        known = F.broadcast(vendor_catalogue(df))
    else:
        known = catalogue.groupBy("vendor").agg(F.min("bucket").alias("bucket"))
    lookup = known.select(F.col("vendor").alias("_vendor"), F.col("bucket"))
    joined = df.join(lookup, F.col(vendor) == F.col("_vendor"), "left").drop("_vendor")
    return apply_rule(joined, "expense", vendor=vendor, amount=amount, team=team)


def with_baseline(
    df: DataFrame, entity: str, amount: str, row_key: Sequence[str], hot_rows: int = 1_000_000
) -> DataFrame:
    """Add ``baseline_mean`` and ``baseline_std`` (population) of an entity's amounts.

    Mean and deviation come from central moments, which partial aggregates merge
    without loss, for amounts of any size. They are combined map-side and joined
    back with hot entities salted, instead of a window that would pull each
    entity's rows into one task. Rows without an entity are an entity of their own.
    """
    value = F.col(amount).cast("double")
    ready = df.groupBy(entity).agg(
        F.count("*").alias("_rows"),
        F.avg(value).alias("baseline_mean"),
        F.stddev_pop(value).alias("baseline_std"),
    )
    return join_group_facts(df, ready, entity, "_rows", row_key, hot_rows).drop("_rows")


def with_velocity(
    df: DataFrame,
    entity: str,
    micros: Column,
    name: str = "velocity_24h",
    span_micros: int = DAY_MICROS,
    bucket_micros: int = 60 * 1_000_000,
    hot_rows: int = HOT_ROWS,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the same entity in the trailing span, this row and ties included.

    A range window over the entity would put all its rows into one task. Here
    rows are first counted per (entity, time bucket), which is combined
    map-side; running totals are taken over those counts only. What is left are
    the two buckets at the ends of the span, and those are resolved by ordering
    rows within one bucket: each row appears once as itself and once, shifted
    by the span, as the mark where it leaves the window. The bucket's running
    total travels as one more mark at its head, so the rows are shuffled once,
    by (entity, bucket), and nothing is joined.

    The counts are written first and show the buckets where over ``hot_rows``
    rows of one entity enter or leave. Those rows are counted per instant, in
    finer buckets (see ``_instants``), and get their counts by a join in which
    hot instants are salted by ``row_key``. Rows without an entity are counted
    together; a row without a time gets null.
    """
    if span_micros % bucket_micros:
        raise ValueError("the span must be a whole number of buckets")
    buckets = span_micros // bucket_micros

    def bucket(at: Column) -> Column:
        return ((at - F.pmod(at, F.lit(bucket_micros))) / F.lit(bucket_micros)).cast("bigint")

    timed = df.withColumn("_at", micros.cast("bigint"))
    timed = timed.withColumn("_bucket", bucket(F.col("_at")))
    known = timed.filter(F.col("_at").isNotNull())
    counts = checkpointed(known.groupBy(entity, "_bucket").agg(F.count("*").alias("_count")))
    along = Window.partitionBy(entity).orderBy("_bucket")
    done = F.sum("_count").over(along.rangeBetween(Window.unboundedPreceding, -1))
    gone = F.sum("_count").over(along.rangeBetween(Window.unboundedPreceding, -buckets - 1))
    heads = counts.select(
        entity, "_bucket", F.lit(None).cast("bigint").alias("_at"),
        (F.coalesce(done, F.lit(0)) - F.coalesce(gone, F.lit(0))).alias("_between"),
    )
    exit_at = F.col("_at") + F.lit(span_micros)
    leaves = known.select(entity, bucket(exit_at).alias("_bucket"), exit_at.alias("_at"))
    crowded = counts.filter(F.col("_count") > hot_rows)
    if crowded.isEmpty():
        return _within_buckets(df, timed, leaves, heads, entity, name)
    hot = checkpointed(
        crowded.select(entity, F.explode(F.array(F.col("_bucket"), F.col("_bucket") + buckets)).alias("_bucket"))
        .distinct()
        .withColumn("_hot", F.lit(True))
    )
    cells = [entity, "_bucket"]
    flagged, left, tops = (
        broadcast_if_small(hot, cells, rows, hot_rows=hot_rows, row_key=key)
        for rows, key in ((timed, row_key), (leaves, None), (heads, None))
    )
    cold = F.col("_hot").isNull()
    usual = _within_buckets(
        df, flagged.filter(cold), left.filter(cold).drop("_hot"), tops.filter(cold).drop("_hot"), entity, name
    )
    facts = _instants(flagged.filter(~cold), left.filter(~cold), tops.filter(~cold), entity, bucket_micros, name)
    crowd = flagged.filter(~cold).select(*df.columns, "_at")
    found = broadcast_if_small(facts, [entity, "_at"], crowd, hot_rows=hot_rows, row_key=row_key)
    return usual.unionByName(found.select(*df.columns, name))


def _within_buckets(
    df: DataFrame, timed: DataFrame, leaves: DataFrame, heads: DataFrame, entity: str, name: str
) -> DataFrame:
    """Velocity of the rows of ``timed`` by ordering rows, leaving marks and running totals within each bucket."""
    row = F.struct(*[F.col(column) for column in df.columns]).alias("_row")
    nothing = F.lit(None).cast("bigint").alias("_between")
    entering = timed.select(entity, "_bucket", "_at", row, nothing)
    no_row = F.lit(None).cast(entering.schema["_row"].dataType).alias("_row")
    leaving = leaves.select(entity, "_bucket", "_at", no_row, nothing)
    marks = entering.unionByName(leaving).unionByName(heads.select(entity, "_bucket", "_at", no_row, "_between"))
    inside = Window.partitionBy(entity, "_bucket").orderBy(F.col("_at").asc_nulls_first())
    so_far = inside.rangeBetween(Window.unboundedPreceding, 0)
    left = F.count(F.when(F.col("_row").isNull() & F.col("_at").isNotNull(), 1))
    inside_count = (
        F.max("_between").over(so_far)
        + F.count("_row").over(so_far)
        - left.over(inside.rangeBetween(Window.unboundedPreceding, -1))
    )
    return (
        marks.withColumn(name, F.when(F.col("_at").isNotNull(), inside_count.cast("bigint")))
        .filter(F.col("_row").isNotNull())
        .select("_row.*", name)
    )


def _instants(
    timed: DataFrame, leaves: DataFrame, heads: DataFrame, entity: str, bucket_micros: int, name: str
) -> DataFrame:
    """Velocity per (entity, instant) of crowded buckets.

    Rows that enter and leave are first counted per instant, combined map-side.
    A bucket is cut into ``FINER`` parts whose running totals start from the
    bucket's own, so a task orders at most ``bucket_micros / FINER`` instants
    of one part, however many rows they have.
    """
    fine = -(-bucket_micros // FINER)
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    both = timed.select(entity, "_bucket", "_at", one.alias("_in"), zero.alias("_out")).unionByName(
        leaves.select(entity, "_bucket", "_at", zero.alias("_in"), one.alias("_out"))
    )
    part = F.floor(F.pmod("_at", F.lit(bucket_micros)) / fine).cast("bigint").alias("_part")
    instants = checkpointed(
        both.groupBy(entity, "_bucket", "_at").agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
        .select("*", part)
    )
    nets = instants.groupBy(entity, "_bucket", "_part").agg(F.sum(F.col("_in") - F.col("_out")).alias("_net"))
    nets = nets.unionByName(heads.select(entity, "_bucket", F.lit(-1).cast("bigint").alias("_part"), F.col("_between").alias("_net")))
    before = F.sum("_net").over(
        Window.partitionBy(entity, "_bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = nets.select(entity, "_bucket", "_part", before.alias("_between")).filter("_part >= 0")
    nothing = F.lit(None).cast("bigint")
    marks = instants.withColumn("_between", nothing).unionByName(
        starts.select("*", nothing.alias("_at"), zero.alias("_in"), zero.alias("_out"))
    )
    inside = Window.partitionBy(entity, "_bucket", "_part").orderBy(F.col("_at").asc_nulls_first())
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = F.coalesce(F.sum("_out").over(inside.rowsBetween(Window.unboundedPreceding, -1)), zero)
    counted = F.coalesce(F.max("_between").over(so_far), zero) + F.sum("_in").over(so_far) - gone
    return marks.withColumn(name, counted).filter("_in > 0").select(entity, "_at", name)
