import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed
from ledgerloom.operators import corpus, metrics, records, render, responses, scale, scenarios, split


def raw(spark, rows):
    return spark.createDataFrame(rows, "id string, instruction string, context string, output string,"
                                       " category string, source string")


def test_canonical_records_and_content_id(spark):
    df = raw(spark, [
        (None, " What  is it? ", '{"b": 1.0, "a": "$1,000"}', "plain  é answer\n\n x ", " cat ", None),
        ("given", "q", '{"a": 1}', "Decision: OK\nReason:  fine", "c", " src "),
    ])
    got = {r.category: r for r in records.canonical_records(df).collect()}
    key = json.dumps({"instruction": "What is it?", "context": {"a": 1000.0, "b": 1.0},
                      "output": "plain é answer\nx", "category": "cat"}, sort_keys=True)
    first = got["cat"]
    assert first.id == "cat-" + hashlib.md5(key.encode()).hexdigest()[:16]
    assert first.output == "Decision: ANSWER\nReason: plain é answer x"
    assert (first.context, first.source, first.violations) == ('{"a": 1000.0, "b": 1.0}', None, [])
    assert (got["c"].id, got["c"].output, got["c"].source) == ("given", "Decision: OK\nReason: fine", "src")
    assert {r.source for r in records.canonical_records(df, source="s").collect()} == {"s"}


def test_canonical_records_are_stable(spark):
    df = raw(spark, [(None, " a  b", '{"amount": "(5)", "x": [1, 2.0]}', "yes", "c", "s")])
    once = records.accepted(records.canonical_records(df))
    twice = records.accepted(records.canonical_records(once))
    assert once.collect() == twice.collect()


def test_violations(spark):
    df = raw(spark, [
        ("1", "q", "[1]", "Decision: A\nReason: b", "c", None),
        ("2", "  ", '{"l": [null]}', "Decision: A", "c", None),
        ("3", "q", '{"l": [1]}', "Decision: A\nReason: b", "c", None),
    ])
    done = records.canonical_records(df)
    assert [r.id for r in records.accepted(done).collect()] == ["3"]
    found = {r.id: r.violations for r in records.rejected(done).collect()}
    assert found == {
        "1": ["context is not an object"],
        "2": ["null found in context.l[0]", "instruction is empty", "output has no reason line"],
    }
    with pytest.raises(Exception, match="context is not an object|null found"):
        records.strict(done).collect()
    with pytest.raises(ValueError, match="category"):
        records.canonical_records(df.drop("category"))


def test_typed_context(spark):
    df = spark.createDataFrame([("q", {"amount": "$5", "n": [1, None]}, "x", "c")],
                               "instruction string, context struct<amount string, n array<int>>, output string,"
                               " category string")
    row = records.canonical_records(df).first()
    assert row.context == '{"amount": 5.0, "n": [1, null]}'
    assert row.violations == ["null found in context.n[1]"]


@pytest.mark.parametrize("partitions", [1, 6])
def test_dedup_keeps_the_first(spark, partitions):
    rows = [(at, f"text {at % 7}" if at % 3 else "hot", at % 2) for at in range(120)]
    df = spark.createDataFrame(rows, "at int, t string, k int").repartition(partitions)
    got = corpus.exact_dedup(df, ["at"], ["t"])
    first = {}
    for at, text, _ in rows:
        first.setdefault(text, at)
    assert {r.t: r.at for r in got.collect()} == first
    assert got.count() == corpus.exact_dedup(got, ["at"], ["t"]).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "hashpartitioning" not in plan


def test_summaries(spark):
    df = raw(spark, [("1", "q", "{}", "o", "a", None), ("2", "q", "{}", "o", "a", "s"), ("3", "q", "{}", "p", "b", "s")])
    counts = {(r.kind, r.name): r.rows for r in corpus.category_source_counts(df).collect()}
    assert counts == {("category", "a"): 2, ("category", "b"): 1, ("source", "unknown"): 1, ("source", "s"): 2,
                      ("total", "samples"): 3}
    assert tuple(corpus.merge_summary(df, target=2).first()) == (3, 2, True)
    assert tuple(corpus.merge_summary(df.limit(0)).first()) == (0, 0, False)
    merged = corpus.merge([df, df.drop("source")])
    assert merged.count() == 6 and {r.source_ord for r in merged.collect()} == {0, 1}


def test_prompt_and_stats(spark):
    df = raw(spark, [("1", "Do it.", '{"b": [1, 2.5], "a": {}}', "Decision: A\nReason: b", "c", None)])
    done = render.enriched(records.accepted(records.canonical_records(df)), token_count=F.length, system_text="SYS")
    row = done.first()
    blob = json.dumps({"a": {}, "b": [1, 2.5]}, indent=2, sort_keys=True)
    expected = (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\nSYS\n"
        "<|eot_id|><|start_header_id|>user<|end_header_id|>\n"
        f"Instruction: Do it.\nContext:\n{blob}\n"
        "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n"
    )
    assert row.prompt == expected
    assert row.text == expected + "Decision: A\nReason: b\n<|eot_id|>" and row.token_count == len(row.text)
    stats = render.length_stats(spark.createDataFrame([(1,), (2,), (2,)], "n int"), F.col("n")).first()
    assert tuple(stats) == (1, 2, 1.67)
    none = render.length_stats(spark.createDataFrame([], "n int"), F.col("n")).first()
    assert tuple(none) == (None, None, None)
    cut = render.token_rows(spark.createDataFrame([([1, 2, 3],)], "t array<int>"), F.col("t"), 2).first()
    assert cut.input_ids == cut.labels == [1, 2]


RESPONSES = [
    ("Decision:\nReason: x", "REASON_X", "review", "x", 0.7),
    ("no marks", "UNKNOWN", "review", "no marks", 0.56),
    ("Decision: allow!\nConfidence: 12", "ALLOW", "approve", "Decision: allow! Confidence: 12", 1.0),
    ("Decision: deny\nReason: it appears bad\nConfidence: 85%", "DENY", "reject", "it appears bad", 0.63),
    ("Decision: X\nConfidence: 1.9", "X", "review", "Decision: X Confidence: 1.9", 1.9),
    ("Decision:   \n", "UNKNOWN", "review", "Decision:", 0.56),
    (None, "UNKNOWN", "review", "", 0.56),
]


def test_parse(spark):
    df = spark.createDataFrame([(at, case[0]) for at, case in enumerate(RESPONSES)], "at int, r string")
    got = responses.parsed(df, "r").orderBy("at").collect()
    assert [(r.raw_decision, r.decision, r.reason, r.confidence) for r in got] == [c[1:] for c in RESPONSES]
    assert [r.explanation for r in got] == [c[3] for c in RESPONSES]


def test_metrics(spark):
    gold = spark.createDataFrame([
        ("1", "fraud_detection", "Decision: MANUAL_REVIEW\nReason: a"),
        ("2", "fraud_detection", "Decision: ALLOW\nReason: a"),
        ("3", "fraud_detection", "Decision: MANUAL_REVIEW\nReason: a"),
        ("4", "budget_reasoning", "Decision: REJECT\nReason: b"),
        ("5", "budget_reasoning", "Decision: REJECT\nReason: b"),
    ], "id string, category string, output string")
    said = spark.createDataFrame([
        ("1", "decision: x Decision: manual review\nReason: z"),
        ("2", "Decision: MANUAL_REVIEW"),
        ("4", "  decision:  REJECT reason: B"),
        ("5", "Decision: REJECT\nReason:   B"),
    ], "id string, response string")
    results = metrics.scored(gold, said, with_text=True).cache()
    found = {r.id: (r.predicted_decision, r.decision_match, r.exact_match) for r in results.collect()}
    assert found == {
        "1": ("MANUAL_REVIEW", True, False), "2": ("MANUAL_REVIEW", False, False),
        "3": ("UNKNOWN", False, False), "4": ("UNKNOWN", False, True), "5": ("REJECT", True, True),
    }
    assert tuple(metrics.reasoning_report(results).first()) == (5, 0.4, 0.4)
    assert tuple(metrics.budget_report(results).first()) == (2, 0.5, 0.5)
    assert tuple(metrics.precision_recall_f1(results).first()) == (3, 0.5, 0.5, 0.5)
    assert tuple(metrics.accuracy(results, ["none"]).first()) == (0, 0.0)
    assert tuple(metrics.precision_recall_f1(results, categories=["none"]).first()) == (0, 0.0, 0.0, 0.0)
    overall = next(r for r in metrics.by_category(results).collect() if r.overall)
    assert (overall.samples, overall.accuracy, overall.precision) == (5, 0.4, 0.5)


def test_pass_rate_is_a_containment(spark):
    cases = spark.createDataFrame([("a", "DEDUCTIBLE"), ("b", "REJECT"), ("c", "ALLOW")], "name string, expected string")
    said = spark.createDataFrame([("a", "non_deductible"), ("b", "approve")], "name string, response string")
    assert tuple(metrics.pass_rate(cases, said).first()) == (3, 1, pytest.approx(1 / 3))


def test_scenarios(spark):
    made = checkpointed(scenarios.generate(spark, 1200, seed=5))
    rows = made.collect()
    assert len(rows) == 1200 and len({r.id for r in rows}) == 1200
    per = {}
    for r in rows:
        per.setdefault(r.category, []).append(r)
    assert {len(v) for v in per.values()} == {100} and len(per) == 12
    again = scenarios.generate(spark.newSession(), 1200, seed=5, shuffle=False).repartition(3).collect()
    assert sorted(rows) == sorted(again)
    checked = records.canonical_records(made)
    assert records.rejected(checked).count() == 0
    unchanged = records.accepted(checked).select(*made.columns)
    assert sorted(unchanged.collect()) == sorted(rows)
    batch = json.loads(per["multi_transaction_budgeting"][0].context)
    assert 2 <= len(batch["transactions"]) <= 5 and set(batch["transactions"][0]) == {"amount", "type", "vendor"}
    labels = {c: {r.output.split("\n")[0][10:] for r in v} for c, v in per.items()}
    assert labels["loan_evaluation"] == {"APPROVE", "REJECT", "REVIEW"}
    assert labels["investment_analysis"] == {"BUY", "HOLD", "AVOID"}


def test_published_split_sizes(spark):
    made = scenarios.generate(spark, 5000, shuffle=False).select("id", "category")
    sizes = {r.split: r.rows for r in split.split_sizes(split.stratified_split(made)).collect()}
    assert sizes == {"train": 3996, "validation": 504, "test": 500}


def test_dedup_keeps_the_first_of_a_hot_text(spark, monkeypatch):
    texts = ["hot" if at % 3 else f"own {at % 40}" for at in range(3000)]
    rows = [(None if at == 7 else at, text) for at, text in enumerate(texts)] + [(3000, None), (3001, None)]
    df = spark.createDataFrame(rows, "ord int, text string").repartition(5)
    first = {}
    for place, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        first.setdefault(text, place)
    wanted = sorted((text or "", place or -1) for text, place in first.items())
    small = corpus.exact_dedup(df, ["ord"], ["text"])
    large = corpus.exact_dedup(df, ["ord"], ["text"], max_rows=0)
    few_slots = corpus.exact_dedup(df, ["ord"], ["text"], max_rows=0, slots=64, hot_rows=5)
    for found in (small, large, few_slots):
        assert found.columns == df.columns
        assert sorted((r.text or "", r.ord or -1) for r in found.collect()) == wanted
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_missing_category_is_named_unknown(spark):
    df = spark.createDataFrame([(None, "s"), ("c", None)], "category string, source string")
    got = {(r.kind, r.name): r.rows for r in corpus.category_source_counts(df).collect()}
    assert got == {
        ("category", "unknown"): 1, ("category", "c"): 1, ("source", "s"): 1, ("source", "unknown"): 1, ("total", "samples"): 2,
    }


def test_repeated_predictions_and_responses_count_once(spark):
    gold = spark.createDataFrame([("a", "x", "Decision: APPROVE\nReason: r")], "id string, category string, output string")
    said = spark.createDataFrame(
        [("a", "Decision: REJECT\nReason: r"), ("a", "Decision: APPROVE\nReason: r")], "id string, response string"
    )
    rows = metrics.scored(gold, said, with_text=True).collect()
    assert [(r.predicted_decision, r.decision_match, r.exact_match) for r in rows] == [("APPROVE", True, True)]
    scenarios = spark.createDataFrame([("a", "REJECT"), ("b", "APPROVE"), ("c", "APPROVE")], "name string, expected string")
    answers = spark.createDataFrame([("a", "reject"), ("a", "no"), ("b", "Approve!"), ("d", "x")], "name string, response string")
    found = metrics.pass_rate(scenarios, answers).first()
    assert (found.scenarios, found.passed) == (3, 1)


def test_repeats_beyond_a_broadcast(spark):
    """Every text repeated, one of them a third of all rows; unique texts are in no exchange."""
    rows = [(at, "hot" if at % 3 == 0 else f"text {at % 40}", None if at % 5 == 0 else at % 2) for at in range(300)]
    rows += [(1000 + at, f"only {at}", at) for at in range(50)]
    df = spark.createDataFrame(rows, "at int, t string, k int").repartition(3)
    first = {}
    for at, text, k in rows:
        first.setdefault((text, k), at)
    for slots in (1 << 28, 64, 1):
        got = corpus.exact_dedup(df, ["at"], ["t", "k"], max_rows=0, slots=slots, hot_rows=20)
        assert got.columns == df.columns and {(r.t, r.k): r.at for r in got.collect()} == first and got.count() == len(first)
    repeated = df.withColumn("_digest", corpus.digest(df, ["t"])).filter("t = 'hot'").select("_digest").distinct()
    bits = corpus.repeat_filter(repeated)
    seen = df.withColumn("_digest", corpus.digest(df, ["t"])).join(
        bits, F.bitmap_bucket_number(corpus._slot(corpus.FILTER_SLOTS)) == F.col("_block"), "left"
    )
    assert {r.t for r in seen.filter(corpus._may_repeat(corpus.FILTER_SLOTS)).collect()} == {"hot"}


def test_digests_know_borders_and_nulls(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, None), ("1:a", "-"), ("-", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(corpus.digest(df, ["x", "y"]).alias("d")).distinct().count() == len(rows)


def test_facts_beyond_a_broadcast(spark):
    """Hot keys are spread, others are not copied, and the join stays a left join with null keys met."""
    rows = spark.createDataFrame([(at, "hot" if at % 2 else (None if at % 4 else f"k{at}")) for at in range(200)], "at int, k string")
    facts = spark.createDataFrame([("hot", 1), (None, 2), ("k4", 3), ("unused", 4)], "k string, fact int")
    found = scale.broadcast_if_small(facts, ["k"], rows, max_rows=0, salts=4, hot_rows=10)
    wanted = {"hot": 1, None: 2, "k4": 3}
    assert sorted((r.at, r.fact or 0) for r in found.collect()) == [(r.at, wanted.get(r.k) or 0) for r in rows.collect()]
