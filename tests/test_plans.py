import json
import os
import random
from datetime import datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import text
from ledgerloom.functions.json_text import indented
from ledgerloom.operators import responses
from ledgerloom.plans import corpus_build
from ledgerloom.session import checkpointed, drop_written_tables, shared_folder
from ledgerloom.streaming import decisions

# Hand-written requests and the decision a faithful model gives.
SCENARIOS = [
    ("over", {"budget": 500, "remaining": 80, "amount": 120}, "REJECT"),
    ("within", {"budget": 5000, "remaining": 3200, "amount": 1500}, "APPROVE"),
]


@F.pandas_udf(T.StringType())
def model(prompts: pd.Series) -> pd.Series:
    """Reads the two figures out of the prompt and applies the budget rule."""

    def answer(prompt):
        context = json.loads(prompt.split("Context:\n")[1].split("\n<|eot_id|>")[0])
        label = "APPROVE" if context["amount"] <= context["remaining"] else "REJECT"
        return f"Decision: {label}\nReason: {context['amount']} against {context['remaining']}\nConfidence: 1.5"

    return prompts.map(answer)


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "requests"
    folder.mkdir()
    for at, (name, context, _) in enumerate(SCENARIOS):
        line = json.dumps({"id": name, "instruction": "Check.", "context": context})
        (folder / f"{at}.json").write_text(line + "\n")
    batch = responses.decide(spark.read.schema(decisions.REQUEST_SCHEMA).json(str(folder)), model)
    stream = decisions.start_decisions(
        decisions.read_requests(spark, str(folder), files_per_trigger=1),
        model,
        str(tmp_path / "out"),
        str(tmp_path / "state"),
        available_now=True,
    )
    stream.awaitTermination(120)
    assert not stream.isActive and stream.exception() is None
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(written.columns) == sorted(batch.columns)
    rows = sorted(tuple(r) for r in written.select("id", "decision", "explanation", "confidence").collect())
    assert rows == sorted(tuple(r) for r in batch.select("id", "decision", "explanation", "confidence").collect())
    assert {r[0]: r[1].upper() for r in rows} == {name: label for name, _, label in SCENARIOS}
    assert {r[3] for r in rows} == {1.0}


def test_guarded_model_stream_and_batch(spark, tmp_path):
    """One bad prompt among many fails alone, in a batch, in a stream, and for a model that loses responses."""
    folder = tmp_path / "requests"
    folder.mkdir()
    lines = [json.dumps({"id": str(n), "instruction": "Check.", "context": {"n": n}}) for n in range(40)]
    (folder / "0.json").write_text("\n".join(lines))

    def model(prompts):
        if prompts.str.contains('"n": 17\n', regex=False).any():
            raise RuntimeError("17")
        if len(prompts) == 1 and '"n": 3\n' in prompts.iloc[0]:
            return prompts.iloc[:0]
        if len(prompts) > 1 and prompts.str.contains('"n": 3\n', regex=False).any():
            return prompts.iloc[1:]
        return "Decision: APPROVE\nReason: " + prompts.str.extract(r'"n": (\d+)')[0]

    guarded = responses.guarded(model)
    requests = spark.read.schema(decisions.REQUEST_SCHEMA).json(str(folder))
    rows = {r.id: (r.decision, r.explanation, r.error) for r in responses.decide(requests, guarded).collect()}
    assert {name: found for name, found in rows.items() if found[2]} == {
        "3": (rows["3"][0], "", "model failed: ValueError: 0 responses for 1 prompts"),
        "17": (rows["17"][0], "", "model failed: RuntimeError: 17"),
    }
    assert all(rows[str(n)][1] == str(n) for n in range(40) if n not in (3, 17))
    stream = decisions.start_decisions(
        decisions.read_requests(spark, str(folder)), guarded, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True
    )
    stream.awaitTermination(120)
    assert stream.exception() is None
    written = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.id: (r.decision, r.explanation, r.error) for r in written} == rows
    assert responses.decide(requests.limit(0), guarded).count() == 0


def test_guarded_model_calls_grow_with_the_prompts():
    """Many failures cost hardly more than a call a prompt, few ones some calls each, and equal prompts one call."""
    calls = []

    def model(prompts):
        calls.append(len(prompts))
        if any(prompt.endswith("bad") for prompt in prompts):
            raise ValueError("bad")
        return prompts.map(lambda prompt: "said " + prompt)

    def run(*batches):
        calls.clear()
        parts = list(responses.guarded(model).func(iter([pd.Series(batch, dtype=object) for batch in batches])))
        for batch, part in zip(batches, parts, strict=True):
            failed = [prompt.endswith("bad") for prompt in batch]
            assert list(part["response"]) == [None if f else "said " + p for p, f in zip(batch, failed, strict=True)]
            assert list(part["error"]) == ["ValueError: bad" if f else None for f in failed]
        return len(calls), sum(calls)

    draw = random.Random(3)
    third = [f"{n} bad" if draw.random() < 1 / 3 else str(n) for n in range(6000)]
    made, asked = run(third[:3000], third[3000:])
    assert made < 1.1 * len(third) and asked < 3 * len(third)
    rare = ["77 bad" if n == 77 else "1500 bad" if n == 1500 else str(n) for n in range(3000)]
    assert run(rare)[0] < 60
    recovered = run([f"{n} bad" for n in range(3000)], *[[f"{k} {n}" for n in range(3000)] for k in range(20)])
    assert recovered[0] < 3000 + 6000
    assert run(["a", "b"] * 500) == (1, 2)
    assert run(["a", "b bad"] * 500)[0] == 3


def test_typed_requests_need_no_python_before_the_model(spark):
    """Every type that can be written is written as the parser's path does, inside the JVM."""
    kinds = (
        "`b x`: double, a: array<struct<z: string, y: array<int>>>, m: map<string, float>, d: date, t: timestamp, e: struct<>,"
        " dec: decimal(12,3), big: decimal(20,0), ok: boolean, bin: binary, n: void, nt: timestamp_ntz"
    )
    noon = datetime(2024, 1, 2, 12, 0, 0, 678000)
    rows = [
        ((1e16, [('é\n"q"\U0001d4b3', [1, None]), None, (None, [])], {"b": 0.1, "a": None, "Z": 1e10}, noon.date(), noon, (),
          None, None, True, bytearray(b"ab"), None, noon),),
        ((-0.0, None, {}, None, None, None, Decimal("1.5"), Decimal(10**19), None, None, None, None),),
        ((12345.678, [], None, None, None, None, Decimal(2), Decimal(3), False, None, None, None),),
        (None,),
    ]
    typed = spark.createDataFrame(rows, f"context struct<{kinds}>")
    shown = typed.select(
        responses.shown_context(typed).alias("jvm"), indented(F.to_json("context", {"ignoreNullFields": "false"})).alias("parsed")
    )
    assert [r.jvm for r in shown.collect()] == [r.parsed for r in shown.collect()]
    plan = typed.select(responses.shown_context(typed))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    clashing = spark.sql("SELECT parse_json('{\"b\": 1, \"a\": [2]}') AS context")
    assert json.loads(clashing.select(responses.shown_context(clashing)).first()[0]) == {"a": [2], "b": 1}


@F.pandas_udf(T.StringType())
def echo(prompts: pd.Series) -> pd.Series:
    return prompts.map(lambda prompt: f"Decision: APPROVE\nReason: {len(prompt)} characters\nConfidence: 0.5")


def test_struct_and_text_requests_give_the_same_prompt(spark):
    df = spark.sql("""SELECT 'Check.' AS instruction, named_struct('b', '$1,200', 'a', 0.12345678D, 'c', CAST(NULL AS INT),
        'd', named_struct('y', true, 'x', array(1, 2))) AS context""")
    as_text = df.withColumn("context", F.lit('{"b": "$1,200", "a": 0.12345678, "c": null, "d": {"y": true, "x": [1, 2]}}'))
    shown = [frame.select(responses.request_prompt(frame)).first()[0] for frame in (df, as_text)]
    assert shown[0] == shown[1] and '"b": "$1,200",\n  "c": null' in shown[0] and "0.12345678" in shown[0]


def test_unreadable_requests_do_not_end_a_stream(spark, tmp_path):
    folder = tmp_path / "requests"
    folder.mkdir()
    contexts = {"good": '{"a": 1}', "bad": '{"a": ', "deep": "[" * 100_000, "none": None}
    lines = [json.dumps({"id": name, "instruction": "Check.", "context": text}) for name, text in contexts.items()]
    (folder / "0.json").write_text("\n".join([*lines, json.dumps({"id": "empty", "context": "{}"})]) + "\n")
    stream = decisions.start_decisions(
        decisions.read_requests(spark, str(folder)), echo, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True
    )
    stream.awaitTermination(120)
    assert stream.exception() is None
    rows = {r.id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert sorted(rows) == ["bad", "deep", "empty", "good", "none"]
    assert rows["good"].error is None and rows["good"].decision.upper() == "APPROVE"
    assert {rows[name].decision.upper() for name in ("bad", "deep", "none", "empty")} != {"APPROVE"}
    assert rows["none"].error == "context is missing" and rows["empty"].error == "instruction is missing"
    assert rows["bad"].error == rows["deep"].error == "context is not JSON or nested too deeply"


def test_build_from_files(spark, tmp_path):
    def line(n, source=None, **more):
        record = {"instruction": f"q{n % 40}", "context": {"amount": "$5", "n": n % 40}, "output": "yes", "category": f"c{n % 4}"}
        return json.dumps({**record, **({"source": source} if source else {}), **more})

    first, second = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    first.write_text("\n".join(line(n, "first") for n in range(60)) + "\n")
    second.write_text("\n".join(line(n, id=f"given-{n}") for n in range(100)) + "\n" + line(0, context=5) + "\n")
    built = corpus_build.build_from_files(spark, [str(first), str(second)], token_count=F.length, system_text="S")
    rows = built.records.collect()
    assert len(rows) == 40 and {r.source for r in rows} == {"first"}
    assert all(r.id.startswith(r.category + "-") for r in rows)
    summary = built.merge_summary.first()
    assert (summary.before_deduplication, summary.after_deduplication, summary.target_met) == (160, 40, False)
    assert {r.split: r.rows for r in built.split_sizes.collect()} == {"train": 32, "validation": 4, "test": 4}
    assert {(r.kind, r.name): r.rows for r in built.counts.collect()} == {
        ("total", "samples"): 40, ("source", "first"): 40, **{("category", f"c{n}"): 10 for n in range(4)},
    }
    sample = next(r for r in rows if r.instruction == "q1")
    context = json.dumps({"amount": 5.0, "n": 1}, indent=2, sort_keys=True)
    assert f"Instruction: q1\nContext:\n{context}\n" in sample.prompt
    assert sample.text == sample.prompt + "Decision: ANSWER\nReason: yes\n<|eot_id|>"
    lengths = [r.token_count for r in rows]
    stats = built.token_stats.first()
    assert (stats.min, stats.max, stats.avg) == (min(lengths), max(lengths), round(sum(lengths) / 40, 2))


def test_written_tables_survive_and_prune(spark):
    wide = checkpointed(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    plan = wide.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and wide.count() == 10


def test_written_tables_can_be_dropped(spark):
    # What other tests read stays: their frames are not used again once they are done.
    kept = os.path.join(shared_folder(spark).removeprefix("file:"), "kept")
    os.makedirs(kept)
    frame = checkpointed(spark.range(10))
    assert frame.count() == 10 and drop_written_tables(spark) >= 1
    assert os.path.isdir(kept) and not os.path.exists(frame.inputFiles()[0].removeprefix("file://"))
    assert drop_written_tables(spark) == 0


def test_build_report_of_empty_and_small_corpora(spark, tmp_path):
    fields = "id string, instruction string, context string, output string, category string, source string, ord long"
    rows = [(f"r{at}", "Check.", f'{{"a": {at % 7}}}', "Decision: APPROVE\nReason: fine", "budget", None if at % 2 else "s", at) for at in range(20)]
    for name, given, count in (("small", rows, text.word_count), ("plain", rows, None), ("empty", [], text.word_count)):
        built = corpus_build.build_corpus(
            [spark.createDataFrame(given, fields)], order=["ord"], context_text=lambda context: context, token_count=count
        )
        report = corpus_build.write_build(built, str(tmp_path / name), ["here"]).first()
        unique = 7 if given else 0
        assert (report.before_deduplication, report.after_deduplication, report.target_met) == (len(given), unique, False)
        assert sum(report.split_sizes) == report.dataset_summary.samples == unique and tuple(report.ratios) == (0.8, 0.1, 0.1)
        assert (report.token_stats.avg is None) == (count is None or not given)
        if given:
            assert report.dataset_summary.categories == {"budget": 7} and report.dataset_summary.sources == {"s": 4, "unknown": 3}
            written = spark.read.parquet(str(tmp_path / name / "records"))
            sizes = {row["split"]: row["count"] for row in written.groupBy("split").count().collect()}
            assert {key: size for key, size in report.split_sizes.asDict().items() if size} == sizes
            listed = spark.read.json(str(tmp_path / name / "report"), multiLine=True).first()
            assert listed.split_sizes.asDict() == report.split_sizes.asDict() and listed.sources == ["here"]
