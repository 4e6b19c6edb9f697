import json
import os
import re
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import records, split
from ledgerloom.sources import files, json_pieces, qa_records


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as handle:
        handle.write(text)
    return path


def rows_of(spark, root):
    found = files.load_records(spark, [root] if isinstance(root, str) else root).collect()
    return [(r.file_ord, r.record_ord, json.loads(r.record)) for r in sorted(found, key=lambda r: (r.file_ord, r.record_ord))]


def test_file_shapes(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a/one.jsonl", '{"q": 1}\n\n   \n{"q": 1.0}\n')
    put(root, "a.json", json.dumps([{"i": 0}, 5, {"i": 1.0}, "x"], indent=1))
    put(root, "b/x.JSON", json.dumps({"data": [{"i": 2}], "items": [{"i": 3}]}))
    put(root, "b/empty.json", json.dumps({"data": [], "items": [{"i": 3}]}))
    put(root, "b/splits.json", json.dumps({"train": [{"i": 4}], "n": 1, "alpha": [{"i": 5}, None]}))
    put(root, "b/single.json", json.dumps({"i": 6, "tags": ["t"]}))
    put(root, "b/number.json", "17")
    put(root, "c/t.csv", 'question,answer,note\n"line one\nline ""two""",5,\nsecond,,x\n')
    put(root, "c/ignored.txt", "hello")
    assert rows_of(spark, root) == [
        (0, 0, {"q": 1}), (0, 1, {"q": 1.0}),
        (1, 0, {"i": 0}), (1, 1, {"i": 1.0}),
        (4, 0, {"i": 6, "tags": ["t"]}),
        (5, 0, {"i": 4}), (5, 1, {"i": 5}),
        (6, 0, {"i": 2}),
        (7, 0, {"question": 'line one\nline "two"', "answer": "5", "note": ""}),
        (7, 1, {"question": "second", "answer": "", "note": "x"}),
    ]
    texts = [r.record for r in files.read_lines(spark, root + "/a/one.jsonl").collect()]
    assert texts == ['{"q": 1}', '{"q": 1.0}']


def test_bad_paths(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.load_records(spark, [str(tmp_path / "nothing")])
    odd = put(str(tmp_path), "data.xml", "<a/>")
    with pytest.raises(ValueError, match="unsupported"):
        files.load_records(spark, [odd])
    bad = put(str(tmp_path), "bad.json", "{")
    with pytest.raises(Exception):
        files.load_records(spark, [bad]).collect()


def test_records_are_numbered_across_splits(spark, tmp_path):
    root = str(tmp_path)
    lines = [json.dumps({"n": n, "pad": "x" * (n % 50)}) + ("\n\n" if n % 7 == 0 else "\n") for n in range(3000)]
    put(root, "big.jsonl", "".join(lines))
    put(root, "small.jsonl", '{"n": 0}\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert files.read_lines(spark, root).rdd.getNumPartitions() > 5
        got = rows_of(spark, root)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(f, r) for f, r, _ in got] == [(0, n) for n in range(3000)] + [(1, 0)]
    assert all(r == v["n"] for _, r, v in got)


FINQA = [
    {"question": " How  much? ", "answer": "$5", "company": "A", "table": [["x", 1.0, "2.5%"]],
     "pre_text": ["one", "", None, "two "], "post_text": {"b": 1, "a": "z"}, "text": "tail\n\nend"},
    {"qa": {"question": "q2", "answer": 0, "exe_ans": 0, "program": "add(1, 2)"}},
    {"qa": {"question": "q3", "exe_ans": 3.0}, "gold_inds": {"t": "row"}},
    {"question": "no answer"},
    {"question": "", "answer": "x"},
    {"qa": [1], "question": "q6", "answer": True},
]


def test_report_records(spark, tmp_path):
    root = str(tmp_path)
    put(root, "f.json", json.dumps(FINQA))
    got = {r.id: r for r in qa_records.import_source(spark, [root], "finqa").collect()}
    assert sorted(got) == [f"finqa-000-{n:06d}" for n in (0, 1, 2, 5)]
    first = got["finqa-000-000000"]
    assert first.instruction == "How much?" and first.violations == []
    assert first.output == "Decision: ANSWER\nReason: $5"
    assert json.loads(first.context) == {
        "dataset": "FinQA", "company": "A", "table": [["x", 1.0, 2.5]],
        "report_text": 'one two {"a": "z", "b": 1} tail end',
    }
    assert '"table": [["x", 1.0, 2.5]]' in first.context
    second = got["finqa-000-000001"]
    assert second.output == "Decision: ANSWER\nReason: 0 Reasoning trace: add(1, 2)"
    assert json.loads(second.context)["reasoning_steps"] == "add(1, 2)"
    assert got["finqa-000-000002"].output == 'Decision: ANSWER\nReason: 3.0 Reasoning trace: {"t":"row"}'
    assert got["finqa-000-000005"].output == "Decision: ANSWER\nReason: True"
    assert {(r.category, r.source) for r in got.values()} == {("finqa_reasoning", "FinQA")}


CONV = [
    {"company_name": "B", "qa": {"question": "not a list"}, "turns": [
        {"question": "t0", "answer": "12.5%", "program": "p"}, "junk", {"query": "t2"},
        {"query": "t3", "exe_ans": 0, "final_answer": 0}, {"question": "t4", "answer": "y", "reasoning": "why"},
    ]},
    {"turns": [], "question": "alone", "answer": "z"},
    {"turns": [{"question": "", "answer": "n"}]},
    {"dialogue": [{"question": "d0", "answer": 1.5}]},
]


def test_turns_and_history(spark, tmp_path):
    root = str(tmp_path)
    put(root, "c.jsonl", "\n".join(json.dumps(r) for r in CONV))
    got = {r.id: r for r in qa_records.import_source(spark, [root], "convfinqa").collect()}
    assert sorted(got) == [
        "convfinqa-000-000000-000", "convfinqa-000-000000-003", "convfinqa-000-000000-004",
        "convfinqa-000-000001-000", "convfinqa-000-000003-000",
    ]
    history = [json.loads(got[f"convfinqa-000-000000-00{n}"].context)["conversation_history"] for n in (0, 3, 4)]
    pairs = [{"question": "t0", "answer": 12.5}, {"question": "t3", "answer": "0"}]
    assert history == [[], pairs[:1], pairs]
    assert got["convfinqa-000-000000-000"].output == "Decision: ANSWER\nReason: 12.5% Reasoning trace: p"
    assert got["convfinqa-000-000003-000"].output == "Decision: ANSWER\nReason: 1.5"
    assert got["convfinqa-000-000001-000"].source == "FinQA"
    assert got["convfinqa-000-000000-004"].source == "ConvFinQA"


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_conversation_records_are_taken_apart_once(spark):
    """Turns, unusable turns and records without turns come from one pass over records that are parsed once."""
    told = [
        {"company": "A", "dialogue": [{"query": "one?", "final_answer": 1}, {"query": "", "final_answer": 2}, {"query": "three?", "final_answer": 3}]},
        {"company": "B", "dialogue": [{"query": "", "final_answer": 1}]},
        {"company": "C", "dialogue": [], "question": "alone?", "answer": "yes", "reasoning": "p"},
        {"company": "D", "question": "no answer?"},
        {},
        None,
    ]
    rows = [(0, at, None if record is None else json.dumps(record)) for at, record in enumerate(told)]
    raw = qa_records.convert(spark.createDataFrame(rows, "file_ord int, record_ord long, record string"), qa_records.SOURCES["convfinqa"])
    assert _plan(raw).count("parseJson") == 1 and "Union" not in _plan(raw)
    got = {(r.record_ord, r.turn_ord): r for r in raw.collect()}
    assert {key: (r.id, r.instruction, r.source, r.category) for key, r in got.items()} == {
        (0, 0): ("convfinqa-000-000000-000", "one?", "ConvFinQA", "convfinqa_reasoning"),
        (0, 2): ("convfinqa-000-000000-002", "three?", "ConvFinQA", "convfinqa_reasoning"),
        (2, 0): ("convfinqa-000-000002-000", "alone?", "FinQA", "finqa_reasoning"),
    }
    assert [json.loads(got[key].context) for key in sorted(got)] == [
        {"dataset": "ConvFinQA", "company": "A", "table": None, "report_text": "", "conversation_history": [], "reasoning_steps": None},
        {"dataset": "ConvFinQA", "company": "A", "table": None, "report_text": "",
         "conversation_history": [{"question": "one?", "answer": "1"}], "reasoning_steps": None},
        {"dataset": "FinQA", "company": "C", "table": None, "report_text": "", "reasoning_steps": "p"},
    ]


@pytest.mark.parametrize("name", ["finqa", "financebench"])
def test_single_questions_are_parsed_once(spark, name):
    """Records without a usable question go without a filter that parses all records again."""
    told = [{"question": "one?", "answer": 5}, {"question": "", "answer": 1}, {"question": "three?"}, {"answer": 4}, {}, None]
    rows = [(0, at, None if record is None else json.dumps(record)) for at, record in enumerate(told)]
    raw = qa_records.convert(spark.createDataFrame(rows, "file_ord int, record_ord long, record string"), qa_records.SOURCES[name])
    assert _plan(raw).count("parseJson") == 1
    assert [(r.record_ord, r.instruction, r.output) for r in raw.collect()] == [(0, "one?", "Decision: ANSWER\nReason: 5")]


def test_documents_are_parsed_once(spark, tmp_path):
    """A whole document is parsed once however its records are wrapped."""
    root = str(tmp_path)
    shapes = [[{"i": 0}, 5], {"data": [{"i": 1}, None], "items": [{"i": 9}]}, {"items": []}, {"a": [{"i": 2}], "b": [{"i": 3}], "c": 1}, {"i": 4}, 17]
    for at, shape in enumerate(shapes):
        put(root, f"{at}.json", f"\n {json.dumps(shape)} \n")
    found = files.read_documents(spark, root)
    assert len(re.findall(r"from_json\(MapType", _plan(found))) == 1
    rows = sorted((r.file_path[-6], r.record_ord, json.loads(r.record)["i"]) for r in found.collect())
    assert rows == [("0", 0, 0), ("1", 0, 1), ("3", 0, 2), ("3", 1, 3), ("4", 0, 4)]


def test_generic_records(spark, tmp_path):
    root = str(tmp_path)
    put(root, "g.csv", "prompt,gold_answer,cot,ticker,fiscal_period,evidence\np1,a1,because,TCK,2019,some text\np2,,,,,\n")
    got = {r.id: r for r in qa_records.import_source(spark, [root], "financebench").collect()}
    assert sorted(got) == ["financebench-000-000000", "financebench-000-000001"]
    first = got["financebench-000-000000"]
    assert json.loads(first.context) == {
        "dataset": "FinanceBench", "company": "TCK", "period": "2019", "report_text": "some text",
        "reasoning_steps": "because",
    }
    assert first.output == "Decision: ANSWER\nReason: a1 Reasoning trace: because"
    assert got["financebench-000-000001"].output == "Decision: ANSWER\nReason:"


@pytest.mark.parametrize("cap, records_kept", [(0, 0), (1, 1), (3, 1), (4, 3), (5, 5), (99, 9)])
def test_cap_may_overshoot(spark, cap, records_kept):
    weights = [3, 0, 1, 0, 1, 1, 0, 0, 1]
    kept, done = 0, 0
    for weight in weights:
        if done >= cap:
            break
        kept += 1
        done += weight
    df = spark.createDataFrame([(0, n, w) for n, w in enumerate(weights)], "file_ord int, record_ord bigint, w bigint")
    got = qa_records.capped(df, "w", cap)
    assert got.agg(F.sum("w")).first()[0] == (done if kept else None)


def test_import_all_with_cap(spark, tmp_path):
    conv, fin = str(tmp_path / "conv"), str(tmp_path / "fin")
    put(conv, "c.jsonl", "\n".join(json.dumps(r) for r in CONV))
    put(fin, "f.json", json.dumps(FINQA))
    got = qa_records.import_all(spark, {"convfinqa": [conv], "finqa": [fin]}, cap=2)
    found = sorted((r.import_ord, r.id) for r in got.collect())
    assert found == [
        (0, "finqa-000-000000"), (0, "finqa-000-000001"),
        (1, "convfinqa-000-000000-000"), (1, "convfinqa-000-000000-003"), (1, "convfinqa-000-000000-004"),
    ]


def test_jsonl_round_trip(spark, tmp_path):
    source = put(str(tmp_path), "in.jsonl", '{"instruction": "q", "context": {"b": 1.0, "a": {"n": 1}}, "output": "é",'
                                            ' "category": "c", "extra": 1}\n\n')
    clean = records.accepted(records.canonical_records(files.read_records(spark, source)))
    out = str(tmp_path / "out")
    files.write_jsonl(clean, out)
    line = [r.value for r in spark.read.text(out).collect()]
    body = {"category": "c", "context": {"a": {"n": 1}, "b": 1.0}, "id": clean.first().id, "instruction": "q",
            "output": "Decision: ANSWER\nReason: é"}
    assert line == [json.dumps(body, sort_keys=True)]
    bad = put(str(tmp_path), "bad.jsonl", '{"instruction": "q"\n')
    with pytest.raises(Exception):
        files.read_records(spark, bad).collect()


def test_summary_and_split_sinks(spark, tmp_path):
    one = spark.createDataFrame([(3, True, None)], "b int, a boolean, c double")
    files.write_summary(one, str(tmp_path / "s"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "s")).collect())
    assert json.loads(text) == {"a": True, "b": 3, "c": None} and text.startswith('{\n  "a": true')
    df = spark.createDataFrame([(str(n), f"c{n % 2}") for n in range(40)], "id string, category string")
    files.write_splits(split.stratified_split(df), str(tmp_path / "p"))
    back = files.read_splits(spark, str(tmp_path / "p"))
    assert {r.split for r in back.collect()} == {"train", "validation"} and back.count() == 36
    assert re.search(r"PartitionFilters: \[split#\d+ IN", back._jdf.queryExecution().executedPlan().toString())
    for name in ("train", "validation"):
        put(str(tmp_path), f"{name}.jsonl", json.dumps({"text": name}) + "\n")
    both = files.read_split_files(spark, {n: str(tmp_path / f"{n}.jsonl") for n in ("train", "validation")}, "text string")
    assert sorted(tuple(r) for r in both.collect()) == [("train", "train"), ("validation", "validation")]


def test_csv_files_with_their_own_headers(spark, tmp_path):
    put(tmp_path, "a.csv", 'question,answer\n"two\nlines",1\n')
    put(tmp_path, "sub dir/b[1].csv", 'answer,question,extra\n2,"q ""two""",\n3,q3,x\n')
    put(tmp_path, "c.csv", "question,answer\nq4,4\n")
    put(tmp_path, "empty.csv", "")
    found = files.load_records(spark, [str(tmp_path)]).orderBy("file_ord", "record_ord").collect()
    assert [json.loads(row.record) for row in found] == [
        {"question": "two\nlines", "answer": "1"}, {"question": "q4", "answer": "4"},
        {"answer": "2", "question": 'q "two"', "extra": ""}, {"answer": "3", "question": "q3", "extra": "x"},
    ]
    assert [(row.file_ord, row.record_ord) for row in found] == [(0, 0), (1, 0), (2, 0), (2, 1)]  # empty files have no number


def test_parts_of_written_folders_are_of_the_folders_kind(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    files.write_jsonl(df, str(tmp_path / "x.jsonl"), raw=())
    df.write.json(str(tmp_path / "y.jsonl"))
    df.write.option("header", True).csv(str(tmp_path / "z.csv"))
    put(tmp_path, "other/part-0.txt", "no record")
    found = files.load_records(spark, [str(tmp_path)]).collect()
    assert sorted((int(json.loads(r.record)["n"]), json.loads(r.record)["t"]) for r in found) == sorted([(1, "a"), (2, "b")] * 3)


@pytest.fixture
def tiny_splits(spark):
    small = {"spark.sql.files.maxPartitionBytes": "6000", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


NASTY = 'a "quoted\\ } ] { [ , é€😀 \n } end'
DOCUMENTS = {
    "list": [{"i": at, "t": NASTY * (at % 4), "deep": [{"x": [{}, {"y": {}}]}]} for at in range(60)],
    "mixed": [1, "}", [{"no": 1}, [{}]], {"i": 0}, None, {"i": {"j": [{"k": NASTY}]}}, [[]], {}],
    "wrapped": {"meta": {"data": [{"no": 1}], "x": {"y": {}}}, "items": [{"no": 2}] * 9, "data": [{"i": at} for at in range(40)], "n": 1},
    "empty wrapper": {"examples": [], "rows": [{"no": 1}] * 20, "other": {"examples": [{}]}},
    "two lists": {"a": [{"i": at} for at in range(20)], "o": {"p": [{"no": 1}]}, "s": "} data", "b": [[{"no": 2}], {"i": 99}, 7], "e": []},
    "single": {"i": 6, "tags": ["t", "}"] * 30, "o": {"p": [{"q": 1}]}},
    "number": 17,
    "text": "{ } [ " * 30,
    "nothing": [],
    "long": [{"t": NASTY * 200}, {"t": "}" * 500}, {"u": {"v": NASTY * 20}}],
}


def test_large_documents_are_read_in_splits(spark, tmp_path, tiny_splits):
    for at, (name, document) in enumerate(DOCUMENTS.items()):
        text = json.dumps(document, indent=at % 2 or None, ensure_ascii=at % 3 == 0)
        put(str(tmp_path), f"{name}.json", text + "\n" * (at % 2))

    def found(whole_bytes):
        rows = files.read_documents(spark, str(tmp_path), whole_bytes).collect()
        return sorted((os.path.basename(row.file_path), row.record_ord, row.record) for row in rows)

    expected = found(1 << 30)
    assert len(expected) == 60 + 3 + 40 + 0 + 21 + 1 + 3
    assert found(0) == expected


def items_by_splits(text, cuts):
    """What the functions of the split reader make of a text cut behind some of its closing brackets."""
    pieces = [piece + "}" for piece in text.split("}")]
    pieces[-1] = pieces[-1][:-1]
    starts = sorted({0} | {cut % len(pieces) for cut in cuts})
    splits = [(at, pieces[at:end]) for at, end in zip(starts, starts[1:] + [len(pieces)])]

    def batches(facts):
        for at, members in splits:
            rows = [{"file_path": "f", "block_start": at, "piece": piece, **facts[at]} for piece in members]
            yield pa.RecordBatch.from_pylist(rows)

    inside, parity = {}, False
    for at, members in splits:
        inside[at] = {"in_string": parity}
        parity ^= len(re.findall('"', re.sub(r"(?s)\\.", "", "".join(members)))) % 2 == 1
    outlines = [row for batch in json_pieces._outlines(batches(inside)) for row in batch.to_pylist()]
    stacks = json_pieces._starts(pd.DataFrame(outlines))
    facts = {row.block_start: {"stack": row.stack} for row in stacks.itertuples()}
    found = {}
    for at, members in splits:
        known = {"file_path": "f", "block_start": at, **inside[at], **facts[at]}
        batch = SimpleNamespace(to_pylist=lambda: [{**known, "piece": piece} for piece in members])
        for batch in json_pieces._parts(iter([batch])):
            for row in batch.to_pylist():
                if row["item_block"] is not None:
                    found.setdefault((row["item_block"], row["item_offset"]), []).append((row["part_block"], row["record"]))
    return [json.loads("".join(part for _, part in sorted(found[key]))) for key in sorted(found)]


values = st.recursive(
    st.none() | st.integers() | st.text('ab{}[]"\\\\,:é'),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text('ab}"\\\\'), inner, max_size=4),
    max_leaves=30,
)


@settings(max_examples=300, deadline=None)
@given(values, st.lists(st.integers(0, 60)), st.sampled_from([None, 1]))
def test_items_do_not_depend_on_the_cuts(document, cuts, indent):
    lists = [document] if isinstance(document, list) else []
    if isinstance(document, dict):
        lists = [value for value in document.values() if isinstance(value, list)]
    expected = [item for members in lists for item in members if isinstance(item, dict)]
    assert items_by_splits(json.dumps(document, indent=indent, ensure_ascii=False), cuts) == expected


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1}]]', '[{"a": [1}]}]', '[{"a": 1 "b"}]'])
def test_malformed_large_documents_end_the_job(spark, tmp_path, text):
    put(str(tmp_path), "bad.json", text)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_documents(spark, str(tmp_path), 0).collect()
