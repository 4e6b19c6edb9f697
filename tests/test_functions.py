import json

from pyspark.sql import functions as F

from ledgerloom.functions import json_text, labels, text


def apply(spark, column, values, kind="string"):
    rows = spark.createDataFrame([(at, value) for at, value in enumerate(values)], f"at int, v {kind}")
    return [row.out for row in rows.select("at", column(F.col("v")).alias("out")).orderBy("at").collect()]


ODD = "  a \tb \x1c\x1f c　"


def test_squeeze_covers_unicode_blanks(spark):
    values = [ODD, "  x  y ", "", "​a"]
    assert apply(spark, text.squeeze, values) == [" ".join(v.split()) for v in values]


def test_squeeze_lines(spark):
    values = ["a  b \r\n\r\n  c d\x85\n e ", "\n\n", "one", "  \n x\x0b\x0cy"]
    expected = ["\n".join(" ".join(l.split()) for l in v.splitlines() if l.strip()) for v in values]
    assert apply(spark, text.squeeze_lines, values) == expected


def test_money(spark):
    values = [1234.56, -3.14, 0.125, 2.675, 1234567.0, 0.375]
    assert apply(spark, text.money, values, "double") == [f"${v:,.2f}" for v in values]


def test_round_exact_is_python_round(spark):
    values = [2.675, 0.125, -1.005, 1e9 + 0.125, 33.335]
    assert apply(spark, lambda c: text.round_exact(c, 2), values, "double") == [round(v, 2) for v in values]


NUMBERS = {
    "$1,234.56": 1234.56, "(500)": -500.0, "(-500)": 500.0, "(500": 500.0, "12.5%": 12.5, "-$3,000": -3000.0,
    "1,2,,3": 123.0, ".5": None, "$-5": None, "PO-1234": None, "": None, " 7 ": 7.0, "1.23456789": 1.234568,
}


def test_parse_number(spark):
    assert apply(spark, text.parse_number, list(NUMBERS)) == list(NUMBERS.values())


def test_names_a_number(spark):
    values = ["strategy", "corporate_tax", "April", "year", "vendor"]
    assert apply(spark, text.names_a_number, values) == [True, True, True, False, False]


def test_quote_matches_ascii_json(spark):
    values = ['a"b\\c\n\t\r\b\f/', "éé \x7f\x01", "\U0001f600 \\u00e9", ""]
    assert apply(spark, json_text.quote, values) == [json.dumps(v) for v in values]


def test_float_text_matches_shortest_repr(spark):
    values = [0.0, 1.0, -2.5, 0.1, 250000000.0, 1e-05, 1.2e-05, 0.0001, 1e15, 1e16, 2.5e20, 123456789.123456,
              12345678901.25, -0.0, 0.12345678912, 0.000123456789123, 1e-7, 12345678.123456789]
    assert apply(spark, json_text.float_text, values, "double") == [repr(v) for v in values]


SAMPLE = {
    "vendor": "  Café \"A\"  ", "amount": "$1,200.50", "year": "2019", "other": "2,019",
    "nested": {"b": None, "a": 1.23456789, "ok": True, "n": 3},
    "empty_list": [], "rows": [{"z": "x", "amount": "(5)"}, {"z": None, "amount": "n/a"}],
    "tags": ["a", "5.5"],
}
SAMPLE_CLEAN = {
    "vendor": "Café \"A\"", "amount": 1200.5, "year": "2019", "other": 2019.0,
    "nested": {"a": 1.234568, "ok": True, "n": 3},
    "empty_list": [], "rows": [{"z": "x", "amount": -5.0}, {"amount": "n/a"}], "tags": ["a", 5.5],
}
SAMPLE_SCHEMA = (
    "c struct<vendor string, amount string, year string, other string,"
    " nested struct<b string, a double, ok boolean, n bigint>, empty_list array<string>,"
    " rows array<struct<z string, amount string>>, tags array<string>>"
)


def test_free_form_and_typed_contexts_agree(spark):
    free = spark.createDataFrame([(json.dumps(SAMPLE),)], "c string")
    got = free.select(json_text.canonical_context("c").alias("r")).select("r.*").first()
    assert got.json == json.dumps(SAMPLE_CLEAN, sort_keys=True) and got.problems == []
    typed = spark.createDataFrame([(SAMPLE,)], SAMPLE_SCHEMA)
    kind = typed.schema["c"].dataType
    row = typed.select(
        json_text.context_json("c", kind).alias("flat"),
        json_text.context_json("c", kind, indent=2).alias("tall"),
    ).first()
    assert row.flat == json.dumps(SAMPLE_CLEAN, sort_keys=True)
    assert row.tall == json.dumps(SAMPLE_CLEAN, sort_keys=True, indent=2)


def test_nulls_in_lists_are_reported(spark):
    value = {"rows": [{"tags": ["a", None]}, None]}
    free = spark.createDataFrame([(json.dumps(value),), ("[1]",), ("{",)], "c string")
    problems = [r.p for r in free.select(json_text.canonical_context("c").problems.alias("p")).collect()]
    assert sorted(problems[0]) == ["null found in context.rows[0].tags[1]", "null found in context.rows[1]"]
    assert problems[1:] == [["context is not an object"], ["context is not JSON"]]
    typed = spark.createDataFrame([(value,)], "c struct<rows array<struct<tags array<string>>>>")
    paths = typed.select(json_text.null_paths(F.col("c"), typed.schema["c"].dataType).alias("p")).first().p
    assert sorted(paths) == ["context.rows[0].tags[1]", "context.rows[1]"]


LABELS = {
    "  manual review! ": ("MANUAL_REVIEW", "review"),
    "Approve with conditions": ("APPROVE_WITH_CONDITIONS", "approve"),
    "TRAVEL": ("TRAVEL", "review"), "": ("UNKNOWN", "review"), "__": ("UNKNOWN", "review"),
    "non deductible": ("NON_DEDUCTIBLE", "reject"), "Rejected": ("REJECTED", "reject"),
}


def test_labels(spark):
    assert apply(spark, labels.canonical_label, list(LABELS)) == [label for label, _ in LABELS.values()]
    assert apply(spark, labels.decision_bucket, list(LABELS)) == [bucket for _, bucket in LABELS.values()]


def test_confidence_bounds(spark):
    low = apply(spark, lambda c: labels.confidence(F.lit("UNKNOWN"), c), ["unlikely to work"])
    high = apply(spark, lambda c: labels.confidence(F.lit("APPROVE"), c), [" ".join(["word"] * 20)])
    assert (low, high) == ([0.44], [0.91])


def test_infinities_and_long_digit_runs(spark):
    digits = "9" * 400
    rows = [(digits, float("inf")), (f"({digits})", float("-inf")), ("1,000.5", float("nan")), (None, None)]
    df = spark.createDataFrame(rows, "amount string, x double")
    context = json_text.context_json("c", df.select(F.struct("amount").alias("c")).schema["c"].dataType)
    got = df.select(text.parse_number(F.col("amount")), text.round_exact(F.col("x"), 2), F.struct("amount").alias("c")).select("*", context).collect()
    assert [row[0] for row in got] == [float("inf"), float("-inf"), 1000.5, None]
    assert [row[1] for row in got][:2] == [float("inf"), float("-inf")] and got[2][1] != got[2][1] and got[3][1] is None
    assert [row[3] for row in got][:3] == ['{"amount": Infinity}', '{"amount": -Infinity}', '{"amount": 1000.5}']


def test_quoting_scans_for_what_a_text_has(spark):
    """Only the two printable escapes are looked for in every text; all others once per character found."""
    assert json_text.QUOTE_SQL.count("replace(") == 3
    odd = [chr(n) for n in (*range(0x300), 0x2028, 0xFFFF, 0x1F600)]
    texts = [*odd, *[f"{c}a\\{c}\n\"\\n{c}" for c in odd], "".join(odd), "", "plain"]
    quoted = spark.createDataFrame([(text,) for text in texts], "s string").select("s", json_text.quote(F.col("s")).alias("q"))
    assert all(row.q == json.dumps(row.s) for row in quoted.collect())
    assert spark.sql("SELECT cast(NULL AS STRING) AS s").select(json_text.quote(F.col("s"))).first()[0] is None
