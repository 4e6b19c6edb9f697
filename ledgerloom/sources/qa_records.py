"""Question/answer sources -> raw records ready for canonicalisation.

A source record is JSON text of unknown shape. Fields are taken from its variant
form by fallback chains; nothing leaves generated and built-in expressions here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.json_text import FLOAT_SQL, QUOTE_SQL, quote
from ledgerloom.functions.text import SPACE, decision_text, sql_let
from ledgerloom.operators.records import canonical_records
from ledgerloom.operators.scale import broadcast_if_small, running_cuts
from ledgerloom.sources.files import load_records

RECORDS_PER_BUCKET = 4096

# Where each source keeps its parts, in order of preference.
FINQA = {
    "question": ("question", "qa.question"),
    "answer": ("answer", "qa.answer", "qa.exe_ans"),
    "reasoning": ("reasoning", "qa.program", "qa.program_re", "gold_inds"),
}
REPORT = {
    "company": ("company", "company_name"),
    "table": ("table", "table_ori"),
    "text": ("pre_text", "post_text", "text"),
}
TURN_LISTS = ("qa", "qas", "questions", "conversation", "dialogue", "turns")
TURN = {
    "question": ("question", "query"),
    "answer": ("answer", "exe_ans", "final_answer"),
    "reasoning": ("program", "reasoning"),
}
GENERIC = {
    "question": ("question", "instruction", "query", "prompt"),
    "answer": ("answer", "final_answer", "response", "gold_answer"),
    "reasoning": ("reasoning", "rationale", "analysis", "cot", "explanation"),
    "company": ("company", "ticker"),
    "period": ("period", "fiscal_period"),
    "text": ("context", "documents", "evidence", "supporting_passages"),
}


@dataclass(frozen=True)
class Source:
    name: str
    category: str
    shape: str


# The four sources, in the order they are concatenated.
SOURCES = {
    "finqa": Source("FinQA", "finqa_reasoning", "report"),
    "convfinqa": Source("ConvFinQA", "convfinqa_reasoning", "turns"),
    "financebench": Source("FinanceBench", "financebench_reasoning", "generic"),
    "finr1": Source("FinR1", "finr1_reasoning", "generic"),
}


# --- values of unknown type ------------------------------------------------------

# A variant ``f`` as struct(kind, text), null when absent or JSON null. Lists and
# objects are cut out of the JSON text where there is one, because a variant
# would turn ``1.0`` inside them into ``1``.
def _value_sql(document: str, path: str, text: str | None) -> str:
    nested = "to_json(f)" if text is None else f"get_json_object({text}, '$.{path}')"
    number = sql_let("cast(try_variant_get(f, '$', 'string') AS DOUBLE)", "x", FLOAT_SQL)
    body = f"""
CASE WHEN f IS NOT NULL AND schema_of_variant(f) <> 'VOID' THEN named_struct(
  'kind', schema_of_variant(f),
  'text', CASE
    WHEN schema_of_variant(f) RLIKE '^(ARRAY|OBJECT)' THEN {nested}
    WHEN schema_of_variant(f) RLIKE '^(DECIMAL|DOUBLE|FLOAT)' THEN {number}
    WHEN schema_of_variant(f) = 'BOOLEAN' THEN initcap(try_variant_get(f, '$', 'string'))
    ELSE try_variant_get(f, '$', 'string') END) END"""
    return sql_let(f"try_variant_get({document}, '$.{path}', 'variant')", "f", body)


# Is the value ``v`` neither absent, empty, zero nor false?
TRUTHY_SQL = """
(v IS NOT NULL AND coalesce(CASE
  WHEN v.kind = 'STRING' THEN v.text <> ''
  WHEN v.kind = 'BOOLEAN' THEN v.text = 'True'
  WHEN startswith(v.kind, 'ARRAY') THEN v.text <> '[]'
  WHEN startswith(v.kind, 'OBJECT') THEN v.text <> '{}'
  ELSE coalesce(try_cast(v.text AS DOUBLE) <> 0, true) END, false))"""


def truthy_sql(value: str) -> str:
    return sql_let(value, "v", TRUTHY_SQL)


def picked_sql(document: str, paths: Sequence[str], text: str | None = None) -> str:
    """The first truthy field; the last one is taken as it is."""
    *early, last = [_value_sql(document, path, text) for path in paths]
    tried = [sql_let(value, "v", f"CASE WHEN {TRUTHY_SQL} THEN v END") for value in early]
    return f"coalesce({', '.join([*tried, last])})"


def as_json(value: str) -> Column:
    """A picked value as JSON; an absent one as null."""
    return F.expr(f"""
coalesce(CASE
  WHEN {value}.kind = 'STRING' THEN {sql_let(f"{value}.text", "s", QUOTE_SQL)}
  WHEN {value}.kind = 'BOOLEAN' THEN lower({value}.text)
  ELSE {value}.text END, 'null')""")


# Compact JSON ``s`` with a space after every colon and comma outside strings.
# Raw JSON holds no control characters, so two of them can stand for the escapes
# that hide a quote; what lies between two quotes is then every second part.
SPACED_SQL = r"""
replace(replace(array_join(transform(
  split(replace(replace(s, '\\\\', chr(1)), '\\"', chr(2)), '"'),
  (p, i) -> CASE WHEN i % 2 = 0 THEN replace(replace(p, ',', ', '), ':', ': ') ELSE p END), '"'),
  chr(2), '\\"'), chr(1), '\\\\')"""


def assembled_sql(document: str, paths: Sequence[str]) -> str:
    """Fragments of several fields, one per line.

    Lists contribute their truthy items, objects their sorted JSON; blank
    fragments are dropped. Booleans print as ``True`` and ``False``, whole
    floats with ``.0``.
    """

    def shown(item: str) -> str:
        plain = f"try_variant_get({item}, '$', 'string')"
        number = sql_let(f"cast({plain} AS DOUBLE)", "x", FLOAT_SQL)
        return f"""
CASE WHEN schema_of_variant({item}) RLIKE '^(ARRAY|OBJECT)' THEN {sql_let(f"to_json({item})", "s", SPACED_SQL)}
  WHEN schema_of_variant({item}) RLIKE '^(DECIMAL|DOUBLE|FLOAT)' THEN {number}
  WHEN schema_of_variant({item}) = 'BOOLEAN' THEN initcap({plain})
  ELSE coalesce({plain}, to_json({item})) END"""

    empty = "'null', '\"\"', '0', '0.0', 'false', '[]', '{}'"
    fragments = [
        sql_let(
            f"try_variant_get({document}, '$.{path}', 'variant')",
            "f",
            f"""
coalesce(
  transform(filter(try_variant_get(f, '$', 'array<variant>'), i -> to_json(i) NOT IN ({empty})),
            i -> {shown("i")}),
  CASE WHEN f IS NOT NULL AND schema_of_variant(f) <> 'VOID' THEN array({shown("f")}) END,
  cast(array() AS array<string>))""",
        )
        for path in paths
    ]
    stripped = f"regexp_replace(part, r'(?U)^{SPACE}++|{SPACE}++$', '')"
    parts = f"transform(concat({', '.join(fragments)}), part -> {stripped})"
    return f"array_join(filter({parts}, part -> part <> ''), '\\n')"


def answer_text(answer: Column, reasoning: str) -> Column:
    """The answer, followed by its reasoning trace if there is one."""
    trace = f"CASE WHEN {truthy_sql(reasoning)} THEN concat(' Reasoning trace: ', {reasoning}.text) ELSE '' END"
    return F.concat(answer, F.expr(trace))


def _members(members: dict[str, Column]) -> Column:
    parts: list[Column] = []
    for at, (name, value) in enumerate(members.items()):
        parts += [F.lit(("" if at == 0 else ", ") + f'"{name}": '), value]
    return F.concat(*parts)


def _object(members: dict[str, Column]) -> Column:
    return F.concat(F.lit("{"), _members(members), F.lit("}"))


# --- converters ------------------------------------------------------------------


def _picked(rows: DataFrame, chains: dict[str, Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Add ``_<name>`` structs for some chains of the record in ``_doc``."""
    return rows.selectExpr(
        "*", *[f"{picked_sql('_doc', chains[name], 'record')} AS _{name}" for name in names]
    )


def _answered(rows: DataFrame, chains: dict[str, Sequence[str]], extra: Sequence[str]) -> DataFrame:
    """Usable records with the text of their question and answer.

    A record becomes a list of one question or none. A filter on the picked
    fields would be moved below them and parse and pick every record twice.
    """
    picked = _picked(rows, chains, ["question", "answer", "reasoning", *extra])
    usable = F.expr(truthy_sql("_question")) & F.col("_answer").isNotNull()
    asked = F.struct(F.col("_question.text").alias("question"), F.col("_answer.text").alias("answer"))
    return (
        picked.select("*", F.explode_outer(F.when(usable, F.array(asked))).alias("_asked"))
        .filter(F.col("_asked").isNotNull())
        .withColumn("_question", F.col("_asked.question"))
        .withColumn("_answer", F.col("_asked.answer"))
        .drop("_asked")
    )


def _finished(rows: DataFrame, context: Column, category: Column, source: Column) -> DataFrame:
    """Raw records; needs ``turn_ord``, ``_id``, ``_question``, ``_answer``, ``_reasoning``."""
    return rows.select(
        "file_ord",
        "record_ord",
        "turn_ord",
        F.col("_id").alias("id"),
        F.col("_question").alias("instruction"),
        context.alias("context"),
        decision_text(F.lit("ANSWER"), answer_text(F.col("_answer"), "_reasoning")).alias("output"),
        category.alias("category"),
        source.alias("source"),
    )


def _text_json(chains: dict[str, Sequence[str]]) -> Column:
    return F.expr(sql_let(assembled_sql("_doc", chains["text"]), "s", QUOTE_SQL))


def report_rows(rows: DataFrame) -> DataFrame:
    """One question per report record."""
    source = SOURCES["finqa"]
    answered = _answered(rows, {**FINQA, **REPORT}, ["company", "table"])
    context = _object(
        {
            "dataset": quote(F.lit(source.name)),
            "company": as_json("_company"),
            "table": as_json("_table"),
            "report_text": _text_json(REPORT),
            "reasoning_steps": as_json("_reasoning"),
        }
    )
    return _finished(answered.withColumn("turn_ord", F.lit(0)), context, F.lit(source.category), F.lit(source.name))


def generic_rows(rows: DataFrame, source: Source) -> DataFrame:
    """One question per record, with many spellings of its parts."""
    answered = _answered(rows, GENERIC, ["company", "period"])
    context = _object(
        {
            "dataset": quote(F.lit(source.name)),
            "company": as_json("_company"),
            "period": as_json("_period"),
            "report_text": _text_json(GENERIC),
            "reasoning_steps": as_json("_reasoning"),
        }
    )
    return _finished(answered.withColumn("turn_ord", F.lit(0)), context, F.lit(source.category), F.lit(source.name))


def turns_sql(document: str) -> str:
    """The first turn field that holds a list, as usable and unusable turns.

    Each turn has its position, its question and answer text, its reasoning and
    whether it is usable.
    """
    lists = [f"try_variant_get({document}, '$.{key}', 'array<variant>')" for key in TURN_LISTS]
    fields = ", ".join(f"'{name}', {picked_sql('t', TURN[name])}" for name in TURN)
    picked = f"transform(coalesce({', '.join(lists)}), (t, i) -> named_struct('at', i, {fields}))"
    return f"""
transform({picked}, p -> named_struct(
  'turn_ord', p.at, 'question', p.question.text, 'answer', p.answer.text, 'reasoning', p.reasoning,
  'usable', {truthy_sql("p.question")} AND p.answer IS NOT NULL))"""


def with_history(rows: DataFrame, turns: str) -> DataFrame:
    """One row per usable turn (in ``_turn``), with the JSON of the turns before it.

    ``turns`` is an array of structs with at least ``turn_ord, question, answer,
    usable``. Each pair is written once per record; a turn's ``_history`` joins
    the slice in front of it, and ``_before`` counts that slice. All of it
    happens inside the row, without a shuffle.
    """
    question, answer = (
        sql_let(f"u.{name}", "s", QUOTE_SQL) for name in ("question", "answer")
    )
    pair = f"""concat('{{"question": ', {question}, ', "answer": ', {answer}, '}}')"""
    # An inner explode would have the planner filter on the size of ``_usable``
    # below it, which takes all turns of every record apart a second time.
    return (
        rows.withColumn("_usable", F.expr(f"filter({turns}, u -> u.usable)"))
        .withColumn("_written", F.expr(f"transform(_usable, u -> {pair})"))
        .select("*", F.posexplode_outer("_usable").alias("_before", "_turn"))
        .filter(F.col("_before").isNotNull())
        .withColumn(
            "_history",
            F.expr("concat('[', array_join(slice(_written, 1, _before), ', '), ']')"),
        )
        .drop("_usable", "_written")
    )


def _question_sql() -> str:
    """A record without turns as its only turn, read as a report question."""
    names = ("question", "answer", "reasoning")
    fields = ", ".join(f"'{name}', {picked_sql('_doc', FINQA[name], 'record')}" for name in names)
    turn = f"""array(named_struct(
  'turn_ord', 0, 'question', p.question.text, 'answer', p.answer.text, 'reasoning', p.reasoning,
  'usable', {truthy_sql("p.question")} AND p.answer IS NOT NULL))"""
    return sql_let(f"named_struct({fields})", "p", turn)


def turn_rows(rows: DataFrame) -> DataFrame:
    """One row per usable turn of a conversation record.

    Unusable turns still count in the numbering. A record without turns is read
    as a single report question. Records are taken apart once, and what all turns
    of a record share is written before they are told apart.
    """
    def either(single: str, turn: str) -> Column:
        return F.when(F.col("_alone"), F.lit(single)).otherwise(F.lit(turn))

    single, source = SOURCES["finqa"], SOURCES["convfinqa"]
    name = either(single.name, source.name)
    shared = _members(
        {
            "dataset": quote(name),
            "company": as_json("_company"),
            "table": as_json("_table"),
            "report_text": _text_json(REPORT),
        }
    )
    records = (
        _picked(rows, REPORT, ["company", "table"])
        .withColumn("_alone", F.coalesce(F.size("_turns"), F.lit(0)) <= 0)
        .withColumn("_asked", F.expr(f"CASE WHEN _alone THEN {_question_sql()} ELSE _turns END"))
        .select("file_ord", "record_ord", "_id", "_alone", "_asked", shared.alias("_shared"))
    )
    turns = with_history(records, "_asked").select(
        "*",
        F.col("_turn.turn_ord").alias("turn_ord"),
        F.col("_turn.question").alias("_question"),
        F.col("_turn.answer").alias("_answer"),
        F.col("_turn.reasoning").alias("_reasoning"),
    ).withColumn("_id", F.format_string("%s-%03d", "_id", "turn_ord"))
    told = F.when(F.col("_alone"), "").otherwise(F.concat(F.lit(', "conversation_history": '), "_history"))
    context = F.concat(F.lit("{"), "_shared", told, F.lit(", "), _members({"reasoning_steps": as_json("_reasoning")}), F.lit("}"))
    return _finished(turns, context, either(single.category, source.category), name)


def paired_turns(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Message table -> one row per user turn answered by the next turn.

    The answer is fetched by an equi-join on (conversation, turn + 1), which is
    unique, so a conversation with a third of all messages still spreads.
    """
    asked = messages.filter((F.col(role) == "user") & (F.col(text) != "")).select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn_ord"),
        (F.col(turn) + 1).alias("_next"),
        F.col(text).alias("question"),
    )
    replies = messages.filter((F.col(role) == "assistant") & F.col(text).isNotNull()).select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("_next"),
        F.col(text).alias("answer"),
    )
    return asked.join(replies, ["conversation", "_next"]).drop("_next")


def _outputs(source: Source) -> str:
    """How many output rows a source record will give."""
    chains = GENERIC if source.shape == "generic" else FINQA
    question, answer = (picked_sql("_doc", chains[name], "record") for name in ("question", "answer"))
    single = f"cast({truthy_sql(question)} AND {answer} IS NOT NULL AS BIGINT)"
    if source.shape != "turns":
        return single
    usable = "cast(size(filter(_turns, u -> u.usable)) AS BIGINT)"
    return f"CASE WHEN coalesce(size(_turns), 0) > 0 THEN {usable} ELSE {single} END"


def capped(rows: DataFrame, outputs: str, cap: int, source: str | None = None) -> DataFrame:
    """Input records read before the outputs reach ``cap``.

    The cap is looked at before each record, so one record with many outputs may
    overshoot it. Running sums are taken per bucket of records; only the bucket
    in which the cap is reached is looked at row by row. Buckets hold at least
    ``RECORDS_PER_BUCKET`` records and grow with the square root of their number,
    so neither the list of buckets nor a single one becomes large.
    """
    if cap <= 0:
        return rows.filter(F.lit(False))
    per_bucket = max(RECORDS_PER_BUCKET, math.isqrt(rows.count()))
    name = source or "_source"
    marked = rows if source else rows.withColumn(name, F.lit("all"))
    placed = marked.withColumn(
        "_bucket", F.floor(F.col("record_ord") / F.lit(per_bucket)).cast("bigint")
    )
    cuts = running_cuts(
        placed.select(name, "file_ord", "_bucket", "record_ord", outputs),
        [name],
        ["file_ord", "_bucket"],
        ["file_ord", "record_ord"],
        outputs,
        targets={"cap": F.lit(cap)},
    )
    joined = broadcast_if_small(cuts, [name], placed)
    here = F.struct("file_ord", "record_ord")
    kept = joined.filter(F.coalesce(here <= F.col("cap_key"), F.lit(True))).drop("_bucket", "cap_key")
    return kept if source else kept.drop(name)


def convert(records: DataFrame, source: Source, cap: int | None = None) -> DataFrame:
    """``file_ord, record_ord, record`` rows -> raw records of one source."""
    rows = records.withColumn("_doc", F.parse_json("record")).withColumn(
        "_id",
        F.format_string(f"{source.name.lower()}-%03d-%06d", "file_ord", "record_ord"),
    )
    if source.shape == "turns":
        rows = rows.withColumn("_turns", F.expr(turns_sql("_doc")))
    if cap is not None:
        rows = capped(rows.withColumn("_outputs", F.expr(_outputs(source))), "_outputs", cap)
    if source.shape == "report":
        return report_rows(rows)
    return turn_rows(rows) if source.shape == "turns" else generic_rows(rows, source)


def import_source(
    spark: SparkSession, roots: Sequence[str], source: str, cap: int | None = None
) -> DataFrame:
    """One source's files as canonical records, with their ordinals."""
    found = SOURCES[source]
    raw = convert(load_records(spark, roots), found, cap)
    return canonical_records(raw, keep=("file_ord", "record_ord", "turn_ord"))


def import_all(
    spark: SparkSession, roots: dict[str, Sequence[str]], cap: int | None = None
) -> DataFrame:
    """All sources in their fixed order; ``import_ord`` tells them apart."""
    if not any(roots.get(name) for name in SOURCES):
        raise ValueError(f"no folder is given for any of {sorted(SOURCES)}")
    parts = [
        import_source(spark, roots[name], name, cap).withColumn("import_ord", F.lit(at))
        for at, name in enumerate(SOURCES)
        if roots.get(name)
    ]
    return reduce(DataFrame.unionByName, parts)
