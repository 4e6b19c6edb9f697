"""Every operator as a named query over whole driver tables.

Each query takes (spark, folder of Parquet tables) and returns a DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import draws, json_text, labels, text
from ledgerloom.operators import (
    corpus, metrics, records, render, responses, rules, scenarios, split, wording,
)
from ledgerloom.plans.corpus_build import build_corpus, write_build
from ledgerloom.session import checkpointed, shared_folder
from ledgerloom.sources import files, qa_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(column: str) -> Column:
    """Microseconds since the epoch of a zone-less timestamp."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def cents_sum(column: str) -> Column:
    """Exact money sum, independent of the order in which partial sums meet."""
    return F.sum(F.col(column).cast("decimal(28,2)")).cast("double")


# --- text -------------------------------------------------------------------------


@query
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    clean = text.squeeze(F.col("text"))
    return docs.select(
        "doc_id",
        F.md5(clean).alias("clean_md5"),
        F.length(clean).cast("bigint").alias("clean_length"),
        F.md5(text.comparable(F.col("text"))).alias("comparable_md5"),
    )


@query
def output_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("lines", text.squeeze_lines(F.col("text")))
    return docs.select(
        "doc_id",
        F.md5("lines").alias("lines_md5"),
        F.length("lines").cast("bigint").alias("lines_length"),
    )


@query
def money_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", text.money(F.col("o_totalprice")).alias("money")
    )


def _written_balance() -> Column:
    """Balances in several spellings: accounting, money, percent, code, padded."""
    balance, spelling = F.col("c_acctbal"), F.col("c_custkey") % 5
    return (
        F.when(spelling == 0, F.concat(F.lit("("), text.money(F.abs(balance)), F.lit(")")))
        .when(spelling == 1, text.money(balance))
        .when(spelling == 2, F.concat(F.format_number(balance, 2), F.lit("%")))
        .when(spelling == 3, F.concat(F.lit("PO-"), F.col("c_custkey").cast("string")))
        .otherwise(F.concat(F.lit(" \t"), F.format_number(balance, 2), F.lit("\n")))
    )


@query
def parse_number(spark: SparkSession, folder: str) -> DataFrame:
    written = table(spark, folder, "customer").withColumn("written", _written_balance())
    return written.select("c_custkey", text.parse_number(F.col("written")).alias("number"))


@query
def numeric_gate(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document would pass as names of numbers."""
    words = F.split(text.squeeze(F.col("text")), " ")
    named = F.filter(words, text.names_a_number)
    return table(spark, folder, "documents").select(
        "doc_id", F.size(words).cast("bigint").alias("words"), F.size(named).cast("bigint").alias("numeric_names")
    )


@query
def json_context(spark: SparkSession, folder: str) -> DataFrame:
    """Free-form contexts of events, canonicalised by the Arrow UDF."""
    written = F.concat(
        F.lit('{"type": "  '), F.col("event_type"), F.lit(' ", "amount": "'), text.money(F.col("value")),
        F.lit('", "note": null, "year": "'), F.year("ts").cast("string"), F.lit('", "seen": [1, 2.50, "'),
        F.format_number("value", 1), F.lit('"], "props": '), F.col("props"), F.lit("}"),
    )
    events = table(spark, folder, "events").select("event_id", written.alias("context"))
    canonical = events.withColumn("canonical", json_text.canonical_context("context"))
    return canonical.select(
        "event_id",
        F.col("canonical.json").alias("context"),
        F.size("canonical.problems").cast("bigint").alias("problems"),
    )


def _free_form(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON text of changing shape: nulls in lists and objects, numbers in texts, missing and broken contexts."""
    key, kind = F.col("event_id"), F.col("event_type")
    sizes = (
        F.when(key % 3 == 0, F.concat(F.lit("[null, "), F.col("user_id").cast("string"), F.lit(", null]")))
        .when(key % 3 == 1, F.lit('[[], {"deep": [true, null], "gone": null}]'))
        .otherwise(F.lit("{}"))
    )
    whole = F.concat(F.lit('{"sizes": '), sizes, F.lit(', "kind": "'), kind, F.lit('", "props": '), F.col("props"), F.lit("}"))
    context = (
        F.when(key % 11 == 5, F.concat(F.lit("["), whole, F.lit("]")))
        .when(key % 11 == 7, F.lit("{broken"))
        .when(key % 11 != 9, whole)
    )
    return table(spark, folder, "events").select("event_id", kind.alias("category"), context.alias("context"))


@query
def context_problems(spark: SparkSession, folder: str) -> DataFrame:
    """What is wrong with free-form contexts: nulls left in lists, texts that are no JSON object, none at all."""
    canonical = _free_form(spark, folder).withColumn("canonical", json_text.canonical_context("context"))
    return canonical.select(
        "event_id", F.col("canonical.json").alias("context"), F.array_join("canonical.problems", "; ").alias("problems")
    )


# --- records ----------------------------------------------------------------------


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw records without ids; the context is typed."""
    return table(spark, folder, "documents").select(
        F.lit(None).cast("string").alias("id"),
        F.lit("Summarise  the text.\n").alias("instruction"),
        F.struct(F.col("lang"), F.length("text").alias("size")).alias("context"),
        F.col("text").alias("output"),
        F.col("lang").alias("category"),
        F.col("source"),
        F.col("doc_id").alias("ord"),
        F.lit(0).alias("part"),
    )


def conversation_records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.format_string("conv-%d-%d", "conv_id", "turn").alias("id"),
        F.lit("Continue the conversation.").alias("instruction"),
        F.struct(F.col("role")).alias("context"),
        F.col("text").alias("output"),
        F.lit("conversation").alias("category"),
        F.lit(None).cast("string").alias("source"),
        F.col("conv_id").alias("ord"),
        F.col("turn").cast("int").alias("part"),
    )


@query
def canonical_records(spark: SparkSession, folder: str) -> DataFrame:
    done = records.canonical_records(document_records(spark, folder), keep=["ord"])
    return done.select(
        "ord", "id", "instruction", "context", F.md5("output").alias("output_md5"), "category", "source",
        F.size("violations").cast("bigint").alias("violations"),
    )


@query
def record_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with holes punched into them, and what the guard says."""
    docs = table(spark, folder, "documents")
    spot = F.col("doc_id") % 4
    raw = docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(spot == 1, F.lit(" \t")).otherwise(F.col("source")).alias("instruction"),
        F.struct(F.array(F.col("n_chars"), F.when(spot != 2, F.col("doc_id"))).alias("sizes")).alias("context"),
        F.when(spot == 3, F.concat(F.lit("Decision: "), F.col("lang"))).otherwise(F.col("lang")).alias("output"),
        F.col("lang").alias("category"),
    )
    bad = records.rejected(records.canonical_records(raw))
    return bad.select("id", F.array_join("violations", "; ").alias("violations"))


@query
def content_id(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    made = records.content_id(
        F.col("role"),
        F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit("}")),
        F.lit("Continue."),
        F.col("text"),
    )
    return turns.select("conv_id", "turn", made.alias("content_id"))


@query
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return corpus.exact_dedup(docs, ["doc_id"], ["text"]).select("doc_id", "lang", "source")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("text", F.col("lang").alias("category"), "source")
    talk = table(spark, folder, "conversations").select("text", F.col("role").alias("category"))
    return corpus.merge([docs, talk])


@query
def merge_summary(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.merge_summary(_texts(spark, folder), ["text"])


@query
def category_source_counts(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.category_source_counts(_texts(spark, folder))


# --- rendering --------------------------------------------------------------------


@query
def prompt_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    typed = docs.select("doc_id", "text", F.struct("lang", "n_chars", "source").alias("context"))
    kind = typed.schema["context"].dataType
    shown = render.prompt(F.lit("Summarise the text."), json_text.context_json("context", kind, indent=2))
    rendered = typed.select("doc_id", "text", shown.alias("prompt"))
    return rendered.select(
        "doc_id",
        F.md5("prompt").alias("prompt_md5"),
        F.md5(render.training_text(F.col("prompt"), F.col("text"))).alias("text_md5"),
    )


@query
def prompt_free_form(spark: SparkSession, folder: str) -> DataFrame:
    """Free-form contexts as canonical records, the valid ones rendered with indented contexts."""
    raw = _free_form(spark, folder).select(
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("id"),
        F.lit("Judge the event.").alias("instruction"),
        "context",
        F.concat(F.lit("Decision: APPROVE\nReason: "), F.col("category")).alias("output"),
        "category",
    )
    rendered = render.enriched(records.accepted(records.canonical_records(raw)))
    return rendered.select("id", F.md5("prompt").alias("prompt_md5"), F.md5("text").alias("text_md5"))


@query
def length_stats(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return render.length_stats(docs, F.length("text"), ["lang"])


@query
def truncate_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    words = F.split(text.squeeze(F.col("text")), " ")
    cut = render.token_rows(docs, words, max_length=256, keep=["doc_id"])
    return cut.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("tokens"),
        F.md5(F.array_join("labels", " ")).alias("labels_md5"),
    )


# --- splits -----------------------------------------------------------------------


@query
def allocate_counts(spark: SparkSession, folder: str) -> DataFrame:
    totals = table(spark, folder, "documents").groupBy("lang", "source").agg(F.count("*").alias("total"))
    return split.allocate_counts(totals, "total", (0.8, 0.1, 0.1))


@query
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return split.stratified_split(docs, stratum="lang", row_id="doc_id")


@query
def step_plan(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    labelled = split.stratified_split(orders, stratum="o_orderpriority", row_id="o_orderkey")
    return split.split_sizes(labelled)


@query
def shuffle_order(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    mixed = split.shuffled(docs, seed=7, row_id="doc_id")
    return mixed.withColumn("order_key", draws.order_key(7, F.col("doc_id")))


@query
def limit_after_filter(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return split.first_rows(docs, 250, ["doc_id"], ["fr", "de"], "lang")


# --- sources ----------------------------------------------------------------------


@query
def turn_rows(spark: SparkSession, folder: str) -> DataFrame:
    paired = qa_records.paired_turns(table(spark, folder, "conversations"))
    return paired.select(
        F.format_string("conversations-%d-%03d", "conversation", "turn_ord").alias("id"),
        F.md5(text.squeeze(F.col("question"))).alias("instruction_md5"),
        F.md5(text.decision_text(F.lit("ANSWER"), F.col("answer"))).alias("output_md5"),
    )


@query
def turn_history(spark: SparkSession, folder: str) -> DataFrame:
    """Documents read as conversations: lines in turn are question and answer."""
    docs = table(spark, folder, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    turns = """
transform(sequence(0, cast(ceil(size(lines) / 2) AS INT) - 1), n -> named_struct(
  'turn_ord', n, 'question', get(lines, 2 * n), 'answer', get(lines, 2 * n + 1),
  'usable', get(lines, 2 * n) <> '' AND get(lines, 2 * n + 1) IS NOT NULL))"""
    told = qa_records.with_history(docs.withColumn("turns", F.expr(turns)), "turns")
    return told.select(
        F.format_string("doc-%06d-%03d", "doc_id", "_turn.turn_ord").alias("id"),
        F.col("_before").cast("bigint").alias("earlier"),
        F.md5("_history").alias("history_md5"),
    )


@query
def assemble_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text fragments of every type: a list of lines, a missing one, a list of all kinds of items."""
    turns = table(spark, folder, "conversations")
    record = F.to_json(
        F.struct(
            F.split("text", "\n").alias("pre_text"),
            F.when(F.col("role") != "system", F.col("role")).alias("post_text"),
        )
    )
    odd = F.concat(
        F.lit(', "text": [true, false, 12.0, {"b":'), F.col("turn"), F.lit(',"a":"x, \\"'), F.col("role"),
        F.lit(':y"}, '), F.col("turn"), F.lit("]}"),
    )
    whole = F.concat(F.substring(record, F.lit(1), F.length(record) - 1), odd)
    parsed = turns.withColumn("doc", F.parse_json(whole))
    joined = F.expr(qa_records.assembled_sql("doc", qa_records.REPORT["text"]))
    return parsed.select("conv_id", "turn", F.md5(joined).alias("joined_md5"))


@query
def truthy_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    """Answers hidden behind empty values of every type, with a reasoning trace."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    record = (
        F.when(kind == "view", F.concat(F.lit('{"answer": 0, "final_answer": '), value, F.lit("}")))
        .when(kind == "click", F.lit('{"answer": "", "response": "clicked", "cot": "because"}'))
        .when(kind == "purchase", F.lit('{"answer": [], "final_answer": {}, "gold_answer": 0, "analysis": 0}'))
        .when(kind == "signup", F.lit('{"answer": false, "response": null, "gold_answer": ""}'))
        .otherwise(F.concat(F.lit('{"answer": "0", "rationale": '), F.col("props"), F.lit("}")))
    )
    rows = table(spark, folder, "events").select(
        "event_id", record.alias("record"), F.parse_json(record).alias("doc")
    )
    picked = rows.selectExpr(
        "event_id",
        f"{qa_records.picked_sql('doc', qa_records.GENERIC['answer'], 'record')} AS answer",
        f"{qa_records.picked_sql('doc', qa_records.GENERIC['reasoning'], 'record')} AS reasoning",
    )
    return picked.select(
        "event_id", qa_records.answer_text(F.col("answer.text"), "reasoning").alias("answer")
    )


def _imported(records: DataFrame, source: str) -> DataFrame:
    """Raw records of one source, the long fields as digests."""
    raw = qa_records.convert(records, qa_records.SOURCES[source])
    digests = [F.md5(name).alias(f"{name}_md5") for name in ("instruction", "context", "output")]
    return raw.select("id", F.col("turn_ord").cast("bigint").alias("turn_ord"), *digests, "category", "source")


def _as_records(spark: SparkSession, folder: str, *fields: Column) -> DataFrame:
    """Documents as JSON records of the given fields; null fields are left out."""
    return _records_of(table(spark, folder, "documents"), *fields)


def _records_of(docs: DataFrame, *fields: Column) -> DataFrame:
    return docs.select(
        F.lit(3).alias("file_ord"), F.col("doc_id").alias("record_ord"), F.to_json(F.struct(*fields)).alias("record")
    )


@query
def import_report(spark: SparkSession, folder: str) -> DataFrame:
    """Report records: empty or missing questions and missing answers go, a zero answer stays."""
    answer = F.when(F.col("lang") == "de", F.lit(0)).when(F.col("lang") != "fr", F.length("text"))
    inner = F.struct(F.col("text").alias("question"), answer.alias("exe_ans"), F.col("lang").alias("program"))
    records = _as_records(
        spark, folder, inner.alias("qa"), F.array("lang", F.lit(" "), "source").alias("pre_text"),
        F.when(F.col("lang") != "es", F.col("source")).alias("company_name"),
    )
    return _imported(records, "finqa")


@query
def import_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation records whose turns are pairs of lines; empty questions and missing answers only count."""
    docs = table(spark, folder, "documents").withColumn("lines", F.split("text", "\n"))
    turns = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size("lines") / 2).cast("int") - 1),
        lambda n: F.struct(F.get("lines", 2 * n).alias("query"), F.get("lines", 2 * n + 1).alias("final_answer")),
    )
    return _imported(_records_of(docs, F.col("source").alias("company"), turns.alias("dialogue")), "convfinqa")


@query
def import_generic(spark: SparkSession, folder: str) -> DataFrame:
    """Both sources of the generic shape, with other spellings of the same parts."""
    period, evidence = F.col("doc_id").alias("fiscal_period"), F.array("lang", "source").alias("evidence")
    first = _as_records(
        spark, folder, F.col("text").alias("prompt"), F.nullif("lang", F.lit("fr")).alias("gold_answer"),
        F.col("source").alias("cot"), F.col("lang").alias("ticker"), period, evidence,
    )
    second = _as_records(
        spark, folder, F.lit("").alias("question"), F.col("text").alias("query"), F.length("text").alias("response"),
        F.array().cast("array<string>").alias("rationale"), period, F.col("source").alias("documents"),
    )
    return _imported(first, "financebench").unionByName(_imported(second, "finr1"))


@query
def unwrap_json(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-file JSON of every form: a list, a wrapper key, several lists, a bare object."""
    item = F.to_json(F.struct(F.col("text").alias("t")))
    other = F.to_json(F.struct(F.col("source").alias("t")))
    lang = F.col("lang")
    document = (
        F.when(lang == "en", F.concat(F.lit(" [1, "), item, F.lit(', null, [2], "x", '), other, F.lit("]")))
        .when(lang == "de", F.concat(F.lit('{"a": ['), other, F.lit('], "records": ['), item, F.lit("]}\n")))
        .when(lang == "fr", F.concat(F.lit('{"a": ['), item, F.lit('], "b": 3, "c": ['), other, F.lit("]}")))
        .otherwise(item)
    )
    found = table(spark, folder, "documents").select("doc_id", F.posexplode(files.unwrapped(document)).alias("place", "record"))
    return found.select(
        "doc_id", F.col("place").cast("bigint").alias("place"), F.md5(F.get_json_object("record", "$.t")).alias("record_md5")
    )


@query
def cap_per_source(spark: SparkSession, folder: str) -> DataFrame:
    """Each source is read until its documents have given 40 lines."""
    docs = table(spark, folder, "documents").select(
        "source",
        F.lit(0).alias("file_ord"),
        F.col("doc_id").alias("record_ord"),
        F.size(F.split("text", "\n")).cast("bigint").alias("outputs"),
    )
    kept = qa_records.capped(docs, "outputs", 40, "source")
    name = F.format_string("%s-%03d-%06d", F.lower("source"), "file_ord", "record_ord")
    return kept.select(name.alias("id"), "outputs")


# --- files ------------------------------------------------------------------------

CSV = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
RECORDS_PER_FILE = 1000


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"


def _write_lists(records: DataFrame, path: str) -> None:
    """JSON files of the form ``{"data": [...]}`` with at most ``RECORDS_PER_FILE`` records each."""
    kept = records.withColumn("bucket", F.floor(F.col("record_ord") / RECORDS_PER_FILE))
    lists = kept.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("record_ord", "record"))).alias("all"))
    document = F.concat(F.lit('{"data": ['), F.array_join("all.record", ", "), F.lit("]}"))
    lists.select("bucket", document.alias("value")).write.partitionBy("bucket").text(path)


@query
def files_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSONL, as JSON lists and as CSV under two headers, then read back with their places."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    root = _scratch(spark)
    kind = F.pmod("doc_id", F.lit(4))
    files.write_jsonl(docs.filter(kind == 0).repartition(3, "doc_id"), f"{root}/a.jsonl", raw=())
    as_json = F.to_json(F.struct(*docs.columns)).alias("record")
    _write_lists(docs.filter(kind == 1).select(F.col("doc_id").alias("record_ord"), as_json), f"{root}/b.json")
    docs.filter(kind == 2).repartition(2, "doc_id").write.options(**CSV).csv(f"{root}/c.csv")
    docs.filter(kind == 3).select("text", "doc_id", "source", "lang").write.options(**CSV).csv(f"{root}/d/d.csv")
    found = checkpointed(files.load_records(spark, [root]))
    places = found.groupBy("file_ord").agg(
        ((F.count("*") == F.max("record_ord") + 1) & (F.count("*") == F.countDistinct("record_ord"))).alias("gapless")
    )
    fields = F.from_json("record", "doc_id string, text string, lang string, source string")
    return found.join(F.broadcast(places), "file_ord").select(fields.alias("r"), "gapless").select(
        F.col("r.doc_id").cast("bigint").alias("doc_id"), F.md5("r.text").alias("text_md5"),
        F.coalesce("r.lang", F.lit("")).alias("lang"), F.coalesce("r.source", F.lit("")).alias("source"), "gapless",
    )


@query
def json_in_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSON lists and read back in byte ranges, with their places in the list."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    root = f"{_scratch(spark)}/lists.json"
    _write_lists(docs.select(F.col("doc_id").alias("record_ord"), F.to_json(F.struct(*docs.columns)).alias("record")), root)
    found = files.read_documents(spark, root, whole_bytes=0)
    fields = F.from_json("record", "doc_id bigint, text string, lang string, source string")
    return found.select(fields.alias("r"), "record_ord").select(
        "r.doc_id", F.md5("r.text").alias("text_md5"), "r.lang", "r.source", "record_ord"
    )


@query
def import_all_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All four sources from their files: JSONL, JSON lists, and CSV files with two headers under one root."""
    root = _scratch(spark)
    answer = F.when(F.col("lang") != "fr", F.length("text"))
    inner = F.struct(F.col("text").alias("question"), answer.alias("exe_ans"), F.col("lang").alias("program"))
    _as_records(spark, folder, inner.alias("qa")).select("record").write.text(f"{root}/finqa/f.jsonl")
    turns = F.array(
        F.struct(F.col("source").alias("query"), F.col("lang").alias("final_answer")),
        F.struct(F.col("text").alias("query"), F.col("source").alias("final_answer")),
    )
    _as_records(spark, folder, turns.alias("dialogue")).select("record").write.text(f"{root}/convfinqa/c.jsonl")
    _write_lists(
        _as_records(spark, folder, F.col("text").alias("prompt"), F.nullif("lang", F.lit("fr")).alias("gold_answer")),
        f"{root}/financebench/b.json",
    )
    docs = table(spark, folder, "documents")
    even = docs.filter(F.pmod("doc_id", F.lit(2)) == 0).select(F.col("text").alias("query"), F.col("lang").alias("response"))
    odd = docs.filter(F.pmod("doc_id", F.lit(2)) == 1).select(F.col("source").alias("answer"), F.col("text").alias("question"))
    even.write.options(**CSV).csv(f"{root}/finr1/one.csv")
    odd.write.options(**CSV).csv(f"{root}/finr1/two.csv")
    found = qa_records.import_all(spark, {name: [f"{root}/{name}"] for name in qa_records.SOURCES})
    return found.select(
        F.col("import_ord").cast("bigint").alias("import_ord"), F.md5("instruction").alias("instruction_md5"), "category", "source",
        F.regexp_replace("id", r"\d{3}-\d{6}", "place").alias("id_form"),
    )


@query
def named_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Files per split name, several each, read as one table with a ``split`` column."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("output"), "source")
    root = _scratch(spark)
    names = ("train", "validation", "test")
    for at, name in enumerate(names):
        part = docs.filter(F.pmod("doc_id", F.lit(len(names))) == at)
        files.write_jsonl(part.repartition(3, "doc_id"), f"{root}/{name}.jsonl")
    found = files.read_split_files(spark, {name: f"{root}/{name}.jsonl" for name in names}, "doc_id bigint, output string, source string")
    return found.select("doc_id", F.md5("output").alias("output_md5"), "source", "split")


# --- rules ------------------------------------------------------------------------


@query
def rule_budget(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    amount = text.round_exact(F.col("o_totalprice") / 50, 2)
    judged = rules.apply_rule(joined, "budget", amount=amount, remaining="c_acctbal")
    return judged.select("o_orderkey", "decision", "reason")


@query
def budget_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: decisions per market segment."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    amount = text.round_exact(F.col("o_totalprice") / 50, 2)
    found = rules.verdict("budget", amount=amount, remaining="c_acctbal")
    return joined.groupBy("c_mktsegment", found.decision.alias("decision")).agg(
        F.count("*").alias("orders"), cents_sum("o_totalprice").alias("total")
    )


@query
def rule_expense(spark: SparkSession, folder: str) -> DataFrame:
    names = [vendor for vendor, _ in wording.VENDOR_BUCKETS] + ["Unlisted vendor"]
    position = (F.col("p_partkey") % len(names)).cast("int") + 1
    parts = table(spark, folder, "part").select(
        "p_partkey",
        F.element_at(F.array(*[F.lit(name) for name in names]), position).alias("vendor"),
        F.col("p_retailprice").alias("amount"),
        F.col("p_brand").alias("team"),
    )
    return rules.classify_expense(parts).select("p_partkey", "decision", "reason")


@query
def velocity_24h(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return rules.with_velocity(events, "user_id", micros("ts")).select("event_id", "velocity_24h")


@query
def rule_fraud(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    counted = rules.with_velocity(events, "user_id", micros("ts"))
    judged = rules.apply_rule(
        counted,
        "fraud",
        amount=F.col("value") * 100,
        geo_mismatch=F.col("event_type").isin("error", "purchase"),
        new_device=F.col("event_type").isin("signup", "purchase"),
        after_hours=(F.hour("ts") < 6) | (F.hour("ts") >= 22),
        card_present=F.col("event_id") % 3 == 0,
    )
    return judged.select("event_id", "risk_score", "decision", "reason")


@query
def rule_policy(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    judged = rules.apply_rule(
        joined,
        "policy",
        amount=text.round_exact(F.col("l_extendedprice") / 40, 2),
        policy_limit=text.round_exact(F.abs("s_acctbal") / 4, 2),
        vendor_approved=F.col("s_acctbal") > 1000,
        receipt_attached=F.col("l_returnflag") != "R",
        manager_approved=F.col("l_linestatus") == "F",
    )
    return judged.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("violations").cast("bigint").alias("violations"), "decision", "reason",
    )


@query
def rule_tax(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_returnflag"
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    bought = F.when(F.col("p_type") == "PROMO", "family vacation flight").otherwise(F.lower("p_type"))
    judged = rules.apply_rule(
        joined,
        "tax",
        expense_type=bought,
        business_use_percent=F.round(F.col("l_discount") * 1000).cast("bigint"),
        receipt_attached=F.col("l_returnflag") != "R",
    )
    return judged.groupBy("decision", "reason").agg(F.count("*").alias("lines"))


@query
def rule_spend_alert(spark: SparkSession, folder: str) -> DataFrame:
    monthly = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"))
        .agg(cents_sum("o_totalprice").alias("actual_spend"))
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    joined = monthly.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    judged = rules.apply_rule(
        joined,
        "spend_alert",
        budget=text.round_exact(F.abs("c_acctbal") * 50 + 1000, 2),
        forecast_spend=text.round_exact(F.col("actual_spend") * 1.04, 2),
    )
    return judged.select("o_custkey", "period", "variance_pct", "decision", "reason")


def _supplier_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Money per supplier and return flag, as figures a rule can look at."""
    flag = F.col("l_returnflag")

    def revenue(of: str) -> Column:
        return F.sum(F.when(flag == of, F.col("l_extendedprice").cast("decimal(28,2)"))).cast("double")

    lines = table(spark, folder, "lineitem")
    sums = lines.groupBy("l_suppkey").agg(
        revenue("A").alias("a"),
        revenue("N").alias("n"),
        revenue("R").alias("r"),
        F.sum(F.col("l_quantity").cast("decimal(28,2)")).cast("double").alias("quantity"),
        F.count("*").alias("lines"),
    )

    def ratio(over: str, under: str) -> Column:
        return F.coalesce(F.try_divide(F.col(over), F.col(under)), F.lit(0.0))

    return sums.select(
        "l_suppkey",
        ratio("a", "n").alias("an"),
        ratio("n", "r").alias("nr"),
        ratio("r", "a").alias("ra"),
        (F.col("quantity") / F.col("lines")).alias("size"),
        F.coalesce("a", F.lit(0.0)).alias("a"),
        F.coalesce("n", F.lit(0.0)).alias("n"),
        F.coalesce("r", F.lit(0.0)).alias("r"),
    )


@query
def rule_investment(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.apply_rule(
        _supplier_figures(spark, folder),
        "investment",
        revenue_growth_pct=(F.col("an") - 0.85) * 100,
        gross_margin_pct=F.col("nr") * 50,
        net_margin_pct=F.col("ra") * 10,
        debt_to_ebitda=F.col("size") / 10,
        valuation_multiple=F.col("an") * 10,
        peer_multiple=F.col("nr") * 10,
        free_cash_flow_positive=F.col("a") > F.col("r"),
    )
    return judged.select(
        "l_suppkey", F.col("quality_score").cast("bigint").alias("quality_score"), "decision", "reason"
    )


@query
def rule_ratios(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.apply_rule(
        _supplier_figures(spark, folder),
        "ratios",
        current_ratio=F.col("an") + 0.3,
        quick_ratio=F.col("nr") + 0.05,
        debt_to_equity=F.col("ra") * 1.4,
        interest_coverage=F.col("size") / 8,
        operating_margin_pct=F.col("an") * 8,
    )
    return judged.select("l_suppkey", "decision", "reason")


@query
def rule_accretion(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.apply_rule(
        _supplier_figures(spark, folder),
        "deal",
        purchase_price=F.col("a"),
        expected_synergies=F.col("n") * 0.01,
        target_ebitda=F.col("r") * 0.2,
        financing_cost_pct=F.col("size") / 5,
        equity_dilution_pct=F.col("nr") * 8,
        post_close_leverage=F.col("ra") * 4,
    )
    return judged.select("l_suppkey", "decision", "reason")


@query
def rule_loan(spark: SparkSession, folder: str) -> DataFrame:
    def in_state(state: str) -> Column:
        return F.count_if(F.col("o_orderstatus") == state)

    taken = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"),
        in_state("F").alias("done"),
        in_state("P").alias("late"),
        cents_sum("o_totalprice").alias("spent"),
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    joined = customers.join(taken, F.col("c_custkey") == F.col("o_custkey"))
    judged = rules.apply_rule(
        joined,
        "loan",
        dscr=F.col("c_acctbal") / 3000,
        collateral_coverage=F.col("spent") / 1_000_000,
        fico_score=F.lit(560) + F.col("done") * 30,
        recent_delinquencies=F.greatest(F.col("late") - 4, F.lit(0)),
        leverage_ratio=F.col("orders") / 4,
    )
    return judged.select("c_custkey", "decision", "reason")


@query
def rule_batch_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that are rows: the lines of an order, summed map-side."""
    batches = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        cents_sum("l_extendedprice").alias("proposed_total")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    joined = batches.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    judged = rules.apply_rule(
        joined,
        "batch_total",
        budget="o_totalprice",
        committed_spend=text.round_exact(F.col("o_totalprice") / 3, 2),
    )
    return judged.select("o_orderkey", "proposed_total", "remaining_budget", "decision", "reason")


@query
def rule_batch_array(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that are arrays: instalments of an order, folded inside the row."""
    instalments = F.expr(
        "transform(sequence(1, 2 + cast(o_orderkey % 4 AS INT)),"
        " n -> named_struct('vendor', 'V', 'amount', o_totalprice * n / 10))"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", instalments.alias("transactions"))
    judged = rules.apply_rule(
        orders, "batch", budget=F.col("o_totalprice") * 1.1, committed_spend=F.col("o_totalprice") * 0.1
    )
    return judged.select("o_orderkey", "proposed_total", "remaining_budget", "decision", "reason")


@query
def rule_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    known = rules.with_baseline(orders, "o_custkey", "o_totalprice", ["o_orderkey"])
    judged = rules.apply_rule(
        known,
        "anomaly",
        observed="o_totalprice",
        recurring=F.col("o_orderpriority") == "1-URGENT",
    )
    return judged.select("o_orderkey", "z_score", "decision", "reason")


@query
def rules_unknown_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Five rules over events whose facts are missing here and there; a missing deviation counts as the least one, 1."""
    key, value, kind = F.col("event_id"), F.col("value"), F.col("event_type")

    def known(every: int, fact: Column) -> Column:
        """Null for one event in ``every``."""
        return F.when(key % every > 0, fact)

    facts = {
        "budget": {"amount": known(5, value), "remaining": known(7, F.lit(90.5))},
        "policy": {
            "amount": known(5, value), "policy_limit": known(7, F.lit(90.5)), "vendor_approved": known(3, kind != "error"),
            "receipt_attached": known(4, F.lit(True)), "manager_approved": F.lit(None).cast("boolean"),
        },
        "fraud": {
            "amount": known(5, value * 100), "velocity_24h": known(2, F.lit(7)), "geo_mismatch": known(3, kind == "error"),
            "new_device": known(4, kind != "view"), "after_hours": known(7, F.lit(True)), "card_present": known(11, kind != "click"),
        },
        "spend_alert": {
            "budget": known(5, F.when(key % 2 == 0, 64.0).otherwise(0.0)), "actual_spend": known(3, value),
            "forecast_spend": known(7, F.lit(65.0)),
        },
        "anomaly": {
            "baseline_mean": known(3, F.lit(8.0)), "baseline_std": known(5, F.lit(32.0)), "observed": known(7, value),
            "recurring": known(2, kind == "view"),
        },
    }
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    judged = [
        F.struct(F.lit(name).alias("rule"), found.decision.alias("decision"), found.reason.alias("reason"))
        for name, found in ((name, rules.verdict(name, **inputs)) for name, inputs in facts.items())
    ]
    return events.select("event_id", F.inline(F.array(*judged)))


@query
def scenario_generate(spark: SparkSession, folder: str) -> DataFrame:
    """One scenario per order, drawn from the order's key, which also picks the category."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    kinds = list(scenarios.SCENARIOS)
    parts = [
        scenarios.scenarios(orders.filter(F.col("id") % len(kinds) == at), category, seed=42)
        for at, category in enumerate(kinds)
    ]
    return reduce(DataFrame.unionByName, parts)


# --- responses --------------------------------------------------------------------


def _responses(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents dressed up as responses of several kinds."""
    docs = table(spark, folder, "documents")
    kind, body = F.col("doc_id") % 6, F.col("text")
    response = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit("Decision: approve - "), F.col("lang"), F.lit("\nReason: "), body))
        .when(kind == 2, F.concat(F.lit("Decision:\nReason: maybe "), body))
        .when(kind == 3, F.concat(F.lit("Decision: non deductible\nConfidence: 0.87\n"), body))
        .when(kind == 4, F.concat(F.lit("Reason:  "), F.col("source"), F.lit("\nDecision: Manual  Review!\nConfidence: 12\n"), body))
        .otherwise(F.concat(F.lit("Decision: "), body))
    )
    return docs.select("doc_id", "lang", "n_chars", response.alias("response"))


@query
def label_bucket(spark: SparkSession, folder: str) -> DataFrame:
    """Labels out of the first words of whole texts."""
    docs = table(spark, folder, "documents")
    choice = F.element_at(
        F.array(*[F.lit(name) for name in (*labels.APPROVE_LABELS, *labels.REJECT_LABELS, "hold", "!")]),
        (F.col("doc_id") % 23).cast("int") + 1,
    )
    whole = F.concat(choice, F.lit(" / "), F.col("text"))
    written = F.when(F.col("doc_id") % 2 == 0, F.lower(whole)).otherwise(whole)
    label = labels.canonical_label(written)
    return docs.select(
        "doc_id", F.md5(label).alias("label_md5"), labels.bucket_of_canonical(label).alias("bucket")
    )


@query
def confidence(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.upper("source").alias("label"), "text")
    marked = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("text"), F.lit(" It appears so."))).otherwise(
        F.col("text")
    )
    label = (
        F.when(F.col("doc_id") % 4 == 0, "UNKNOWN").when(F.col("doc_id") % 4 == 1, "APPROVE").otherwise(F.col("label"))
    )
    return docs.select("doc_id", labels.confidence(label, marked).alias("confidence"))


@query
def parse_response(spark: SparkSession, folder: str) -> DataFrame:
    done = responses.parsed(_responses(spark, folder), "response")
    return done.select(
        "doc_id",
        F.md5("raw_decision").alias("raw_decision_md5"),
        "decision",
        F.md5("reason").alias("reason_md5"),
        "confidence",
        responses.clamped(F.col("confidence")).alias("clamped"),
    )


@F.pandas_udf(T.StringType())
def stand_in_model(prompts: pd.Series) -> pd.Series:
    """A deterministic stand-in for a text generator."""
    names = ("Approve", "Reject", "Hold")
    return prompts.map(
        lambda prompt: f"Decision: {names[len(prompt) % 3]}\nReason: The request has {len(prompt)} characters."
    )


@query
def decision_scoring(spark: SparkSession, folder: str) -> DataFrame:
    requests = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(F.lit("Check order "), F.col("o_orderpriority")).alias("instruction"),
        F.struct(F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status")).alias("context"),
    )
    return responses.decide(requests, stand_in_model).select(
        "o_orderkey", "decision", "explanation", "confidence"
    )


#: Model calls cost far more than the rows they are made of, so requests are dealt anew, whatever splits the table was cut into.
MODEL_TASKS_PER_CORE = 4


def _strict_model(prompts: pd.Series) -> pd.Series:
    """A model that can't answer about pending orders."""
    if any('"status": "P"' in prompt for prompt in prompts):
        raise ValueError("pending")
    said = [f"Decision: Approve\nReason: {len(prompt)} characters." for prompt in prompts]
    return pd.Series(said, index=prompts.index, dtype=object)


@query
def decision_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Typed requests with nulls at every level, some unreadable, and a model that raises on some of the rest."""
    key = F.col("o_orderkey")
    lines = F.array(
        F.struct(F.col("o_totalprice").alias("amount"), F.lit(None).cast("string").alias("note")),
        F.lit(None).cast("struct<amount: double, note: string>"),
    )
    context = F.struct(
        F.when(key % 2 == 0, lines).otherwise(F.slice(lines, 1, 0)).alias("lines"),
        F.col("o_orderstatus").alias("status"),
        F.struct(F.when(key % 3 > 0, F.col("o_custkey")).alias("id")).alias("customer"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    requests = orders.repartition(MODEL_TASKS_PER_CORE * spark.sparkContext.defaultParallelism).select(
        "o_orderkey",
        F.when(key % 7 > 0, F.concat(F.lit("Check order "), F.col("o_orderpriority"))).alias("instruction"),
        F.when(key % 5 > 0, context).alias("context"),
    )
    return responses.decide(requests, responses.guarded(_strict_model)).select(
        "o_orderkey", "decision", "explanation", "confidence", "error"
    )


# --- evaluation -------------------------------------------------------------------


def _gold_and_said(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Labelled documents as gold records; a rule of thumb as predictions."""
    marks = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    truth = (
        F.when(F.col("toxic") == 1, "MANUAL_REVIEW").when(F.col("quality") == 1, "APPROVE").otherwise("REJECT")
    )
    gold = marks.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("category"),
        F.concat(F.lit("Decision: "), truth, F.lit("\nReason: Size "), F.col("n_chars").cast("string")).alias("output"),
    )
    guess = (
        F.when(F.col("n_chars") % 5 == 0, "manual review").when(F.col("n_chars") % 3 != 0, "Approve").otherwise("reject")
    )
    said = docs.filter(F.col("doc_id") % 10 != 3).select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Decision:  "), guess, F.lit("\nReason: size "), F.col("n_chars").cast("string")).alias("response"),
    )
    return gold, said


def _results(spark: SparkSession, folder: str, with_text: bool = False) -> DataFrame:
    return metrics.scored(*_gold_and_said(spark, folder), with_text=with_text)


@query
def eval_results(spark: SparkSession, folder: str) -> DataFrame:
    return _results(spark, folder, with_text=True)


@query
def eval_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.accuracy(_results(spark, folder))


@query
def eval_category_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.accuracy(_results(spark, folder), ["fr"])


@query
def eval_exact(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.reasoning_report(_results(spark, folder))


@query
def eval_budget(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.budget_report(_results(spark, folder), ["en", "de"])


@query
def eval_recall(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.label_recall(_results(spark, folder), "REJECT")


@query
def eval_prf(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.precision_recall_f1(_results(spark, folder), categories=["en"])


@query
def eval_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.by_category(_results(spark, folder))


@query
def scenario_pass(spark: SparkSession, folder: str) -> DataFrame:
    gold, said = _gold_and_said(spark, folder)
    cases = gold.select(F.col("id").alias("name"), responses.raw_decision(F.col("output")).alias("expected"))
    return metrics.pass_rate(cases, said.select(F.col("id").alias("name"), "response"))


# --- the whole build --------------------------------------------------------------


def _corpus(spark: SparkSession, folder: str):
    frames = [document_records(spark, folder), conversation_records(spark, folder)]
    return build_corpus(
        frames, order=["ord", "part"], context_text=lambda context: context, token_count=text.word_count
    )


@query
def corpus_build(spark: SparkSession, folder: str) -> DataFrame:
    """Merge, canonicalise, de-duplicate, split and render, end to end."""
    return _corpus(spark, folder).records.select(
        "id", "category", "source", "split", F.md5("text").alias("text_md5"), F.col("token_count").cast("bigint").alias("token_count")
    )


@query
def preprocess_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and token statistics per split of the built corpus."""
    built = _corpus(spark, folder).records.select("split", "token_count")
    return render.length_stats(built, F.col("token_count"), ["split"], F.count("*").alias("rows"))


@query
def build_report(spark: SparkSession, folder: str) -> DataFrame:
    """The built corpus written to the shared folder, and its report as read back from there."""
    path = _scratch(spark)
    schema = write_build(_corpus(spark, folder), path, ["documents", "conversations"], "words").schema
    report = spark.read.schema(schema).json(f"{path}/report", multiLine=True)
    listed = {
        name: F.array_join(F.transform(F.array_sort(F.map_entries(f"dataset_summary.{name}")), lambda e: F.concat_ws("=", e.key, e.value)), ",")
        for name in ("categories", "sources")
    }
    return report.select(
        "before_deduplication", "after_deduplication", "target_met", F.col("dataset_summary.samples").alias("samples"),
        *[text.alias(name) for name, text in listed.items()], F.array_join("sources", ",").alias("inputs"),
        *[F.col(f"split_sizes.{name}").alias(f"{name}_rows") for name in ("train", "validation", "test")],
        *[F.col(f"ratios.{name}").alias(f"{name}_ratio") for name in ("train", "validation", "test")],
        "tokenizer_id", *[F.col(f"token_stats.{name}").alias(f"token_{name}") for name in ("min", "max", "avg")],
    )
