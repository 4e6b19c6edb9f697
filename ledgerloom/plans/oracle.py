"""The same queries as DuckDB SQL over the same tables, for comparison only.

Written from the meaning of each operator, not from its Spark expression: where
Spark folds, buckets or cuts, these use whole windows and list functions.
"""

from __future__ import annotations

from ledgerloom.functions.json_text import SHORT_ESCAPES
from ledgerloom.functions.labels import (
    APPROVE_LABELS,
    CONFIDENCE_PATTERN,
    DECISION_PATTERN,
    HEDGES,
    REASON_PATTERN,
    REJECT_LABELS,
)
from ledgerloom.functions.text import BLANKS, LINE_ENDS, NUMBER_PATTERN, NUMERIC_NAME_PARTS
from ledgerloom.operators import wording
from ledgerloom.operators.render import SYSTEM_TEXT


def lit(value: str) -> str:
    """A string literal; control characters are spelled with chr()."""
    quoted = "'" + value.replace("'", "''") + "'"
    for char in "\n\r\t\b\f":
        quoted = quoted.replace(char, f"' || chr({ord(char)}) || '")
    return f"({quoted})"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{BLANKS}]+', ' ', 'g'))"


def squeeze_lines(x: str) -> str:
    parts = f"string_split_regex({x}, '\\r\\n|[{LINE_ENDS}]')"
    return (
        f"coalesce(array_to_string(list_filter(list_transform({parts}, lambda l: {squeeze('l')}), lambda l: l <> ''),"
        " chr(10)), '')"
    )


def rounded(x: str, places: int = 2) -> str:
    return f"cast(format('{{:.{places}f}}', {x}) AS DOUBLE)"


def money(x: str) -> str:
    return f"('$' || format('{{:,.2f}}', {x}))"


def number(x: str) -> str:
    """Parsed financial number of a squeezed string."""
    plain = f"try_cast(regexp_replace({x}, '[()$,%]', '', 'g') AS DOUBLE)"
    sign = f"CASE WHEN {x} LIKE '(%' AND {x} LIKE '%)' THEN -1 ELSE 1 END"
    return f"CASE WHEN regexp_matches({x}, '{NUMBER_PATTERN}') THEN {rounded(f'{plain} * {sign}', 6)} END"


def quote(x: str) -> str:
    """JSON string literal in ASCII."""
    plain = x
    for char, escape in SHORT_ESCAPES.items():
        plain = f"replace({plain}, {lit(char)}, {lit(escape)})"
    unit = "format('\\u{:04x}', "
    escaped = (
        f"CASE WHEN ord(c) < 65536 THEN {unit}ord(c)) ELSE"
        f" {unit}55296 + ((ord(c) - 65536) >> 10)) || {unit}56320 + ((ord(c) - 65536) & 1023)) END"
    )
    odd = f"list_distinct(regexp_extract_all({plain}, '[^ -~]'))"
    return f"('\"' || list_reduce({odd}, lambda t, c: replace(t, c, {escaped}), {plain}) || '\"')"


def decision_text(decision: str, reason: str) -> str:
    return f"('Decision: ' || {decision} || chr(10) || 'Reason: ' || {reason})"


def fill(name: str, **values: str) -> str:
    text = wording.REASONS[name]
    made, rest = [], text
    while "{" in rest:
        before, _, tail = rest.partition("{")
        hole, _, rest = tail.partition("}")
        made += [lit(before), f"cast({values[hole]} AS VARCHAR)"]
    made.append(lit(rest))
    return "(" + " || ".join(made) + ")"


def case(*branches: tuple[str, str], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in branches) + f" ELSE {otherwise} END"


def label(x: str) -> str:
    upper = f"upper(replace({squeeze(x)}, 'ß', 'ss'))"
    return f"coalesce(nullif(trim(regexp_replace({upper}, '[^A-Z0-9]+', '_', 'g'), '_'), ''), 'UNKNOWN')"


def bucket(x: str) -> str:
    def listed(names) -> str:
        return ", ".join(f"'{name}'" for name in names)

    return case(
        (f"{x} IN ({listed(APPROVE_LABELS)}) OR {x} LIKE 'APPROVE%'", "'approve'"),
        (f"{x} IN ({listed(REJECT_LABELS)}) OR {x} LIKE 'REJECT%'", "'reject'"),
        otherwise="'review'",
    )


def score(lab: str, explanation: str) -> str:
    words = f"CASE WHEN {squeeze(explanation)} = '' THEN 0 ELSE len(string_split({squeeze(explanation)}, ' ')) END"
    return rounded(
        "0.56::DOUBLE"
        f" + CASE WHEN {lab} NOT IN ('', 'UNKNOWN') THEN 0.14::DOUBLE ELSE 0 END"
        f" + CASE WHEN {words} >= 10 THEN 0.10::DOUBLE ELSE 0 END"
        f" + CASE WHEN {words} >= 20 THEN 0.06::DOUBLE ELSE 0 END"
        f" - CASE WHEN regexp_matches(lower({explanation}), '{'|'.join(HEDGES)}') THEN 0.12::DOUBLE ELSE 0 END"
        f" + CASE WHEN {bucket(lab)} <> 'review' THEN 0.05::DOUBLE ELSE 0 END",
        4,
    )


def raw_label(x: str) -> str:
    return label(f"regexp_extract({x}, '{DECISION_PATTERN}', 1)")


def explained(x: str) -> str:
    found = f"nullif(regexp_extract({x}, '{REASON_PATTERN}', 1), '')"
    return squeeze(f"coalesce({found}, {x})")


def shares(total: str, relation: str) -> str:
    """Largest-remainder allocation of ``total`` over 0.8 / 0.1 / 0.1."""
    return f"""
base AS (SELECT *, [{total} * 0.8::DOUBLE, {total} * 0.1::DOUBLE, {total} * 0.1::DOUBLE] AS exact FROM {relation}),
floors AS (SELECT *, list_transform(exact, lambda x: cast(floor(x) AS BIGINT)) AS whole FROM base),
parts AS (SELECT *, {total} - list_sum(whole) AS spare,
  [{{'f': exact[1] - whole[1], 'i': -1}}, {{'f': exact[2] - whole[2], 'i': -2}}, {{'f': exact[3] - whole[3], 'i': -3}}] AS fs
  FROM floors),
ranked AS (SELECT *, list_transform(list_slice(list_reverse_sort(fs), 1, cast(spare AS BIGINT)), lambda x: -x.i) AS lucky FROM parts),
given AS (SELECT *, list_transform(whole, lambda x, i: x + CASE WHEN list_contains(lucky, i) THEN 1 ELSE 0 END) AS held FROM ranked),
fed2 AS (SELECT *, CASE WHEN {total} >= 3 AND held[2] = 0 AND list_max(held) > 1
  THEN [held[1] - 1, 1, held[3]] ELSE held END AS held2 FROM given),
fed3 AS (SELECT *, CASE WHEN {total} >= 3 AND held2[3] = 0 AND list_max(held2) > 1
  THEN [held2[1] - 1, held2[2], 1] ELSE held2 END AS held3 FROM fed2)"""


def split_sql(rows: str, stratum: str, row_id: str, keep: str, seed: int = 42, ties: str = "") -> str:
    """``{keep}, split`` of a relation, by a whole-stratum window."""
    return f"""
totals AS (SELECT {stratum} AS stratum, count(*) AS total FROM {rows} GROUP BY 1),
{shares('total', 'totals')},
placed AS (SELECT *, row_number() OVER (PARTITION BY {stratum}
  ORDER BY md5('{seed}|' || cast({row_id} AS VARCHAR)), {row_id}{ties}) AS place FROM {rows}),
labelled AS (SELECT {keep}, CASE WHEN place <= held3[1] THEN 'train'
  WHEN place <= held3[1] + held3[2] THEN 'validation' ELSE 'test' END AS split
  FROM placed JOIN fed3 ON placed.{stratum} = fed3.stratum)"""


ORACLE: dict[str, str] = {}

ORACLE["text_normalize"] = f"""
SELECT doc_id, md5({squeeze('text')}) AS clean_md5, length({squeeze('text')}) AS clean_length,
  md5(lower({squeeze('text')})) AS comparable_md5 FROM documents"""

ORACLE["output_lines"] = f"""
SELECT doc_id, md5(l) AS lines_md5, length(l) AS lines_length
FROM (SELECT doc_id, {squeeze_lines('text')} AS l FROM documents)"""

ORACLE["money_text"] = f"SELECT o_orderkey, {money('o_totalprice')} AS money FROM orders"

_written = case(
    ("c_custkey % 5 = 0", f"'(' || {money('abs(c_acctbal)')} || ')'"),
    ("c_custkey % 5 = 1", money("c_acctbal")),
    ("c_custkey % 5 = 2", "format('{:,.2f}', c_acctbal) || '%'"),
    ("c_custkey % 5 = 3", "'PO-' || c_custkey"),
    otherwise="' ' || chr(9) || format('{:,.2f}', c_acctbal) || chr(10)",
)
ORACLE["parse_number"] = f"""
SELECT c_custkey, {number('w')} AS number
FROM (SELECT c_custkey, {squeeze(_written)} AS w FROM customer)"""

ORACLE["numeric_gate"] = f"""
SELECT doc_id, len(w) AS words,
  len(list_filter(w, lambda x: regexp_matches(lower(x), '{"|".join(NUMERIC_NAME_PARTS)}'))) AS numeric_names
FROM (SELECT doc_id, string_split({squeeze('text')}, ' ') AS w FROM documents)"""

ORACLE["json_context"] = f"""
SELECT event_id, '{{"amount": ' || {rounded('value')} || ', "props": {{"k": ' || (props->>'k')
  || '}}, "seen": [1, 2.5, ' || cast(format('{{:.1f}}', value) AS DOUBLE) || '], "type": "' || event_type
  || '", "year": "' || year(ts) || '"}}' AS context, 0::BIGINT AS problems FROM events"""

_free_form = """
free AS (SELECT event_id, event_type, event_id % 11 AS form, event_id % 3 AS shape, CASE WHEN event_id % 11 NOT IN (5, 7, 9) THEN
  '{"kind": "' || event_type || '", "props": {"k": ' || (props->>'k') || '}, "sizes": ' || CASE event_id % 3
    WHEN 0 THEN '[null, ' || user_id || ', null]' WHEN 1 THEN '[[], {"deep": [true, null]}]' ELSE '{}' END || '}' END AS context
  FROM events)"""
_left = "null found in context.sizes"
ORACLE["context_problems"] = f"""
WITH {_free_form} SELECT event_id, context, CASE form WHEN 5 THEN 'context is not an object' WHEN 7 THEN 'context is not JSON'
  WHEN 9 THEN 'context is missing' ELSE CASE shape WHEN 0 THEN '{_left}[0]; {_left}[2]' WHEN 1 THEN '{_left}[1].deep[1]'
  ELSE '' END END AS problems FROM free"""

_doc_context = """('{"lang": "' || lang || '", "size": ' || length(text) || '}')"""
_doc_instruction = "'Summarise the text.'"
_doc_key = (
    f"""'{{"category": "' || lang || '", "context": ' || {_doc_context} || ', "instruction": "' || {_doc_instruction}"""
    f""" || '", "output": ' || {quote('clean')} || '}}'"""
)
_doc_wrapped = (
    f"CASE WHEN clean LIKE 'Decision:%' THEN clean ELSE {decision_text(lit('ANSWER'), squeeze('clean'))} END"
)
_doc_records = f"""
doc_records AS (SELECT lang || '-' || substr(md5({_doc_key}), 1, 16) AS id, {_doc_instruction} AS instruction,
  {_doc_context} AS context, {_doc_wrapped} AS output, lang AS category, source, doc_id AS ord
  FROM (SELECT *, {squeeze_lines('text')} AS clean FROM documents))"""
ORACLE["canonical_records"] = f"""
WITH {_doc_records}
SELECT ord, id, instruction, context, md5(output) AS output_md5, category, source,
  CASE WHEN contains(output, 'Reason:') THEN 0::BIGINT ELSE 1::BIGINT END AS violations FROM doc_records"""

ORACLE["record_violations"] = """
SELECT cast(doc_id AS VARCHAR) AS id, CASE doc_id % 4 WHEN 1 THEN 'instruction is empty'
  WHEN 2 THEN 'null found in context.sizes[1]' ELSE 'output has no reason line' END AS violations
FROM documents WHERE doc_id % 4 <> 0"""

ORACLE["content_id"] = f"""
SELECT conv_id, turn, role || '-' || substr(md5('{{"category": "' || role || '", "context": {{"turn": ' || turn
  || '}}, "instruction": "Continue.", "output": ' || {quote('text')} || '}}'), 1, 16) AS content_id
FROM conversations"""

ORACLE["exact_dedup"] = """
SELECT doc_id, lang, source FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)"""

_texts = """texts AS (SELECT text, lang AS category, source FROM documents
  UNION ALL SELECT text, role, NULL FROM conversations)"""
ORACLE["merge_summary"] = f"""
WITH {_texts} SELECT count(*) AS before_deduplication, count(DISTINCT text) AS after_deduplication,
  count(DISTINCT text) >= 100000 AS target_met FROM texts"""
ORACLE["category_source_counts"] = f"""
WITH {_texts}
SELECT 'category' AS kind, category AS name, count(*) AS rows FROM texts GROUP BY 2
UNION ALL SELECT 'source', coalesce(source, 'unknown'), count(*) FROM texts GROUP BY 2
UNION ALL SELECT 'total', 'samples', count(*) FROM texts"""


def prompt(instruction: str, context: str) -> str:
    opening = (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n" + SYSTEM_TEXT
        + "\n<|eot_id|><|start_header_id|>user<|end_header_id|>\nInstruction: "
    )
    closing = "\n<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n"
    return f"({lit(opening)} || {instruction} || {lit(chr(10) + 'Context:' + chr(10))} || {context} || {lit(closing)})"


_free_lines = """'{' || chr(10) || '  "kind": "' || event_type || '",' || chr(10) || '  "props": {' || chr(10) || '    "k": '
  || (context::JSON->'props'->>'k') || chr(10) || '  },' || chr(10) || '  "sizes": {}' || chr(10) || '}'"""
ORACLE["prompt_free_form"] = f"""
WITH {_free_form}, p AS (SELECT *, {prompt(lit("Judge the event."), _free_lines)} AS prompt FROM free
  WHERE context IS NOT NULL AND shape = 2)
SELECT 'event-' || event_id AS id, md5(prompt) AS prompt_md5, md5(prompt || 'Decision: APPROVE' || chr(10) || 'Reason: '
  || event_type || chr(10) || '<|eot_id|>') AS text_md5 FROM p"""

_tall = (
    "('{' || chr(10) || '  \"lang\": \"' || lang || '\",' || chr(10) || '  \"n_chars\": ' || n_chars || ',' || chr(10)"
    " || '  \"source\": \"' || source || '\"' || chr(10) || '}')"
)
ORACLE["prompt_text"] = f"""
SELECT doc_id, md5(p) AS prompt_md5, md5(p || text || {lit(chr(10) + '<|eot_id|>')}) AS text_md5
FROM (SELECT doc_id, text, {prompt(lit('Summarise the text.'), _tall)} AS p FROM documents)"""

ORACLE["length_stats"] = f"""
SELECT lang, min(length(text)) AS min, max(length(text)) AS max, {rounded('avg(length(text))')} AS avg
FROM documents GROUP BY lang"""

ORACLE["truncate_tokens"] = f"""
SELECT doc_id, least(len(w), 256) AS tokens, md5(array_to_string(w[1:256], ' ')) AS labels_md5
FROM (SELECT doc_id, string_split({squeeze('text')}, ' ') AS w FROM documents)"""

ORACLE["allocate_counts"] = f"""
WITH t AS (SELECT lang, source, count(*) AS total FROM documents GROUP BY ALL), {shares('total', 't')}
SELECT lang, source, total, held3[1] AS train, held3[2] AS validation, held3[3] AS test FROM fed3"""

ORACLE["stratified_split"] = f"""
WITH {split_sql('documents', 'lang', 'doc_id', 'doc_id, lang')} SELECT * FROM labelled"""

ORACLE["step_plan"] = f"""
WITH {split_sql('orders', 'o_orderpriority', 'o_orderkey', 'o_orderkey')}
SELECT split, count(*) AS rows, count(*) // 16 AS steps_per_epoch, count(*) // 16 * 3 AS total_steps
FROM labelled GROUP BY split"""

ORACLE["shuffle_order"] = "SELECT doc_id, md5('7|' || doc_id) AS order_key FROM documents"

ORACLE["limit_after_filter"] = """
SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ('fr', 'de') ORDER BY doc_id LIMIT 250"""

ORACLE["turn_rows"] = f"""
WITH pairs AS (SELECT conv_id, turn, role, text AS q, lead(text) OVER w AS a, lead(role) OVER w AS r,
  lead(turn) OVER w AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT format('conversations-{{}}-{{:03d}}', conv_id, turn) AS id, md5({squeeze('q')}) AS instruction_md5,
  md5({decision_text(lit('ANSWER'), squeeze('a'))}) AS output_md5
FROM pairs WHERE role = 'user' AND r = 'assistant' AND n = turn + 1 AND q <> ''"""

ORACLE["turn_history"] = f"""
WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
turns AS (SELECT doc_id, n, l[2 * n + 1] AS q, l[2 * n + 2] AS a
  FROM lines, unnest(range((len(l) + 1) // 2)) AS u(n)),
usable AS (SELECT doc_id, n, '{{"question": ' || {quote('q')} || ', "answer": ' || {quote('a')} || '}}' AS pair
  FROM turns WHERE q <> '' AND a IS NOT NULL),
told AS (SELECT doc_id, n, list(pair) OVER (PARTITION BY doc_id ORDER BY n
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pairs FROM usable)
SELECT format('doc-{{:06d}}-{{:03d}}', doc_id, n) AS id, len(pairs) - 1 AS earlier,
  md5('[' || coalesce(array_to_string(pairs[1:len(pairs) - 1], ', '), '') || ']') AS history_md5 FROM told"""

_strip = f"regexp_replace(x, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')"
ORACLE["assemble_text"] = f"""
SELECT conv_id, turn, md5(array_to_string(list_filter(list_transform(
  list_concat(string_split(text, chr(10)), [CASE WHEN role <> 'system' THEN role ELSE '' END, 'True', '12.0',
    '{{"a": "x, \\"' || role || ':y", "b": ' || turn || '}}', CASE WHEN turn = 0 THEN '' ELSE cast(turn AS VARCHAR) END]),
  lambda x: {_strip}), lambda x: x <> ''), chr(10))) AS joined_md5 FROM conversations"""

ORACLE["truthy_coalesce"] = f"""
SELECT event_id, {case(
    ("event_type = 'view' AND value <> 0", "cast(value AS VARCHAR)"),
    ("event_type = 'click'", "'clicked Reasoning trace: because'"),
    ("event_type = 'purchase'", "'0'"),
    ("event_type = 'signup'", "''"),
    ("event_type = 'error'", "'0 Reasoning trace: ' || replace(props, ' ', '')"),
    otherwise="NULL")} AS answer FROM events"""

def imported(name: str, category: str, rows: str, members: str) -> str:
    """Raw records from ``rows`` (doc_id, turn, id, q, a, trace, company, told, steps)."""
    reason = squeeze("a || CASE WHEN trace <> '' THEN ' Reasoning trace: ' || trace ELSE '' END")
    return f"""
SELECT id, turn AS turn_ord, md5(q) AS instruction_md5, md5('{{"dataset": "{name}", ' || {members} || '}}') AS context_md5,
  md5('Decision: ANSWER' || chr(10) || 'Reason: ' || {reason}) AS output_md5, '{category}' AS category, '{name}' AS source
FROM ({rows}) WHERE q <> '' AND a IS NOT NULL"""


def member(name: str, value: str) -> str:
    return f"""'"{name}": ' || coalesce({value}, 'null')"""


def members(**values: str) -> str:
    return " || ', ' || ".join(member(name, value) for name, value in values.items())


ORACLE["import_report"] = imported("FinQA", "finqa_reasoning", """
  SELECT format('finqa-003-{:06d}', doc_id) AS id, 0 AS turn, text AS q, lang AS trace, source, lang,
    CASE WHEN lang = 'de' THEN '0' WHEN lang <> 'fr' THEN cast(length(text) AS VARCHAR) END AS a FROM documents""",
    members(company=f"CASE WHEN lang <> 'es' THEN {quote('source')} END", table="NULL",
            report_text=quote("(lang || chr(10) || source)"), reasoning_steps=quote("lang")))
ORACLE["import_turns"] = f"""
WITH lines AS (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents),
turns AS (SELECT doc_id, source, n AS turn, l[2 * n + 1] AS q, l[2 * n + 2] AS a, '' AS trace
  FROM lines, unnest(range((len(l) + 1) // 2)) AS u(n)),
usable AS (SELECT *, '{{"question": ' || {quote('q')} || ', "answer": ' || {quote('a')} || '}}' AS pair
  FROM turns WHERE q <> '' AND a IS NOT NULL),
told AS (SELECT *, list(pair) OVER (PARTITION BY doc_id ORDER BY turn
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pairs FROM usable)
""" + imported("ConvFinQA", "convfinqa_reasoning", """
  SELECT *, format('convfinqa-003-{:06d}-{:03d}', doc_id, turn) AS id FROM told""",
    members(company=quote("source"), table="NULL", report_text="""'""'""",
            conversation_history="'[' || coalesce(array_to_string(pairs[1:len(pairs) - 1], ', '), '') || ']'",
            reasoning_steps="NULL"))
ORACLE["import_generic"] = imported("FinanceBench", "financebench_reasoning", """
  SELECT format('financebench-003-{:06d}', doc_id) AS id, 0 AS turn, text AS q, nullif(lang, 'fr') AS a, source AS trace,
    lang, source, doc_id FROM documents""",
    members(company=quote("lang"), period="cast(doc_id AS VARCHAR)", report_text=quote("(lang || chr(10) || source)"),
            reasoning_steps=quote("source"))) + " UNION ALL " + imported("FinR1", "finr1_reasoning", """
  SELECT format('finr1-003-{:06d}', doc_id) AS id, 0 AS turn, text AS q, cast(length(text) AS VARCHAR) AS a, '' AS trace,
    source, doc_id FROM documents""",
    members(company="NULL", period="cast(doc_id AS VARCHAR)", report_text=quote("source"), reasoning_steps="NULL"))
ORACLE["unwrap_json"] = """
WITH found AS (SELECT doc_id, unnest(CASE WHEN lang IN ('en', 'fr') THEN [text, source] ELSE [text] END) AS t,
  unnest(CASE WHEN lang IN ('en', 'fr') THEN [0, 1] ELSE [0] END) AS place FROM documents)
SELECT doc_id, place, md5(t) AS record_md5 FROM found"""

ORACLE["cap_per_source"] = """
WITH n AS (SELECT source, doc_id, len(string_split(text, chr(10))) AS outputs FROM documents),
r AS (SELECT *, coalesce(sum(outputs) OVER (PARTITION BY source ORDER BY doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT format('{}-000-{:06d}', lower(source), doc_id) AS id, outputs FROM r WHERE before < 40"""

ORACLE["files_round_trip"] = """
SELECT doc_id, md5(text) AS text_md5, coalesce(lang, '') AS lang, coalesce(source, '') AS source, true AS gapless FROM documents"""
_all_sources = ", ".join(f"({at}, '{name}', '{name.lower()}_reasoning')" for at, name in enumerate(("FinQA", "ConvFinQA", "FinanceBench", "FinR1")))
ORACLE["import_all_sources"] = f"""
WITH kinds(import_ord, source, category) AS (VALUES {_all_sources}),
told AS (
  SELECT 'FinQA' AS kind, text AS q, '' AS turn FROM documents WHERE lang <> 'fr'
  UNION ALL SELECT 'ConvFinQA', source, '-000' FROM documents WHERE lang IS NOT NULL AND lang <> ''
  UNION ALL SELECT 'ConvFinQA', text, '-001' FROM documents WHERE source IS NOT NULL AND source <> ''
  UNION ALL SELECT 'FinanceBench', text, '' FROM documents WHERE lang <> 'fr'
  UNION ALL SELECT 'FinR1', text, '' FROM documents WHERE CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END <> '')
SELECT import_ord, md5({squeeze('q')}) AS instruction_md5, category, source, lower(source) || '-place' || turn AS id_form
FROM told JOIN kinds ON kind = source WHERE q <> ''"""
ORACLE["named_splits"] = """
SELECT doc_id, md5(text) AS output_md5, source, ['train', 'validation', 'test'][doc_id % 3 + 1] AS split FROM documents"""

_budget = f"""
judged AS (SELECT *, a <= c_acctbal AS fits FROM (SELECT *, {rounded('o_totalprice / 50')} AS a
  FROM orders JOIN customer ON o_custkey = c_custkey))"""
ORACLE["rule_budget"] = f"""
WITH {_budget}
SELECT o_orderkey, CASE WHEN fits THEN 'APPROVE' ELSE 'REJECT' END AS decision,
  CASE WHEN fits THEN {fill('budget_approve', amount=money('a'), remaining=money('c_acctbal'),
                            difference=money('c_acctbal - a'))}
  ELSE {fill('budget_reject', amount=money('a'), remaining=money('c_acctbal'),
             difference=money('a - c_acctbal'))} END AS reason FROM judged"""
ORACLE["budget_decisions"] = f"""
WITH {_budget}
SELECT c_mktsegment, CASE WHEN fits THEN 'APPROVE' ELSE 'REJECT' END AS decision, count(*) AS orders,
  cast(sum(cast(o_totalprice AS DECIMAL(14, 2))) AS DOUBLE) AS total FROM judged GROUP BY ALL"""

_vendors = ", ".join(f"({at}, {lit(v)}, '{b}')" for at, (v, b) in enumerate(wording.VENDOR_BUCKETS))
ORACLE["rule_expense"] = f"""
WITH catalogue(pos, vendor, bucket) AS (VALUES {_vendors}, (10, 'Unlisted vendor', 'unknown'))
SELECT p_partkey, upper(bucket) AS decision,
  {fill('expense', amount=money('p_retailprice'), vendor='vendor', bucket='bucket', team='p_brand')} AS reason
FROM part JOIN catalogue ON pos = p_partkey % 11"""

_velocity = """
counted AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS velocity_24h FROM events)"""
ORACLE["velocity_24h"] = f"WITH {_velocity} SELECT event_id, velocity_24h FROM counted"
ORACLE["rule_fraud"] = f"""
WITH {_velocity}, scored AS (SELECT event_id, cast(velocity_24h >= 5 AS INT)
  + cast(event_type IN ('error', 'purchase') AS INT) + cast(event_type IN ('signup', 'purchase') AS INT)
  + cast(hour(ts) < 6 OR hour(ts) >= 22 AS INT) + cast(value * 100 >= 5000 AS INT)
  + cast(event_id % 3 <> 0 AS INT) AS s FROM counted)
SELECT event_id, s AS risk_score, CASE WHEN s >= 4 THEN 'MANUAL_REVIEW' ELSE 'ALLOW' END AS decision,
  CASE WHEN s >= 4 THEN {fill('fraud_review', score='s')} ELSE {fill('fraud_allow', score='s')} END AS reason
FROM scored"""

ORACLE["rule_policy"] = f"""
WITH l AS (SELECT *, {rounded('l_extendedprice / 40')} AS a, {rounded('abs(s_acctbal) / 4')} AS lim
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
p AS (SELECT *, list_filter([
  CASE WHEN s_acctbal <= 1000 THEN {lit(wording.REASONS['policy_vendor'])} END,
  CASE WHEN a > lim THEN {fill('policy_limit', excess=money('a - lim'))} END,
  CASE WHEN a > 1000 AND l_linestatus <> 'F' THEN {lit(wording.REASONS['policy_manager'])} END,
  CASE WHEN a > 75 AND l_returnflag = 'R' THEN {lit(wording.REASONS['policy_receipt'])} END
  ], lambda x: x IS NOT NULL) AS v FROM l)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, len(v) AS violations,
  CASE WHEN len(v) > 0 THEN 'REJECT' ELSE 'APPROVE' END AS decision,
  CASE WHEN len(v) > 0 THEN {fill('policy_reject', problems="array_to_string(v, '; ')")}
  ELSE {lit(wording.REASONS['policy_approve'])} END AS reason FROM p"""

ORACLE["rule_tax"] = f"""
WITH l AS (SELECT CASE WHEN p_type = 'PROMO' THEN 'family vacation flight' ELSE lower(p_type) END AS e,
  cast(round(l_discount * 1000) AS BIGINT) AS pct, l_returnflag <> 'R' AS receipt
  FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT *, pct >= 50 AND receipt AND e NOT LIKE '%family vacation%' AS ok FROM l)
SELECT CASE WHEN ok THEN 'DEDUCTIBLE' ELSE 'NON_DEDUCTIBLE' END AS decision,
  CASE WHEN ok THEN {fill('tax_deductible', expense_type='e', percent='pct')}
  ELSE {fill('tax_not_deductible', expense_type='e')} END AS reason, count(*) AS lines
FROM j GROUP BY ALL"""

ORACLE["rule_spend_alert"] = f"""
WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS period,
  cast(sum(cast(o_totalprice AS DECIMAL(14, 2))) AS DOUBLE) AS actual FROM orders GROUP BY ALL),
f AS (SELECT *, {rounded('abs(c_acctbal) * 50 + 1000')} AS budget, {rounded('actual * 1.04::DOUBLE')} AS forecast
  FROM m JOIN customer ON o_custkey = c_custkey),
v AS (SELECT *, {rounded('(forecast - budget) / budget * 100')} AS variance FROM f),
j AS (SELECT *, actual > budget OR forecast > budget * 1.05::DOUBLE OR variance > 10 AS over FROM v)
SELECT o_custkey, period, variance AS variance_pct, CASE WHEN over THEN 'ALERT' ELSE 'NO_ALERT' END AS decision,
  CASE WHEN over THEN {fill('spend_alert', forecast=money('forecast'), variance='variance', budget=money('budget'))}
  ELSE {fill('spend_quiet', forecast=money('forecast'), budget=money('budget'))} END AS reason FROM j"""

_figures = """
s AS (SELECT l_suppkey,
  cast(sum(cast(l_extendedprice AS DECIMAL(14, 2))) FILTER (l_returnflag = 'A') AS DOUBLE) AS a,
  cast(sum(cast(l_extendedprice AS DECIMAL(14, 2))) FILTER (l_returnflag = 'N') AS DOUBLE) AS n,
  cast(sum(cast(l_extendedprice AS DECIMAL(14, 2))) FILTER (l_returnflag = 'R') AS DOUBLE) AS r,
  cast(sum(cast(l_quantity AS DECIMAL(14, 2))) AS DOUBLE) / count(*) AS size
  FROM lineitem GROUP BY 1),
f AS (SELECT l_suppkey, coalesce(a / nullif(n, 0), 0) AS an, coalesce(n / nullif(r, 0), 0) AS nr,
  coalesce(r / nullif(a, 0), 0) AS ra, size, coalesce(a, 0) AS a, coalesce(n, 0) AS n, coalesce(r, 0) AS r FROM s)"""
_reason = {name: lit(text) for name, text in wording.REASONS.items()}
ORACLE["rule_investment"] = f"""
WITH {_figures}, q AS (SELECT l_suppkey, cast((an - 0.85::DOUBLE) * 100 >= 15 AS INT) + cast(nr * 50 >= 50 AS INT)
  + cast(ra * 10 >= 10 AS INT) + cast(size / 10 <= 2.5 AS INT) + cast(an * 10 <= nr * 10 AS INT)
  + cast(a > r AS INT) AS k FROM f)
SELECT l_suppkey, k::BIGINT AS quality_score,
  {case(("k >= 5", "'BUY'"), ("k >= 3", "'HOLD'"), otherwise="'AVOID'")} AS decision,
  {case(("k >= 5", _reason["invest_buy"]), ("k >= 3", _reason["invest_hold"]),
        otherwise=_reason["invest_avoid"])} AS reason FROM q"""
ORACLE["rule_ratios"] = f"""
WITH {_figures}, q AS (SELECT l_suppkey, an + 0.3::DOUBLE >= 1.2::DOUBLE AND nr + 0.05::DOUBLE >= 1.0
  AND ra * 1.4::DOUBLE <= 1.5 AND size / 8 >= 3.0 AND an * 8 >= 8 AS ok FROM f)
SELECT l_suppkey, CASE WHEN ok THEN 'HEALTHY' ELSE 'DISTRESSED' END AS decision,
  CASE WHEN ok THEN {_reason["ratios_healthy"]} ELSE {_reason["ratios_distressed"]} END AS reason FROM q"""
ORACLE["rule_accretion"] = f"""
WITH {_figures}, q AS (SELECT l_suppkey, n * 0.01::DOUBLE + r * 0.2::DOUBLE * 0.2::DOUBLE - a * (size / 5 / 100) AS proxy,
  nr * 8 AS dilution, ra * 4 AS leverage FROM f),
k AS (SELECT *, CASE WHEN proxy > 0 AND dilution <= 8 AND leverage <= 4 THEN 'ACCRETIVE'
  WHEN proxy < 0 OR leverage > 5 OR dilution > 12 THEN 'DILUTIVE' ELSE 'REVIEW' END AS decision FROM q)
SELECT l_suppkey, decision, CASE decision WHEN 'ACCRETIVE' THEN {_reason["deal_accretive"]}
  WHEN 'DILUTIVE' THEN {_reason["deal_dilutive"]} ELSE {_reason["deal_review"]} END AS reason FROM k"""

ORACLE["rule_loan"] = f"""
WITH t AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done,
  count(*) FILTER (o_orderstatus = 'P') AS late, cast(sum(cast(o_totalprice AS DECIMAL(14, 2))) AS DOUBLE) AS spent
  FROM orders GROUP BY 1),
q AS (SELECT c_custkey, c_acctbal / 3000 AS dscr, spent / 1000000 AS cover, 560 + done * 30 AS fico,
  greatest(late - 4, 0) AS bad, n / 4 AS lev FROM t JOIN customer ON c_custkey = o_custkey),
k AS (SELECT *, CASE WHEN dscr >= 1.3::DOUBLE AND cover >= 1.2::DOUBLE AND fico >= 680 AND bad = 0 THEN 'APPROVE'
  WHEN dscr < 1 OR fico < 620 OR bad >= 2 OR lev > 4.5 THEN 'REJECT' ELSE 'REVIEW' END AS decision FROM q)
SELECT c_custkey, decision, CASE decision WHEN 'APPROVE' THEN {_reason["loan_approve"]}
  WHEN 'REJECT' THEN {_reason["loan_reject"]} ELSE {_reason["loan_review"]} END AS reason FROM k"""


def _batch(source: str, key: str) -> str:
    return f"""
SELECT {key}, {rounded('total')} AS proposed_total, left_over AS remaining_budget,
  CASE WHEN total <= left_over THEN 'APPROVE' ELSE 'REJECT' END AS decision,
  CASE WHEN total <= left_over THEN {fill('batch_approve', total=money('total'), remaining=money('left_over'))}
  ELSE {fill('batch_reject', total=money('total'), remaining=money('left_over'))} END AS reason FROM {source}"""


ORACLE["rule_batch_budget"] = f"""
WITH b AS (SELECT l_orderkey, cast(sum(cast(l_extendedprice AS DECIMAL(14, 2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY 1),
j AS (SELECT *, {rounded(f"o_totalprice - {rounded('o_totalprice / 3')}")} AS left_over
  FROM b JOIN orders ON l_orderkey = o_orderkey)
{_batch('j', 'o_orderkey')}"""
ORACLE["rule_batch_array"] = f"""
WITH j AS (SELECT o_orderkey, list_reduce(list_transform(range(1, 3 + o_orderkey % 4), lambda n: o_totalprice * n / 10),
  lambda x, y: x + y) AS total, {rounded('o_totalprice * 1.1::DOUBLE - o_totalprice * 0.1::DOUBLE')} AS left_over FROM orders)
{_batch('j', 'o_orderkey')}"""

ORACLE["rule_anomaly"] = f"""
WITH m AS (SELECT o_custkey AS k, avg(o_totalprice::DOUBLE) AS mean, stddev_pop(o_totalprice::DOUBLE) AS std FROM orders GROUP BY 1),
z AS (SELECT o_orderkey, o_orderpriority, {rounded('(o_totalprice - mean) / greatest(std, 1)')} AS z
  FROM orders LEFT JOIN m ON o_custkey IS NOT DISTINCT FROM k),
j AS (SELECT *, abs(z) >= 2.5 AND o_orderpriority <> '1-URGENT' AS odd FROM z)
SELECT o_orderkey, z AS z_score, CASE WHEN odd THEN 'OUTLIER' ELSE 'NORMAL' END AS decision,
  CASE WHEN odd THEN {fill('anomaly_outlier', z='z')} ELSE {fill('anomaly_normal', z='z')} END AS reason FROM j"""

_unknown_text = {name: f"coalesce({money(name)}, 'unknown')" for name in ("a", "r", "f", "b")}
_unknown_rules = {
    "budget": ("a <= r", "'APPROVE'", "'REJECT'",
        fill("budget_approve", amount=money("a"), remaining=money("r"), difference=money("r - a")),
        fill("budget_reject", amount=_unknown_text["a"], remaining=_unknown_text["r"],
             difference=f"coalesce({money('a - r')}, 'unknown')")),
    "policy": ("len(broken) > 0", "'REJECT'", "'APPROVE'",
        fill("policy_reject", problems="array_to_string(broken, '; ')"), lit(wording.REASONS["policy_approve"])),
    "fraud": ("score >= 4", "'MANUAL_REVIEW'", "'ALLOW'", fill("fraud_review", score="score"), fill("fraud_allow", score="score")),
    "spend_alert": ("spent > b OR f > b * 1.05::DOUBLE OR variance > 10", "'ALERT'", "'NO_ALERT'",
        fill("spend_alert", forecast=_unknown_text["f"], variance="coalesce(cast(variance AS VARCHAR), 'unknown')",
             budget=_unknown_text["b"]),
        fill("spend_quiet", forecast=_unknown_text["f"], budget=_unknown_text["b"])),
    "anomaly": ("abs(z) >= 2.5 AND NOT coalesce(id % 2 > 0 AND kind = 'view', false)", "'OUTLIER'", "'NORMAL'",
        fill("anomaly_outlier", z="z"), fill("anomaly_normal", z="coalesce(cast(z AS VARCHAR), 'unknown')")),
}
ORACLE["rules_unknown_facts"] = f"""
WITH k AS (SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 5 > 0 THEN value END AS a,
  CASE WHEN event_id % 7 > 0 THEN 90.5::DOUBLE END AS r, CASE WHEN event_id % 3 > 0 THEN value END AS spent,
  CASE WHEN event_id % 5 > 0 THEN CASE WHEN event_id % 2 = 0 THEN 64::DOUBLE ELSE 0::DOUBLE END END AS b,
  CASE WHEN event_id % 7 > 0 THEN 65::DOUBLE END AS f,
  CASE WHEN event_id % 3 > 0 AND event_id % 7 > 0
    THEN {rounded('(value - 8) / CASE WHEN event_id % 5 > 0 THEN 32 ELSE 1 END')} END AS z FROM events),
j AS (SELECT *, CASE WHEN b <> 0 THEN {rounded('(f - b) / b * 100')} END AS variance,
  list_filter([
    CASE WHEN NOT coalesce(id % 3 > 0 AND kind <> 'error', false) THEN {lit(wording.REASONS['policy_vendor'])} END,
    CASE WHEN a > r THEN {fill('policy_limit', excess=money('a - r'))} END,
    CASE WHEN a > 1000 THEN {lit(wording.REASONS['policy_manager'])} END,
    CASE WHEN a > 75 AND id % 4 = 0 THEN {lit(wording.REASONS['policy_receipt'])} END], lambda x: x IS NOT NULL) AS broken,
  cast(id % 2 > 0 AS INT) + cast(id % 3 > 0 AND kind = 'error' AS INT) + cast(id % 4 > 0 AND kind <> 'view' AS INT)
    + cast(id % 7 > 0 AS INT) + cast(coalesce(a * 100 >= 5000, false) AS INT)
    + cast(NOT (id % 11 > 0 AND kind <> 'click') AS INT) AS score FROM k)
{" UNION ALL ".join(
    f"SELECT id AS event_id, '{name}' AS rule, CASE WHEN {test} THEN {yes} ELSE {no} END AS decision,"
    f" CASE WHEN {test} THEN {first} ELSE {second} END AS reason FROM j"
    for name, (test, yes, no, first, second) in _unknown_rules.items())}"""

# --- scenarios --------------------------------------------------------------------


def unit(field: str) -> str:
    return f"(cast('0x' || substr(md5('42|' || i || '|{field}'), 1, 8) AS BIGINT) / 4294967296::DOUBLE)"


def uniform(field: str, low, high) -> str:
    exact = f"({low})::DOUBLE + (({high})::DOUBLE - ({low})::DOUBLE) * {unit(field)}"
    return f"floor(({exact}) * 100::DOUBLE + 0.5::DOUBLE) / 100::DOUBLE"


def whole(field: str, low: int, high: int) -> str:
    return f"{low} + cast(floor({unit(field)} * {high - low + 1}) AS BIGINT)"


def choice(field: str, options) -> str:
    return f"([{', '.join(lit(option) for option in options)}])[cast(floor({unit(field)} * {len(options)}) AS INT) + 1]"


def flag(field: str) -> str:
    return f"{unit(field)} < 0.5"


def json_of(**members: str) -> str:
    """JSON object text; a leading s marks strings, the others print as they are."""
    parts = []
    for name in sorted(members):
        shown = members[name]
        value = f"'\"' || {shown[2:]} || '\"'" if shown.startswith("s:") else f"cast({shown} AS VARCHAR)"
        parts.append(f"'\"{name}\": ' || {value}")
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


def scenario(at: int, category: str, steps: list[dict[str, str]], decision: str, reason: str, context: str) -> str:
    rows = f"(SELECT o_orderkey AS i FROM orders WHERE o_orderkey % 12 = {at})"
    for step in steps:
        fields = ", ".join(f"{sql} AS {name}" for name, sql in step.items())
        rows = f"(SELECT *, {fields} FROM {rows})"
    return f"""
SELECT format('{category}-{{:06d}}', i) AS id, {lit(wording.INSTRUCTIONS[category])} AS instruction,
  {context} AS context, {decision_text(decision, reason)} AS output, '{category}' AS category, 'synthetic' AS source
FROM {rows}"""


def two(condition: str, yes: str, no: str, first: str, second: str) -> tuple[str, str]:
    return (
        f"CASE WHEN {condition} THEN '{yes}' ELSE '{no}' END",
        f"CASE WHEN {condition} THEN {first} ELSE {second} END",
    )


def scenarios_sql() -> str:
    vendors = [vendor for vendor, _ in wording.VENDOR_BUCKETS]
    buckets = [name for _, name in wording.VENDOR_BUCKETS]
    made = []

    def add(category, steps, decision, reason, context):
        made.append(scenario(len(made), category, steps, decision, reason, context))

    fits = two("amount <= remaining", "APPROVE", "REJECT",
               fill("budget_approve", amount=money("amount"), remaining=money("remaining"),
                    difference=money("remaining - amount")),
               fill("budget_reject", amount=money("amount"), remaining=money("remaining"),
                    difference=money("amount - remaining")))
    add("budget_reasoning",
        [{"budget": uniform("budget", 500, 12000)},
         {"remaining": uniform("remaining", 0, "budget"),
          "amount": uniform("amount", 25, "greatest(50, budget * 0.35::DOUBLE)"),
          "purchase": choice("purchase", wording.PURCHASES), "department": choice("department", wording.DEPARTMENTS)}],
        *fits, json_of(budget="budget", remaining="remaining", amount="amount", purchase="s:purchase",
                       department="s:department"))
    add("expense_classification",
        [{"vendor": choice("vendor", vendors), "bucket": choice("vendor", buckets),
          "amount": uniform("amount", 40, 5000), "team": choice("team", wording.DEPARTMENTS)}],
        "upper(bucket)", fill("expense", amount=money("amount"), vendor="vendor", bucket="bucket", team="team"),
        json_of(vendor="s:vendor", amount="amount", team="s:team", memo="s:(vendor || ' renewal or payment')"))
    signals = ("geo_mismatch", "new_device", "after_hours", "card_present")
    points = ("cast(velocity_24h >= 5 AS INT) + cast(geo_mismatch AS INT) + cast(new_device AS INT)"
              " + cast(after_hours AS INT) + cast(amount >= 5000 AS INT) + cast(NOT card_present AS INT)")
    add("fraud_detection",
        [{"amount": uniform("amount", 20, 8000), "velocity_24h": whole("velocity_24h", 1, 9),
          **{name: flag(name) for name in signals}}, {"s": points}],
        *two("s >= 4", "MANUAL_REVIEW", "ALLOW", fill("fraud_review", score="s"), fill("fraud_allow", score="s")),
        json_of(amount="amount", velocity_24h="velocity_24h", **{name: name for name in signals}))
    problems = f"""list_filter([CASE WHEN NOT va THEN {lit(wording.REASONS['policy_vendor'])} END,
      CASE WHEN amount > lim THEN {fill('policy_limit', excess=money('amount - lim'))} END,
      CASE WHEN big AND NOT ma THEN {lit(wording.REASONS['policy_manager'])} END,
      CASE WHEN amount > 75 AND NOT ra THEN {lit(wording.REASONS['policy_receipt'])} END], lambda x: x IS NOT NULL)"""
    add("policy_compliance",
        [{"amount": uniform("amount", 20, 7500), "lim": uniform("policy_limit", 500, 5000),
          "va": flag("vendor_approved"), "ra": flag("receipt_attached"),
          "e": choice("expense_type", wording.POLICY_EXPENSES)},
         {"big": "amount > 1000", "ma": f"amount <= 1000 OR {flag('manager_approved')}"}, {"v": problems}],
        *two("len(v) > 0", "REJECT", "APPROVE", fill("policy_reject", problems="array_to_string(v, '; ')"),
             _reason["policy_approve"]),
        json_of(amount="amount", policy_limit="lim", vendor_approved="va", receipt_attached="ra", expense_type="s:e",
                manager_approval_required="big", manager_approved="ma"))
    add("tax_deduction_advice",
        [{"e": choice("expense_type", wording.TAX_EXPENSES), "amount": uniform("amount", 30, 3500),
          "p": whole("business_use_percent", 0, 100), "r": flag("receipt_attached")}],
        *two("p >= 50 AND r AND e <> 'family vacation flight'", "DEDUCTIBLE", "NON_DEDUCTIBLE",
             fill("tax_deductible", expense_type="e", percent="p"), fill("tax_not_deductible", expense_type="e")),
        json_of(expense_type="s:e", amount="amount", business_use_percent="p", receipt_attached="r",
                jurisdiction="s:'US'"))
    add("spending_alerts",
        [{"b": uniform("budget", 2000, 50000), "a": uniform("actual_spend", 1000, 60000),
          "p": choice("period", wording.PERIODS), "c": choice("cost_center", wording.COST_CENTERS)},
         {"f": uniform("forecast_spend", "a - 2500", "a + 8000")}, {"v": rounded("(f - b) / b * 100")}],
        *two("a > b OR f > b * 1.05::DOUBLE OR v > 10", "ALERT", "NO_ALERT",
             fill("spend_alert", forecast=money("f"), variance="v", budget=money("b")),
             fill("spend_quiet", forecast=money("f"), budget=money("b"))),
        json_of(budget="b", actual_spend="a", forecast_spend="f", variance_pct="v", period="s:p", cost_center="s:c"))
    add("investment_analysis",
        [{"i1": choice("industry", wording.INDUSTRIES), "g": uniform("revenue_growth_pct", -15, 45),
          "m": uniform("gross_margin_pct", 20, 85), "n": uniform("net_margin_pct", -25, 30),
          "d": uniform("debt_to_ebitda", 0, 6), "v": uniform("valuation_multiple", 3, 20),
          "p": uniform("peer_multiple", 4, 16), "f": flag("free_cash_flow_positive")},
         {"k": "cast(g >= 15 AS INT) + cast(m >= 50 AS INT) + cast(n >= 10 AS INT) + cast(d <= 2.5 AS INT)"
               " + cast(v <= p AS INT) + cast(f AS INT)"}],
        case(("k >= 5", "'BUY'"), ("k >= 3", "'HOLD'"), otherwise="'AVOID'"),
        case(("k >= 5", _reason["invest_buy"]), ("k >= 3", _reason["invest_hold"]), otherwise=_reason["invest_avoid"]),
        json_of(industry="s:i1", revenue_growth_pct="g", gross_margin_pct="m", net_margin_pct="n", debt_to_ebitda="d",
                valuation_multiple_ev_revenue="v", peer_multiple_ev_revenue="p", free_cash_flow_positive="f"))
    sound = "d >= 1.3::DOUBLE AND c >= 1.2::DOUBLE AND f >= 680 AND q = 0"
    barred = "d < 1 OR f < 620 OR q >= 2 OR l > 4.5"
    add("loan_evaluation",
        [{"a": uniform("loan_amount", 25000, 1500000), "d": uniform("dscr", 0.7, 2.4),
          "c": uniform("collateral_coverage", 0.5, 2.2), "f": whole("fico_score", 540, 820),
          "q": whole("recent_delinquencies", 0, 4), "l": uniform("leverage_ratio", 1.0, 6.0)}],
        case((sound, "'APPROVE'"), (barred, "'REJECT'"), otherwise="'REVIEW'"),
        case((sound, _reason["loan_approve"]), (barred, _reason["loan_reject"]), otherwise=_reason["loan_review"]),
        json_of(loan_amount="a", dscr="d", collateral_coverage="c", fico_score="f", recent_delinquencies="q",
                leverage_ratio="l"))
    add("financial_ratios",
        [{"c": uniform("current_ratio", 0.6, 3.0), "q": uniform("quick_ratio", 0.4, 2.6),
          "d": uniform("debt_to_equity", 0.1, 3.5), "t": uniform("interest_coverage", 0.3, 10.0),
          "m": uniform("operating_margin_pct", -12, 35)}],
        *two("c >= 1.2::DOUBLE AND q >= 1 AND d <= 1.5 AND t >= 3 AND m >= 8", "HEALTHY", "DISTRESSED",
             _reason["ratios_healthy"], _reason["ratios_distressed"]),
        json_of(current_ratio="c", quick_ratio="q", debt_to_equity="d", interest_coverage="t", operating_margin_pct="m"))
    lines = [
        "{'a': " + uniform(f"amount_{n}", 150, "b * 0.18::DOUBLE") + ", 't': "
        + choice(f"type_{n}", wording.TRANSACTION_TYPES) + ", 'v': " + choice(f"vendor_{n}", vendors) + "}"
        for n in range(5)
    ]
    listed = ("'[' || array_to_string(list_transform(x, lambda t: '{\"amount\": ' || t.a || ', \"type\": \"' || t.t"
              " || '\", \"vendor\": \"' || t.v || '\"}'), ', ') || ']'")
    add("multi_transaction_budgeting",
        [{"b": uniform("budget", 5000, 60000), "n": whole("lines", 2, 5)},
         {"c": uniform("committed_spend", 0, "b * 0.8::DOUBLE"), "x": f"([{', '.join(lines)}])[1:n]"},
         {"s": "list_reduce(list_transform(x, lambda t: t.a), lambda p, q: p + q)", "r": rounded("b - c")}],
        *two("s <= r", "APPROVE", "REJECT", fill("batch_approve", total=money("s"), remaining=money("r")),
             fill("batch_reject", total=money("s"), remaining=money("r"))),
        json_of(budget="b", committed_spend="c", remaining_budget="r", transactions=f"({listed})",
                proposed_total=rounded("s")))
    add("anomaly_detection",
        [{"m": uniform("baseline_mean", 200, 5000), "k": flag("recurring_vendor")},
         {"d": uniform("baseline_std", 20, "greatest(50, m * 0.35::DOUBLE)"), "o": uniform("observed", 20, "m * 4")},
         {"z": rounded("(o - m) / greatest(d, 1)")}],
        *two("abs(z) >= 2.5 AND NOT k", "OUTLIER", "NORMAL", fill("anomaly_outlier", z="z"),
             fill("anomaly_normal", z="z")),
        json_of(baseline_mean_amount="m", baseline_std_amount="d", observed_amount="o", z_score="z",
                recurring_vendor="k"))
    good, poor = "x > 0 AND q <= 8 AND l <= 4", "x < 0 OR l > 5 OR q > 12"
    add("corporate_finance_reasoning",
        [{"p": uniform("purchase_price", 10000000, 250000000), "s": uniform("expected_synergies", 500000, 20000000),
          "e": uniform("target_ebitda", 1000000, 30000000), "c": uniform("financing_cost_pct", 3, 12),
          "q": uniform("equity_dilution_pct", 0, 18), "l": uniform("post_close_leverage", 1.2, 6.0)},
         {"x": "s + e * 0.2::DOUBLE - p * (c / 100)"}],
        case((good, "'ACCRETIVE'"), (poor, "'DILUTIVE'"), otherwise="'REVIEW'"),
        case((good, _reason["deal_accretive"]), (poor, _reason["deal_dilutive"]), otherwise=_reason["deal_review"]),
        json_of(purchase_price="p", expected_synergies="s", target_ebitda="e", financing_cost_pct="c",
                equity_dilution_pct="q", post_close_leverage="l"))
    return "\nUNION ALL\n".join(made)


ORACLE["scenario_generate"] = scenarios_sql()

# --- responses --------------------------------------------------------------------

_responses = """
answers AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN text
  WHEN 1 THEN 'Decision: approve - ' || lang || chr(10) || 'Reason: ' || text
  WHEN 2 THEN 'Decision:' || chr(10) || 'Reason: maybe ' || text
  WHEN 3 THEN 'Decision: non deductible' || chr(10) || 'Confidence: 0.87' || chr(10) || text
  WHEN 4 THEN 'Reason:  ' || source || chr(10) || 'Decision: Manual  Review!' || chr(10) || 'Confidence: 12' || chr(10) || text
  ELSE 'Decision: ' || text END AS response FROM documents)"""
_names = ", ".join(f"'{name}'" for name in (*APPROVE_LABELS, *REJECT_LABELS, "hold", "!"))
ORACLE["label_bucket"] = f"""
WITH c AS (SELECT doc_id, text, ([{_names}])[doc_id % 23 + 1] AS c FROM documents),
l AS (SELECT doc_id, {label("CASE WHEN doc_id % 2 = 0 THEN lower(c || ' / ' || text) ELSE c || ' / ' || text END")} AS l FROM c)
SELECT doc_id, md5(l) AS label_md5, {bucket('l')} AS bucket FROM l"""
ORACLE["confidence"] = f"""
WITH d AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'APPROVE' ELSE upper(source) END AS l,
  CASE WHEN doc_id % 3 = 0 THEN text || ' It appears so.' ELSE text END AS e FROM documents)
SELECT doc_id, {score('l', 'e')} AS confidence FROM d"""
ORACLE["parse_response"] = f"""
WITH {_responses}, p AS (SELECT doc_id, response, {raw_label('response')} AS l, {explained('response')} AS e,
  nullif(regexp_extract(response, '{CONFIDENCE_PATTERN}', 1), '') AS c FROM answers),
s AS (SELECT *, coalesce({rounded('try_cast(c AS DOUBLE)', 4)}, {score('l', 'e')}) AS conf FROM p)
SELECT doc_id, md5(l) AS raw_decision_md5, {bucket('l')} AS decision, md5(e) AS reason_md5, conf AS confidence,
  least(greatest(conf, 0), 1) AS clamped FROM s"""

_order_context = (
    "('{' || chr(10) || '  \"amount\": ' || o_totalprice || ',' || chr(10) || '  \"status\": \"' || o_orderstatus"
    " || '\"' || chr(10) || '}')"
)
_order_prompt = prompt("('Check order ' || o_orderpriority)", _order_context)
ORACLE["decision_scoring"] = f"""
WITH p AS (SELECT o_orderkey, length({_order_prompt}) AS n FROM orders),
e AS (SELECT *, 'The request has ' || n || ' characters.' AS e,
  CASE n % 3 WHEN 0 THEN 'APPROVE' WHEN 1 THEN 'REJECT' ELSE 'HOLD' END AS l FROM p)
SELECT o_orderkey, {bucket('l')} AS decision, e AS explanation, {score('l', 'e')} AS confidence FROM e"""

_line = "chr(10) || '    {' || chr(10) || '      \"amount\": ' || o_totalprice || ',' || chr(10) || '      \"note\": null'"
_error_context = (
    "('{' || chr(10) || '  \"customer\": {' || chr(10) || '    \"id\": ' || CASE WHEN o_orderkey % 3 > 0"
    " THEN cast(o_custkey AS VARCHAR) ELSE 'null' END || chr(10) || '  },' || chr(10) || '  \"lines\": '"
    f" || CASE WHEN o_orderkey % 2 = 0 THEN '[' || {_line} || chr(10) || '    }},' || chr(10) || '    null' || chr(10) || '  ]'"
    " ELSE '[]' END || ',' || chr(10) || '  \"status\": \"' || o_orderstatus || '\"' || chr(10) || '}')"
)
_error_prompt = prompt("('Check order ' || o_orderpriority)", _error_context)
ORACLE["decision_errors"] = f"""
WITH p AS (SELECT o_orderkey, length({_error_prompt}) || ' characters.' AS said,
  CASE WHEN o_orderkey % 7 = 0 THEN 'instruction is missing' WHEN o_orderkey % 5 = 0 THEN 'context is missing'
  WHEN o_orderstatus = 'P' THEN 'model failed: ValueError: pending' END AS error FROM orders),
e AS (SELECT *, CASE WHEN error IS NULL THEN said ELSE '' END AS e,
  CASE WHEN error IS NULL THEN 'APPROVE' ELSE 'UNKNOWN' END AS l FROM p)
SELECT o_orderkey, {bucket('l')} AS decision, e AS explanation, {score('l', 'e')} AS confidence, error FROM e"""

# --- evaluation -------------------------------------------------------------------

_scored = """
g AS (SELECT doc_id AS id, lang AS category, n_chars,
  CASE WHEN toxic = 1 THEN 'MANUAL_REVIEW' WHEN quality = 1 THEN 'APPROVE' ELSE 'REJECT' END AS expected
  FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, CASE WHEN id % 10 = 3 THEN 'UNKNOWN' WHEN n_chars % 5 = 0 THEN 'MANUAL_REVIEW'
  WHEN n_chars % 3 <> 0 THEN 'APPROVE' ELSE 'REJECT' END AS predicted FROM g),
s AS (SELECT *, expected = predicted AS hit,
  expected = predicted AND expected <> 'MANUAL_REVIEW' AS exact FROM r)"""


def _share(hits: str, of: str) -> str:
    return f"(count(*) FILTER ({hits}))::DOUBLE / greatest({of}, 1)"


_all = "count(*)"
_recall = _share("hit AND expected = 'REJECT'", "count(*) FILTER (expected = 'REJECT')")
_precision = _share("hit AND expected = 'MANUAL_REVIEW'", "count(*) FILTER (predicted = 'MANUAL_REVIEW')")
_positive = _share("hit AND expected = 'MANUAL_REVIEW'", "count(*) FILTER (expected = 'MANUAL_REVIEW')")
ORACLE["eval_results"] = f"""
WITH {_scored} SELECT id, category, expected AS expected_decision, predicted AS predicted_decision,
  'Size ' || n_chars AS expected_explanation, CASE WHEN id % 10 = 3 THEN '' ELSE 'size ' || n_chars END
  AS predicted_explanation, hit AS decision_match, exact AS exact_match FROM s"""
ORACLE["eval_accuracy"] = f"WITH {_scored} SELECT count(*) AS samples, {_share('hit', _all)} AS accuracy FROM s"
ORACLE["eval_category_accuracy"] = ORACLE["eval_accuracy"] + " WHERE category = 'fr'"
ORACLE["eval_exact"] = f"""
WITH {_scored} SELECT count(*) AS samples, {_share('hit', _all)} AS reasoning_accuracy,
  {_share('exact', _all)} AS exact_match_rate FROM s"""
ORACLE["eval_budget"] = f"""
WITH {_scored} SELECT count(*) AS samples, {_share('hit', _all)} AS budget_decision_accuracy,
  {_recall} AS reject_recall FROM s WHERE category IN ('en', 'de')"""
ORACLE["eval_recall"] = f"""
WITH {_scored} SELECT count(*) FILTER (expected = 'REJECT') AS gold, {_recall} AS recall FROM s"""
ORACLE["eval_prf"] = f"""
WITH {_scored}, m AS (SELECT count(*) AS samples, {_precision} AS precision, {_positive} AS recall
  FROM s WHERE category = 'en')
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m"""
_metrics = f"""count(*) AS samples, {_share('hit', _all)} AS accuracy, {_share('exact', _all)} AS exact_match_rate,
  {_recall} AS reject_recall, {_precision} AS precision, {_positive} AS recall"""
ORACLE["eval_by_category"] = f"""
WITH {_scored} SELECT category, 0 AS overall, {_metrics} FROM s GROUP BY category
UNION ALL SELECT NULL, 1, {_metrics} FROM s"""
ORACLE["scenario_pass"] = f"""
WITH {_scored}, c AS (SELECT *, contains(CASE WHEN id % 10 = 3 THEN '' WHEN predicted = 'MANUAL_REVIEW'
  THEN 'MANUAL REVIEW' ELSE predicted END, expected) AS passed FROM s)
SELECT count(*) AS scenarios, count(*) FILTER (passed) AS passed, {_share('passed', _all)} AS pass_rate FROM c"""

# --- the whole build --------------------------------------------------------------

_conv_wrapped = (
    f"CASE WHEN clean LIKE 'Decision:%' THEN clean ELSE {decision_text(lit('ANSWER'), squeeze('clean'))} END"
)
_corpus = f"""
{_doc_records},
conv_records AS (SELECT format('conv-{{}}-{{}}', conv_id, turn) AS id, 'Continue the conversation.' AS instruction,
  '{{"role": "' || role || '"}}' AS context, {_conv_wrapped} AS output, 'conversation' AS category, NULL AS source,
  conv_id * 1000 + turn AS ord FROM (SELECT *, {squeeze_lines('text')} AS clean FROM conversations)),
everything AS (SELECT *, 0 AS source_ord FROM doc_records UNION ALL SELECT *, 1 FROM conv_records),
uniq AS (SELECT * FROM everything QUALIFY row_number() OVER (
  PARTITION BY instruction, context, output, category ORDER BY source_ord, ord) = 1),
{split_sql('uniq', 'category', 'id', '*', ties=', source_ord, ord')},
built AS (SELECT *, {prompt('instruction', 'context')} || output || {lit(chr(10) + '<|eot_id|>')} AS text FROM labelled),
done AS (SELECT *, len(string_split({squeeze('text')}, ' ')) AS token_count FROM built)"""
ORACLE["corpus_build"] = f"""
WITH {_corpus} SELECT id, category, source, split, md5(text) AS text_md5, token_count FROM done"""
ORACLE["preprocess_summary"] = f"""
WITH {_corpus} SELECT split, count(*) AS rows, min(token_count) AS min, max(token_count) AS max,
  {rounded('avg(token_count)')} AS avg FROM done GROUP BY split"""


def _names(column: str) -> str:
    named = f"SELECT coalesce({column}, 'unknown') AS name, count(*) AS n FROM uniq GROUP BY 1"
    return f"(SELECT string_agg(name || '=' || n, ',' ORDER BY name) FROM ({named}))"


ORACLE["build_report"] = f"""
WITH {_corpus} SELECT (SELECT count(*) FROM everything) AS before_deduplication, count(*) AS after_deduplication,
  count(*) >= 100000 AS target_met, count(*) AS samples, {_names('category')} AS categories, {_names('source')} AS sources,
  'documents,conversations' AS inputs, count(*) FILTER (split = 'train') AS train_rows,
  count(*) FILTER (split = 'validation') AS validation_rows, count(*) FILTER (split = 'test') AS test_rows,
  cast(0.8 AS DOUBLE) AS train_ratio, cast(0.1 AS DOUBLE) AS validation_ratio, cast(0.1 AS DOUBLE) AS test_ratio,
  'words' AS tokenizer_id, min(token_count) AS token_min, max(token_count) AS token_max, {rounded('avg(token_count)')} AS token_avg
FROM done"""
ORACLE["json_in_splits"] = """
SELECT doc_id, md5(text) AS text_md5, lang, source,
  row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) - 1 AS record_ord FROM documents"""
