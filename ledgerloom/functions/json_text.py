"""Canonical JSON text: sorted keys, ASCII only, ``", "`` and ``": "`` separators.

Two producers give the same text. For typed contexts the schema is known when
the plan is built, so the JSON is one generated column expression. Free-form
contexts have a different shape on every row; those go through one Arrow UDF.
"""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import (
    NUMBER_MARKS,
    NUMBER_PATTERN,
    NUMERIC_NAME_PARTS,
    SPACE,
    let,
    sql_let,
    sql_text,
)

# The short escapes of JSON strings.
SHORT_ESCAPES = {
    "\\": "\\\\",
    '"': '\\"',
    "\n": "\\n",
    "\r": "\\r",
    "\t": "\\t",
    "\b": "\\b",
    "\f": "\\f",
}


# A double (named ``x``) as its shortest text: plain notation between 1e-4 and
# 1e16, always with a decimal point; scientific outside, with a two-digit exponent.
_ZEROS = r"r'(\.\d+?)0+$', '$1'"
_SHORT_TEXT = r"abs({0}) >= 1e-3 AND abs({0}) < 1e7 AND cast({0} AS STRING) RLIKE r'\.\d{{1,6}}$'"
FLOAT_SQL = rf"""
CASE
  WHEN {_SHORT_TEXT.format("x")} THEN cast(x AS STRING)
  WHEN (x = 0 OR abs(x) >= 1e-4) AND abs(x) < 1e9
       AND cast(replace(format_number(x, 6), ',', '') AS DOUBLE) = x
    THEN regexp_replace(replace(format_number(x, 6), ',', ''), {_ZEROS})
  WHEN abs(x) >= 1e-3 AND abs(x) < 1e7 THEN cast(x AS STRING)
  WHEN abs(x) >= 1e7 AND abs(x) < 1e16
    THEN regexp_replace(cast(cast(x AS DECIMAL(38, 18)) AS STRING), {_ZEROS})
  WHEN abs(x) >= 1e-4 AND abs(x) < 1e-3
    THEN regexp_replace(cast(cast(x AS DECIMAL(38, 24)) AS STRING), {_ZEROS})
  WHEN isnan(x) THEN 'NaN'
  WHEN x = double('Infinity') THEN 'Infinity'
  WHEN x = double('-Infinity') THEN '-Infinity'
  ELSE concat(
    regexp_replace(substring_index(cast(x AS STRING), 'E', 1), r'\.0$', ''),
    CASE WHEN abs(x) < 1 THEN 'e-' ELSE 'e+' END,
    lpad(cast(abs(try_cast(substring_index(cast(x AS STRING), 'E', -1) AS INT)) AS STRING), 2, '0'))
END"""

# One character (named ``c``) as an escape, as a surrogate pair above the basic plane.
_SHORT = " ".join(
    f"WHEN c = {sql_text(char)} THEN {sql_text(written)}" for char, written in SHORT_ESCAPES.items() if not char.isprintable()
)
_ESCAPE_SQL = rf"""
CASE
  {_SHORT}
  WHEN ascii(c) < 65536 THEN concat(r'\u', lpad(lower(hex(ascii(c))), 4, '0'))
  ELSE concat(r'\u', lower(hex(55296 + shiftright(ascii(c) - 65536, 10))),
              r'\u', lower(hex(56320 + ((ascii(c) - 65536) & 1023))))
END"""

# A string (named ``s``) as the inside of a JSON literal. Texts in printable
# ASCII skip the fold, which runs once per distinct odd character. Escapes are
# printable, so it does not matter which character is replaced first.
_PRINTABLE = "s"
for _char, _written in SHORT_ESCAPES.items():
    if _char.isprintable():
        _PRINTABLE = f"replace({_PRINTABLE}, {sql_text(_char)}, {sql_text(_written)})"
QUOTE_SQL = f"""
concat('"', {sql_let(_PRINTABLE, "t", f"""
CASE WHEN t RLIKE '[^ -~]'
  THEN aggregate(array_distinct(regexp_extract_all(t, '([^ -~])', 1)), t,
                 (done, c) -> replace(done, c, {_ESCAPE_SQL}))
  ELSE t END""")}, '"')"""

_SPELLED_SQL = """try_cast(regexp_replace(s, r'[()$,%]', '') AS DOUBLE)
      * CASE WHEN startswith(s, '(') AND endswith(s, ')') THEN -1D ELSE 1D END"""
_ROUNDED_SQL = "coalesce(try_cast(replace(format_number(v, 6), ',', '') AS DOUBLE), v)"
NUMBER_SQL = rf"""
CASE WHEN s RLIKE r'{NUMBER_PATTERN}' THEN {sql_let(_SPELLED_SQL, "v", _ROUNDED_SQL)} END"""


def quote(text: Column) -> Column:
    """A JSON string literal; everything outside printable ASCII is escaped."""
    return let(text, "s", QUOTE_SQL)


def float_text(number: Column) -> Column:
    """A double as its shortest text."""
    return let(number, "x", FLOAT_SQL)


def _names_number(name: str) -> bool:
    lowered = name.lower()
    return any(part in lowered for part in NUMERIC_NAME_PARTS)


def _string_sql(value: str, key: str) -> str:
    """A squeezed string, or the number it spells where that is allowed."""
    number = sql_let(NUMBER_SQL, "x", FLOAT_SQL)
    if not _names_number(key):
        number = f"CASE WHEN s RLIKE r'{NUMBER_MARKS}' THEN {number} END"
    clean = f"trim(regexp_replace({value}, r'(?U){SPACE}++', ' '))"
    return sql_let(clean, "s", f"coalesce({number}, {QUOTE_SQL})")


def _value_sql(value: str, kind: T.DataType, indent: int | None, key: str, depth: int) -> str:
    def wrap(pieces: str, opening: str, closing: str) -> str:
        """Pieces (columns or one array) between brackets; nulls are left out."""
        if indent is None:
            return f"concat('{opening}', concat_ws(', ', {pieces}), '{closing}')"
        inner = "\n" + " " * (indent * (depth + 1))
        start, between = sql_text(opening + inner), sql_text("," + inner)
        end = sql_text("\n" + " " * (indent * depth) + closing)
        body = f"CASE WHEN p = '' THEN '{opening}{closing}' ELSE concat({start}, p, {end}) END"
        return sql_let(f"concat_ws({between}, {pieces})", "p", body)

    if isinstance(kind, T.StructType):
        renamed = {" ".join(field.name.split()): field for field in kind.fields}
        members = []
        for name in sorted(renamed):
            field = renamed[name]
            inside = f"{value}.`{field.name.replace('`', '``')}`"
            written = _value_sql(inside, field.dataType, indent, field.name, depth + 1)
            members.append(f"concat({sql_text(json.dumps(name) + ': ')}, {written})")
        return wrap(", ".join(members) or "cast(NULL AS STRING)", "{", "}")
    if isinstance(kind, T.ArrayType):
        item = f"v{depth}"
        written = _value_sql(item, kind.elementType, indent, key, depth + 1)
        return wrap(f"transform({value}, {item} -> coalesce({written}, 'null'))", "[", "]")
    if isinstance(kind, T.StringType):
        return _string_sql(value, key)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        exact = f"cast({value} AS DOUBLE)"
        six = f"replace(format_number({exact}, 6), ',', '')"
        usual = f"abs({exact}) < 999999999 AND ({exact} = 0 OR abs({exact}) >= 1e-4)"
        rare = sql_let(f"cast({six} AS DOUBLE)", "x", FLOAT_SQL)
        return (
            f"CASE WHEN {_SHORT_TEXT.format(exact)} THEN cast({exact} AS STRING)"
            f" WHEN {usual} THEN regexp_replace({six}, {_ZEROS}) ELSE {rare} END"
        )
    if isinstance(kind, (T.BooleanType, T.IntegralType, T.NullType)):
        return f"cast({value} AS STRING)"
    raise TypeError(f"no JSON form for {kind.simpleString()} at {key or 'context'}")


def context_json(context: str, kind: T.DataType, indent: int | None = None) -> Column:
    """Normalised canonical JSON of a typed context column, by name.

    Floats are rounded to six places, strings squeezed and, where the field
    name or the text says so, turned into numbers; null fields disappear while
    nulls inside arrays stay visible.
    """
    return F.expr(f"CASE WHEN {context} IS NOT NULL THEN {_value_sql(context, kind, indent, '', 0)} END")


def _plain_leaf(value: str, kind: T.DataType) -> str | None:
    """SQL of a scalar's JSON text, null for a null; None if only a parser can write it."""
    if isinstance(kind, T.StringType):
        return sql_let(value, "s", QUOTE_SQL)
    if isinstance(kind, (T.BooleanType, T.IntegralType, T.NullType)):
        return f"cast({value} AS STRING)"
    if isinstance(kind, T.DecimalType) and kind.scale == 0:
        return f"cast({value} AS STRING)"
    if isinstance(kind, T.FloatType):
        return sql_let(f"cast(cast({value} AS STRING) AS DOUBLE)", "x", FLOAT_SQL)
    if isinstance(kind, (T.DoubleType, T.DecimalType)):
        return sql_let(f"cast({value} AS DOUBLE)", "x", FLOAT_SQL)
    if isinstance(kind, (T.DatetimeType, T.TimestampNTZType, T.BinaryType)):
        return sql_let(f"to_json(named_struct('v', {value}))", "j", "nullif(substr(j, 6, length(j) - 6), '')")
    return None


def _plain_sql(value: str, kind: T.DataType, depth: int) -> str | None:
    inner, outer = "\n" + "  " * (depth + 1), "\n" + "  " * depth

    def wrap(pieces: str, opening: str, closing: str) -> str:
        """An array of pieces between brackets, one a line."""
        joined = f"array_join(p, {sql_text(',' + inner)})"
        body = f"concat({sql_text(opening + inner)}, {joined}, {sql_text(outer + closing)})"
        whole = sql_let(pieces, "p", f"CASE WHEN size(p) = 0 THEN '{opening}{closing}' ELSE {body} END")
        return f"CASE WHEN {value} IS NOT NULL THEN {whole} END"

    def nested(inside: str, kind: T.DataType) -> str | None:
        written = _plain_sql(inside, kind, depth + 1)
        return None if written is None else f"coalesce({written}, 'null')"

    if isinstance(kind, T.StructType):
        fields = {field.name: field for field in kind.fields}
        if len({name.lower() for name in fields}) < len(kind.fields):
            return None
        members = []
        for name in sorted(fields):
            written = nested(f"{value}.`{name.replace('`', '``')}`", fields[name].dataType)
            if written is None:
                return None
            members.append(f"concat({sql_text(json.dumps(name) + ': ')}, {written})")
        return wrap(f"array({', '.join(members)})" if members else "cast(array() AS array<string>)", "{", "}")
    if isinstance(kind, T.ArrayType):
        written = nested(f"v{depth}", kind.elementType)
        return written and wrap(f"transform({value}, v{depth} -> {written})", "[", "]")
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        written = nested(f"element_at({value}, v{depth})", kind.valueType)
        pair = f"concat({sql_let(f'v{depth}', 's', QUOTE_SQL)}, ': ', {written})"
        return written and wrap(f"transform(array_sort(map_keys({value})), v{depth} -> {pair})", "{", "}")
    return _plain_leaf(value, kind)


def plain_json(context: str, kind: T.DataType) -> Column | None:
    """A typed column, by name, as indented JSON with sorted keys and its values as given, nulls included.

    One generated expression. None for types it can't write (variants, maps
    whose keys aren't text, structs whose names differ in case only).
    """
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    written = _plain_sql(context, kind, 0) if nested else None
    return None if written is None else F.expr(written)


def null_paths(context: Column, schema: T.DataType, path: Column | str = "context") -> Column:
    """Paths of nulls inside arrays, such as ``context.transactions[2]``."""
    here = F.lit(path) if isinstance(path, str) else path
    none = F.array().cast("array<string>")
    if isinstance(schema, T.StructType):
        found = [
            null_paths(context[field.name], field.dataType, F.concat(here, F.lit(f".{field.name}")))
            for field in schema.fields
            if isinstance(field.dataType, (T.StructType, T.ArrayType))
        ]
        return F.concat(none, *[F.coalesce(paths, none) for paths in found])
    if isinstance(schema, T.ArrayType):

        def check(item: Column, position: Column) -> Column:
            spot = F.concat(here, F.lit("["), position.cast("string"), F.lit("]"))
            deeper = null_paths(item, schema.elementType, spot)
            return F.when(item.isNull(), F.array(spot)).otherwise(deeper)

        return F.flatten(F.transform(context, check))
    return none


# --- free-form contexts -------------------------------------------------------

_number_shape = re.compile(NUMBER_PATTERN)
_number_marks = re.compile(NUMBER_MARKS)
_number_noise = re.compile(r"[()$,%]")


@lru_cache(maxsize=65536)
def _key(name: str) -> tuple[str, bool]:
    """The squeezed field name, and whether the raw one announces a number."""
    return " ".join(name.split()), _names_number(name)


def _text_or_number(text: str, numeric: bool) -> str | float:
    squeezed = " ".join(text.split())
    if not (numeric or _number_marks.search(squeezed)) or not _number_shape.match(squeezed):
        return squeezed
    value = float(_number_noise.sub("", squeezed))
    paired = squeezed[0] == "(" and squeezed[-1] == ")"
    return round(-value if paired else value, 6)


def _clean(node: object, numeric: bool) -> object:
    kind = type(node)
    if kind is str:
        return _text_or_number(node, numeric)
    if kind is float:
        return round(node, 6) if math.isfinite(node) else node
    if kind is list:
        return [_clean(item, numeric) for item in node]
    if kind is dict:
        members = {}
        for name, value in node.items():
            if value is not None:
                shown, announces = _key(name)
                members[shown] = _clean(value, announces)
        return members
    return node


def _nulls(node: object, path: str) -> list[str]:
    """Where nulls are left; those of objects are gone by now."""
    if isinstance(node, dict):
        return [found for name, value in node.items() for found in _nulls(value, f"{path}.{name}")]
    if isinstance(node, list):
        return [found for at, item in enumerate(node) for found in _nulls(item, f"{path}[{at}]")]
    return [f"null found in {path}"] if node is None else []


def _canonical(text: str | None) -> tuple[str | None, list[str]]:
    if text is None:
        return None, ["context is missing"]
    try:
        node = json.loads(text)
        if not isinstance(node, dict):
            return None, ["context is not an object"]
        cleaned = _clean(node, False)
        written = json.dumps(cleaned, sort_keys=True)
        return written, _nulls(cleaned, "context") if "null" in written else []
    except ValueError:
        return None, ["context is not JSON"]
    except RecursionError:
        return None, ["context is nested too deeply"]


def _indented(text: str | None) -> str | None:
    try:
        return None if text is None else json.dumps(json.loads(text), indent=2, sort_keys=True)
    except (ValueError, RecursionError):
        return None


CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("json", T.StringType()),
        T.StructField("problems", T.ArrayType(T.StringType())),
    ]
)


@F.arrow_udf(CANONICAL_SCHEMA)
def canonical_context(texts: pa.Array) -> pa.Array:
    """Free-form JSON objects -> canonical text plus what is wrong with them."""
    done = [_canonical(text) for text in texts.to_pylist()]
    return pa.StructArray.from_arrays(
        [
            pa.array([text for text, _ in done], pa.string()),
            pa.array([problems for _, problems in done], pa.list_(pa.string())),
        ],
        names=["json", "problems"],
    )


# Declared non-deterministic so that the planner neither pushes filters on the
# problems below the call nor repeats it: each context is parsed once.
canonical_context = canonical_context.asNondeterministic()


@F.arrow_udf(T.StringType())
def indented(texts: pa.Array) -> pa.Array:
    """JSON text with two-space indentation; null for text that is not JSON or nested too deeply."""
    return pa.array([_indented(text) for text in texts.to_pylist()], pa.string())
