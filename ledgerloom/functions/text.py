"""Column functions for white space, money text and financial numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, and those of them
# that end a line.
BLANKS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_ENDS = r"\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}"

# The same in Java's terms, which it matches faster than long character unions:
# Unicode white space, plus the four separators that property leaves out.
SPACE = r"[\s\x1c-\x1f]"

# What a financial number looks like.
NUMBER_PATTERN = r"^\(?-?\$?\d[\d,]*(?:\.\d+)?%?\)?$"
NUMBER_MARKS = r"[$%,.()]"

# Field-name parts that announce a number.
NUMERIC_NAME_PARTS = (
    "amount", "budget", "remaining", "spend", "price", "cost", "revenue",
    "expense", "profit", "margin", "cash", "ebitda", "income", "assets",
    "liabilities", "equity", "debt", "ratio", "loan", "payment", "apr", "rate",
    "interest", "tax", "principal", "forecast", "variance", "valuation",
    "multiple", "balance", "salary",
)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    plain = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{plain}'"


def sql_let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, evaluated once.

    For bodies that mention a long expression many times: without a binding the
    plan would grow by that factor at every level of nesting.
    """
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def let(value: Column, name: str, body: str) -> Column:
    """``sql_let`` for a column."""
    bound = F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}"))
    return F.element_at(bound, 1)


def squeeze(text: Column) -> Column:
    """White-space runs become one space; both ends are stripped."""
    return F.trim(F.regexp_replace(text, f"(?U){SPACE}++", " "))


def strip(text: Column) -> Column:
    """Strip white space of any kind from both ends, leaving the inside alone."""
    return F.regexp_replace(text, f"(?U)^{SPACE}++|{SPACE}++$", "")


def squeeze_lines(text: Column) -> Column:
    """Squeeze every line, drop blank lines and keep the remaining breaks.

    Plain replacements rather than split/transform/join keep this in generated
    code. Most texts need no change at all, which a scan finds out without
    building a new string.
    """
    doubled = ("  ", "\n\n", " \n", "\n ")
    untidy = text.rlike(r"(?U)^[ \n]|[ \n]\z|[^\S\n ]|[\x1c-\x1f]")
    for pair in doubled:
        untidy = text.contains(pair) | untidy
    breaks = F.regexp_replace(text, r"\r|[\x0b\x0c\x1c-\x1e\x85]|\x{2028}|\x{2029}", "\n")
    inline = F.regexp_replace(breaks, r"(?U)[^\S\n]++|\x1f", " ")
    joined = F.regexp_replace(F.regexp_replace(inline, " ++", " "), r" ?\n[ \n]*+", "\n")
    return F.when(untidy, F.btrim(joined, F.lit(" \n"))).otherwise(text)


def comparable(text: Column) -> Column:
    """Lower-cased, squeezed text for loose equality."""
    return F.lower(squeeze(text))


def word_count(text: Column) -> Column:
    words = F.size(F.split(strip(text), f"(?U){SPACE}++"))
    return F.when(text.rlike(f"(?U)[^{SPACE[1:]}"), words).otherwise(F.lit(0))


def has_words(text: Column, least: int) -> Column:
    """At least that many words? Looks no further than it has to."""
    word = f"[^{SPACE[1:]}++"
    return text.rlike(f"(?U)^{SPACE}*+(?:{word}{SPACE}++){{{least - 1}}}{word}")


def money(amount: Column) -> Column:
    """``1234.5`` -> ``$1,234.50``; the sign follows the dollar sign."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def round_exact(number: Column, places: int) -> Column:
    """Round the exact binary value half to even.

    ``round`` works on the shortest decimal text and so turns 2.675 into 2.68;
    ``format_number`` looks at the stored value (2.67499...) and gives 2.67.
    Infinities and NaN stay what they are.
    """
    rounded = F.replace(F.format_number(number, places), F.lit(","), F.lit("")).try_cast("double")
    return F.coalesce(rounded, number.cast("double"))


def parse_number(text: Column) -> Column:
    """``$1,234.56``, ``(500)``, ``12.5%`` ... as a double, else null.

    Only a pair of parentheses negates; a percent sign does not divide. More
    digits than a double holds give an infinity.
    """
    candidate = squeeze(text)
    digits = F.regexp_replace(candidate, r"[()$,%]", "").try_cast("double")
    sign = F.when(candidate.startswith("(") & candidate.endswith(")"), -1.0).otherwise(1.0)
    return F.when(candidate.rlike(NUMBER_PATTERN), round_exact(digits * sign, 6))


def names_a_number(name: Column) -> Column:
    """Does the field name contain any of the financial name parts?"""
    return F.lower(name).rlike("|".join(NUMERIC_NAME_PARTS))


def decision_text(decision: Column, reason: Column) -> Column:
    """The two-line output: a decision and its reason."""
    return F.concat(F.lit("Decision: "), squeeze(decision), F.lit("\nReason: "), squeeze(reason))


def fill(template: str, **values: Column) -> Column:
    """Concat of a sentence with ``{name}`` holes and the columns that fill them; an unknown value prints as such."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if before:
            parts.append(F.lit(before))
        parts.append(F.coalesce(values[name].cast("string"), F.lit("unknown")))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)
