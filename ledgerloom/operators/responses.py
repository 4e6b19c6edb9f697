"""Free-text responses -> decision, explanation, confidence."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.json_text import indented, plain_json
from ledgerloom.functions.labels import (
    CONFIDENCE_PATTERN,
    DECISION_PATTERN,
    REASON_PATTERN,
    bucket_of_canonical,
    canonical_label,
    confidence,
)
from ledgerloom.functions.text import round_exact, squeeze
from ledgerloom.operators.render import SYSTEM_TEXT, prompt


def _found(text: Column, pattern: str) -> Column:
    """First group of the first match, null without one (the group is never empty)."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def raw_decision(text: Column) -> Column:
    """Canonical label of a response; a missing one (or a missing text) is UNKNOWN."""
    return F.coalesce(
        canonical_label(_found(F.coalesce(text, F.lit("")), DECISION_PATTERN)), F.lit("UNKNOWN")
    )


def explanation(text: Column) -> Column:
    """The reason line, or the whole text when there is none."""
    whole = F.coalesce(text, F.lit(""))
    return squeeze(F.coalesce(_found(whole, REASON_PATTERN), whole))


def parsed(df: DataFrame, text: str) -> DataFrame:
    """Add ``raw_decision, decision, reason, explanation, confidence``."""
    response = F.coalesce(F.col(text), F.lit(""))
    stated = round_exact(_found(response, CONFIDENCE_PATTERN).try_cast("double"), 4)
    return (
        df.withColumn("raw_decision", raw_decision(F.col(text)))
        .withColumn("decision", bucket_of_canonical(F.col("raw_decision")))
        .withColumn("explanation", explanation(F.col(text)))
        .withColumn("reason", F.col("explanation"))
        .withColumn(
            "confidence", F.coalesce(stated, confidence(F.col("raw_decision"), F.col("explanation")))
        )
    )


def clamped(score: Column) -> Column:
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def shown_context(requests: DataFrame) -> Column:
    """Indented text of a request's context, its values as given; null if it can't be read.

    A struct is written as JSON, nulls included, so that the same request gives
    the same prompt as a struct and as JSON text. Structs, arrays and maps are
    written by one generated expression; JSON text goes through Python.
    """
    kind = requests.schema["context"].dataType
    context = F.col("context")
    written = plain_json("context", kind)
    if written is not None:
        return written
    if not isinstance(kind, T.StringType):
        context = F.to_json(context, {"ignoreNullFields": "false"})
    return indented(context)


def request_prompt(requests: DataFrame, system_text: str = SYSTEM_TEXT) -> Column:
    """Prompt of an (instruction, context) request; null without either or with an unreadable context."""
    return prompt(F.col("instruction"), shown_context(requests), system_text)


# What a guarded model gives back.
ANSWER = T.StructType([T.StructField("response", T.StringType()), T.StructField("error", T.StringType())])


class _Tally:
    """Prompts settled alone or in a group, and how many of them failed; older ones count less and less."""

    #: Settled prompts after which both counts are halved.
    MEMORY = 4096

    def __init__(self) -> None:
        self.settled = self.failed = 0.0

    def add(self, settled: int, failed: int) -> None:
        self.settled += settled
        self.failed += failed
        if self.settled > self.MEMORY:
            self.settled /= 2
            self.failed /= 2

    def reach(self, most: int) -> int:
        """Prompts in the next group, so that it fails about every second time."""
        if self.failed * most <= 0.6 * self.settled:
            return most
        return max(1, int(0.6 * self.settled / self.failed))


def _attempted(answer: Callable[[pd.Series], pd.Series], prompts: pd.Series, tally: _Tally) -> pd.DataFrame:
    """Responses of a batch; a group that fails is halved until the prompts that fail stand alone."""
    places: dict = {}
    at = [places.setdefault(prompt, len(places)) for prompt in prompts]
    distinct = pd.Series(list(places), dtype=object)
    size = len(distinct)
    said: list = [None] * size
    errors: list = [None] * size
    waiting = [(0, size)] if size else []
    while waiting:
        start, last = waiting.pop()
        end = start + tally.reach(last - start)
        if end < last:
            waiting.append((end, last))
        try:
            found = list(answer(distinct.iloc[start:end]))
            if len(found) != end - start:
                raise ValueError(f"{len(found)} responses for {end - start} prompts")
            said[start:end] = found
            tally.add(end - start, 0)
        except Exception as problem:  # a user's model may raise anything
            if end - start > 1:
                half = (start + end) // 2
                waiting += [(half, end), (start, half)]
            else:
                errors[start] = f"{type(problem).__name__}: {problem}"
                tally.add(1, 1)
    return pd.DataFrame({"response": [said[i] for i in at], "error": [errors[i] for i in at]}, dtype=object)


def guarded(answer: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """A function from prompts to responses as a model for ``decide`` whose exceptions become errors of their rows.

    ``answer`` gets a batch of prompts, equal ones once. If it raises, or gives
    back another number of responses, the batch is tried again in halves, and the
    next groups of a task are as large as the share of failures so far lets
    about every second one pass: rare failures cost a logarithm of calls each,
    frequent ones hardly more than a call a prompt. The rest still get their
    responses. It must therefore give the same response to a prompt in any batch.
    """

    @F.pandas_udf(ANSWER)
    def said(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tally = _Tally()
        for prompts in batches:
            yield _attempted(answer, prompts, tally)

    return said


def decide(
    requests: DataFrame,
    generate: Callable[[Column], Column],
    system_text: str = SYSTEM_TEXT,
) -> DataFrame:
    """Requests -> ``decision, explanation, confidence``.

    ``generate`` maps prompt to response text, normally a pandas UDF around a
    model, or to a struct of ``response`` and ``error`` as ``guarded`` does. A
    model that raises ends the job unless it is guarded. Nothing here keeps state, so batch and streaming frames both work. A
    request that can't be read does not end the job: ``error`` says what is
    wrong (null otherwise), the model is given an empty prompt for it, and what
    it answers is not used, so the decision is that of an empty response.
    """
    shown = requests.withColumn("_shown", shown_context(requests))
    error = (
        F.when(F.col("instruction").isNull(), "instruction is missing")
        .when(F.col("context").isNull(), "context is missing")
        .when(F.col("_shown").isNull(), "context is not JSON or nested too deeply")
    )
    asked = shown.withColumn("error", error).withColumn(
        "_prompt", F.coalesce(prompt(F.col("instruction"), F.col("_shown"), system_text), F.lit(""))
    )
    said = asked.withColumn("_said", generate(F.col("_prompt")))
    response, failed = F.col("_said"), F.lit(None).cast("string")
    if isinstance(said.schema["_said"].dataType, T.StructType):
        response, failed = F.col("_said.response"), F.concat(F.lit("model failed: "), F.col("_said.error"))
    answered = said.withColumn("response", F.when(F.col("error").isNull(), response)).withColumn(
        "error", F.coalesce("error", failed)
    )
    return (
        parsed(answered, "response")
        .withColumn("confidence", clamped(F.col("confidence")))
        .drop("raw_decision", "reason", "response", "_shown", "_prompt", "_said")
    )
