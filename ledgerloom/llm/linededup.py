"""Line dedup by winnowing.

A passage is a run of whole lines with at least ``min_words`` words. A window is
the shortest such run from a line on. Every window selects one of its grams (runs
of about half its words) by least hash, so two equal passages always select an
equal gram: the winnowing guarantee. Only where a selected gram stands more than
once in the corpus are windows looked at. Their positions meet by hash, the first
one stays, and later ones, extended by all overlapping repeated windows on both
sides, are deleted.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_type, named, over_batches, text_of
from ledgerloom.session import checkpointed

MIN_WORDS = 50
_HASH = 8


class Lines:
    """Hashes, numbers of words and line numbers of a text's lines that hold words, packed as bytes."""

    def __init__(self, hashes: bytes, words: bytes, numbers: bytes) -> None:
        self.hashes, self.words, self.numbers = hashes, array("i", words), array("i", numbers)

    def run(self, start: int, end: int) -> int:
        """Hash of a run of lines."""
        digest = xxhash.xxh64_digest(self.hashes[start * _HASH : end * _HASH], 42)
        return int.from_bytes(digest, "big", signed=True)

    def ends(self, wanted: int) -> list[int]:
        """For every line, the end of the shortest run from it with ``wanted`` words; one beyond the last line's end if there is none."""
        words, out, end, held = self.words, [], 0, 0
        count = len(words)
        for start in range(count):
            while held < wanted and end < count:
                held += words[end]
                end += 1
            out.append(end if held >= wanted else count + 1)
            held -= words[start]
        return out

    def starts(self, wanted: int) -> list[int]:
        """For every line, the start of the shortest run up to and with it; -1 if there is none."""
        words, out, start, held = self.words, [], 0, 0
        for own in words:
            held += own
            while held - words[start] >= wanted:
                held -= words[start]
                start += 1
            out.append(start if held >= wanted else -1)
        return out

    def selected(self, min_words: int) -> list[int]:
        """The gram that each window selects, once per place: the first of least hash among those inside the window."""
        count = len(self.words)
        gram_ends, window_ends = self.ends(max(1, min_words // 2)), self.ends(min_words)
        grams = [self.run(at, end) if end <= count else None for at, end in enumerate(gram_ends)]
        places = set()
        for start, end in enumerate(window_ends):
            if end > count:
                break
            best = start
            for at in range(start + 1, end):
                if gram_ends[at] > end:
                    break
                if grams[at] < grams[best]:
                    best = at
            places.add(best)
        return [grams[at] for at in sorted(places)]

    def windows(self, min_words: int, anchors: set[int]) -> list[tuple[int, int, int]]:
        """Hash, first and last line (as in the text) of the shortest runs, from and up to each line, that touch a repeated gram."""
        count = len(self.words)
        touched = [0] * (count + 1)
        for at, end in enumerate(self.ends(max(1, min_words // 2))):
            if end <= count and self.run(at, end) in anchors:
                touched[at] += 1
                touched[end] -= 1
        total, depth, seen = [0], 0, 0
        for at in range(count):
            depth += touched[at]
            seen += depth > 0
            total.append(seen)
        runs = {(start, end) for start, end in enumerate(self.ends(min_words)) if end <= count}
        runs.update((start, last + 1) for last, start in enumerate(self.starts(min_words)) if start >= 0)
        return [
            (self.run(start, end), self.numbers[start], self.numbers[end - 1])
            for start, end in sorted(runs)
            if total[end] > total[start]
        ]


def lines_of(text: str) -> tuple[bytes, bytes, bytes]:
    """Packed lines of a text; white space at a line's ends and its amount between words don't count."""
    hashes, words, numbers = [], array("i"), array("i")
    digest = xxhash.xxh64_digest
    for number, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        parts = line.split()
        if parts:
            hashes.append(digest(b" ".join(parts), 42))
            words.append(len(parts))
            numbers.append(number)
    return b"".join(hashes), words.tobytes(), numbers.tobytes()


def without_lines(text: str, cuts: Iterable[tuple[int, int]]) -> str:
    """The text without the lines of the cuts (first and last line, from 0)."""
    gone = {line for first, last in cuts for line in range(first, last + 1)}
    return "\n".join(line for number, line in enumerate(text.split("\n")) if number not in gone)


def repeated_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Lines to delete: ``id``, ``mark`` (hash of the text) and ``cuts``, an array of (first, last) lines from 0.

    A line goes if it belongs to a run of lines of at least ``min_words`` words
    that also stands earlier: in a row with a smaller (id, text hash), or further
    up in the same text; of runs that overlap, only lines beyond the first run go.
    Lines are equal if their words are.

    Null ids come last. Rows with equal id and text are one document, so they are
    cut alike and not against each other. Null and empty texts have no lines with
    words and are never cut; nor are runs of fewer words, however often they
    stand. An empty table gives no rows. Other columns are ignored.

    The corpus is read once into a table of line hashes. Positions are reduced to
    the first one per window by aggregation, so no list of a repeated window's
    places is ever built, and joins that meet hot windows can be split.
    """
    base = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    lines = base.select("id", "text", F.xxhash64("text").alias("mark"))
    kind = arrow_type(base, "id")
    id_type = base.select("id").schema
    packed = ("hashes", "words", "numbers")
    schema = pa.schema([("id", kind), ("mark", pa.int64()), *[(name, pa.binary()) for name in packed]])

    def read(batch: pa.RecordBatch) -> dict:
        columns = zip(*[lines_of(text) for text in batch.column("text").to_pylist()], strict=True)
        return {"id": batch.column("id"), "mark": batch.column("mark"), **dict(zip(packed, map(list, columns), strict=True))}

    table = checkpointed(
        lines.mapInArrow(
            over_batches(read, schema),
            base.select("id").schema.add("mark", "long").add("hashes", "binary").add("words", "binary").add("numbers", "binary"),
        )
    )
    selected_schema = pa.schema([("id", kind), ("mark", pa.int64()), ("gram", pa.int64())])

    def select(batch: pa.RecordBatch) -> dict:
        ids, marks, grams = [], [], []
        for key, mark, *parts in zip(*[batch.column(name).to_pylist() for name in ("id", "mark", *packed)], strict=True):
            own = Lines(*parts).selected(min_words)
            ids += [key] * len(own)
            marks += [mark] * len(own)
            grams += own
        return {"id": ids, "mark": marks, "gram": grams}

    selected = checkpointed(
        table.mapInArrow(over_batches(select, selected_schema), base.select("id").schema.add("mark", "long").add("gram", "long"))
    )
    repeated = selected.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    anchors = (
        selected.join(repeated, "gram", "left_semi").groupBy("id", "mark").agg(F.collect_set("gram").alias("anchors"))
        .withColumnsRenamed({"id": "anchor_id", "mark": "anchor_mark"})
    )
    once = table.join(
        anchors, F.col("id").eqNullSafe(F.col("anchor_id")) & (F.col("mark") == F.col("anchor_mark"))
    ).select("id", "mark", *packed, "anchors")
    window_schema = pa.schema(
        [("id", kind), ("mark", pa.int64()), ("window", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]
    )

    def look(batch: pa.RecordBatch) -> dict:
        out: list[tuple] = []
        names = ("id", "mark", *packed, "anchors")
        for key, mark, hashes, words, numbers, own in zip(*[batch.column(name).to_pylist() for name in names], strict=True):
            out += [(key, mark, *window) for window in Lines(hashes, words, numbers).windows(min_words, set(own))]
        columns = list(zip(*out, strict=True)) or [()] * 5
        return dict(zip(window_schema.names, map(list, columns), strict=True))

    windows = checkpointed(
        once.mapInArrow(
            over_batches(look, window_schema),
            id_type.add("mark", "long").add("window", "long").add("first", "integer").add("last", "integer"),
        ).distinct()
    )
    place = F.struct(F.col("id").isNull().alias("null_id"), "id", "mark", "first", "last")
    sources = windows.groupBy("window").agg(F.min(place).alias("source"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(sources.select("window", "source"), "window").filter(place > F.col("source"))
    same = F.col("id").eqNullSafe(F.col("source.id")) & (F.col("mark") == F.col("source.mark"))
    begin = F.when(same, F.greatest("first", F.col("source.last") + 1)).otherwise(F.col("first"))
    return (
        later.select("id", "mark", begin.alias("first"), "last")
        .filter(F.col("first") <= F.col("last"))
        .groupBy("id", "mark")
        .agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("cuts"))
    )


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from the text; all other columns and all rows stay.

    See ``repeated_runs``. A text all of whose lines are repeated becomes empty;
    a null text stays null. Column names may be any, since the row travels packed.
    """
    cuts = repeated_runs(docs, id_column, text_column, min_words).withColumnsRenamed({"id": "cut_id", "mark": "cut_mark"})
    packed = docs.select(
        F.struct("*").alias("row"), *named(id=id_column), F.xxhash64(text_of(f"`{text_column}`")).alias("mark")
    )
    joined = packed.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("mark") == F.col("cut_mark")), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if text is None else without_lines(text, zip(first.tolist(), last.tolist(), strict=True))
                for text, first, last in zip(texts, firsts, lasts, strict=True)
            ],
            dtype=object,
        )

    whole = F.col("row").getField(text_column)
    touched = F.when(F.col("cuts").isNotNull(), whole)
    shorter = cut(touched, F.col("cuts.first"), F.col("cuts.last"))
    text = F.when(F.col("cuts").isNull(), whole).otherwise(shorter)
    return joined.select(
        *[(text if name == text_column else F.col("row").getField(name)).alias(name) for name in docs.columns]
    )
