"""Whole-file JSON of any size, read in byte ranges instead of by one task per file.

A JSON list has no split points, but its text can be cut at every ``}``: Spark
reads it as lines that end there, in splits, by all tasks. What a split lacks is
where in the document it starts, and that composes from left to right:

1. the number of quotes in a split says whether it ends inside a string, so the
   running parity tells each split how it begins;
2. with that, a split's effect on the stack of open brackets is how many of the
   brackets before it are closed and which new ones stay open. These effects
   (one narrow row a split) are composed per file into the stack at each start;
3. every split hands out the objects it holds. Only objects that cross the end of
   a split are put together from parts, so at most two parts a split are shuffled.

A task holds one batch of pieces and one object at a time, never a document.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.scale import is_small
from ledgerloom.session import checkpointed

#: Splits whose starts are broadcast: one short row each, measured before.
MAX_SPLITS = 1_000_000

_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*("?)|[{}\[\]]', re.S)
_REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*("?)', re.S)

_OPEN = "array<struct<kind string, key string, block bigint, offset bigint>>"
_OUTLINE = f"file_path string, block_start bigint, closed bigint, opened {_OPEN}"
_START = f"file_path string, block_start bigint, stack {_OPEN}"
_PART = (
    "file_path string, item_block bigint, item_offset bigint, part_block bigint, region_block bigint, "
    "region_offset bigint, place bigint, key string, root string, record string, whole boolean"
)


def brackets(piece: str, in_string: bool) -> tuple[list[tuple[str, int, str]], bool]:
    """The brackets of a piece outside strings, as (bracket, place, key before it), and whether it ends in a string."""
    found, start, literal = [], 0, (0, 0)
    if in_string:
        rest = _REST_OF_STRING.match(piece)
        if not rest.group(1):
            return found, True
        start = rest.end()
    for token in _TOKEN.finditer(piece, start):
        mark = token.group()[0]
        if mark == '"':
            if not token.group(1):
                return found, True
            literal = token.span()
        else:
            key = ""
            if mark in "[{" and literal[1] and piece[literal[1] : token.start()].strip() == ":":
                key = json.loads(piece[slice(*literal)], strict=False)
            found.append((mark, token.start(), key))
    return found, False


def _matching(opened: str, mark: str, path: str) -> None:
    if (opened, mark) not in (("{", "}"), ("[", "]")):
        raise ValueError(f"malformed JSON: {opened} closed by {mark} in {path}")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[str]]]:
    """The pieces of each split, split by split, with the facts joined to its rows."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    for _, members in groupby(rows(), key=lambda row: (row["file_path"], row["block_start"])):
        first = next(members)

        def pieces(first: dict = first, members: Iterator[dict] = members) -> Iterator[str]:
            yield first["piece"]
            for row in members:
                yield row["piece"]

        yield first, pieces()


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for split, pieces in _splits(batches):
        path, block, inside = split["file_path"], split["block_start"], split["in_string"]
        closed, opened, offset = 0, [], 0
        for piece in pieces:
            found, inside = brackets(piece, inside)
            for mark, at, key in found:
                if mark in "[{":
                    opened.append({"kind": mark, "key": key, "block": block, "offset": offset + at})
                elif opened:
                    _matching(opened.pop()["kind"], mark, path)
                else:
                    closed += 1
            offset += len(piece)
        yield pa.RecordBatch.from_pylist(
            [{"file_path": path, "block_start": block, "closed": closed, "opened": opened}], _schema_of(_OUTLINE)
        )


def _schema_of(fields: str) -> pa.Schema:
    """Arrow schema of the flat or bracket-list columns named here."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    entry = pa.struct([("kind", pa.string()), ("key", pa.string()), ("block", pa.int64()), ("offset", pa.int64())])
    flat = fields.replace(_OPEN, "open")
    named = [field.split(" ") for field in flat.split(", ")]
    return pa.schema([(name, pa.list_(entry) if kind == "open" else kinds[kind]) for name, kind in named])


def _starts(outlines: pd.DataFrame) -> pd.DataFrame:
    """The stack at the start of each split of one file; its splits only, a short row each."""
    stack: list[dict] = []
    starts = []
    for row in outlines.sort_values("block_start").itertuples():
        starts.append({"file_path": row.file_path, "block_start": row.block_start, "stack": list(stack)})
        if row.closed > len(stack):
            raise ValueError(f"malformed JSON: more brackets closed than opened in {row.file_path}")
        stack = stack[: len(stack) - row.closed] + [dict(entry) for entry in row.opened]
    if stack:
        raise ValueError(f"malformed JSON: brackets left open in {outlines['file_path'].iloc[0]}")
    return pd.DataFrame(starts, columns=["file_path", "block_start", "stack"])


def _level(stack: list[dict]) -> int:
    """At which depth an object is an item: in a list at the top, or in a list under a key of an object."""
    return 1 if stack and stack[0]["kind"] == "[" else 2


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items, parts of items, and (without text) the lists that hold them."""
    schema = _schema_of(_PART)
    for split, pieces in _splits(batches):
        path, block, inside = split["file_path"], split["block_start"], split["in_string"]
        stack, offset, held, kept, out, size = list(split["stack"]), 0, {}, [], [], 0

        def row(item: dict | None, text: str | None, whole: bool, region: dict) -> dict:
            own = item is not None and item["block"] == block
            return {
                "file_path": path, "part_block": block, "whole": whole, "record": text,
                "item_block": item and item["block"], "item_offset": item and item["offset"],
                "region_block": region["block"], "region_offset": region["offset"],
                "place": item["place"] if own else None, "key": region["key"], "root": stack[0]["kind"],
            }

        for piece in pieces:
            depth = _level(stack)
            item = stack[depth] if len(stack) > depth and stack[depth]["kind"] == "{" and stack[depth - 1]["kind"] == "[" else None
            begin = 0
            found, inside = brackets(piece, inside)
            for mark, at, key in found:
                if mark in "[{":
                    entry = {"kind": mark, "key": key, "block": block, "offset": offset + at}
                    stack.append(entry)
                    depth = _level(stack)
                    if len(stack) == depth and mark == "[":
                        out.append(row(None, None, True, entry))
                    elif len(stack) == depth + 1 and mark == "{" and stack[depth - 1]["kind"] == "[":
                        region = (stack[depth - 1]["block"], stack[depth - 1]["offset"])
                        entry["place"] = held[region] = held.get(region, -1) + 1
                        item, begin = entry, at
                else:
                    if not stack:
                        raise ValueError(f"malformed JSON: more brackets closed than opened in {path}")
                    if item is not None and len(stack) == depth + 1:
                        kept.append(piece[begin : at + 1])
                        size += sum(map(len, kept))
                        out.append(row(item, "".join(kept), item["block"] == block, stack[depth - 1]))
                        item, kept = None, []
                    _matching(stack.pop()["kind"], mark, path)
            if item is not None:
                kept.append(piece[begin:])
            offset += len(piece)
            if size > 1 << 22 or len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if item is not None:
            out.append(row(item, "".join(kept), False, stack[_level(stack) - 1]))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)


def _in_order(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts per split joined to its rows by a broadcast, which leaves the order of rows alone."""
    if not is_small(facts, MAX_SPLITS):
        raise ValueError("too many splits of whole-file JSON for one read; write JSONL instead")
    return rows.join(F.broadcast(facts), ["file_path", "block_start"])


def _quotes(value: Column) -> Column:
    """How many quotes of a text are not escaped."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    return F.length(plain) - F.length(F.replace(plain, F.lit('"')))


def list_items(spark: SparkSession, pieces: DataFrame, wrappers: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The record objects of JSON documents, and the files that have none by their form.

    ``pieces`` are the texts of the documents cut behind every ``}`` (``value``,
    without it), with ``file_path, block_start, sequence, file_size``. The first
    result has ``record, file_path, record_ord``: the objects of a list at the
    top; of an object, those of the list under the first of ``wrappers`` that
    holds a list (even an empty one), else those of all its lists. The second has
    the ``file_path`` of each document that is an object with neither; such a
    document is one record itself. A document without brackets gives nothing.

    Brackets that do not match fail the job, and so does an object that is not
    JSON; what stands between objects is only looked at for brackets and strings.
    A key twice in one object counts as two lists.
    """
    ended = F.octet_length("value") + 1
    splits = checkpointed(
        pieces.groupBy("file_path", "block_start").agg(
            F.sum(_quotes(F.col("value"))).alias("quotes"), F.sum(ended.cast("bigint")).alias("bytes"),
            F.max("sequence").alias("last"), F.max("file_size").alias("file_size"),
        )
    )
    of_file = Window.partitionBy("file_path")
    along = of_file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    #: One byte more than the file has: no bracket behind its last piece.
    unended = (F.sum("bytes").over(of_file) > F.col("file_size")) & (
        F.col("block_start") == F.max("block_start").over(of_file)
    )
    begun = checkpointed(
        splits.select(
            "file_path", "block_start", (F.coalesce(F.sum("quotes").over(along), F.lit(0)) % 2 == 1).alias("in_string"),
            F.when(unended, F.col("last")).alias("unended"),
        )
    )
    closing = F.when(F.col("sequence").eqNullSafe(F.col("unended")), F.lit("")).otherwise(F.lit("}"))
    ready = _in_order(pieces, begun).select("file_path", "block_start", "in_string", F.concat("value", closing).alias("piece"))
    outlines = checkpointed(ready.mapInArrow(_outlines, _OUTLINE))
    starts = checkpointed(outlines.groupBy("file_path").applyInPandas(_starts, _START))
    parts = checkpointed(_in_order(ready, starts).mapInArrow(_parts, _PART))

    at_top = F.col("root") == "["
    rank = F.array_position(F.array(*[F.lit(key) for key in wrappers]), F.col("key"))
    files = checkpointed(
        parts.groupBy("file_path").agg(
            F.min(F.when(~at_top & (rank > 0), rank)).alias("_rank"),
            F.max(at_top | (rank > 0) | F.col("item_block").isNotNull()).alias("_listed"),
        )
    )
    objects = outlines.filter("block_start = 0").select("file_path")
    whole = objects.join(files.filter("_listed").select("file_path"), "file_path", "left_anti")

    facts = ("region_block", "region_offset", "place", "key", "root")
    item = ("file_path", "item_block", "item_offset")
    items = parts.filter(F.col("item_block").isNotNull())
    pieced = (
        items.filter(~F.col("whole")).groupBy(*item)
        .agg(
            F.array_sort(F.collect_list(F.struct("part_block", "record"))).alias("_parts"),
            *[F.max(name).alias(name) for name in facts],
        )
        .withColumn("record", F.array_join(F.col("_parts.record"), ""))
    )
    every = items.filter("whole").select(*item, *facts, "record").unionByName(pieced.select(*item, *facts, "record"))
    small = is_small(files, MAX_SPLITS)
    counted = every.join(F.broadcast(files) if small else files, "file_path")
    wanted = checkpointed(counted.filter(at_top | F.col("_rank").isNull() | (rank == F.col("_rank"))).drop("_rank", "_listed"))

    spot = ("file_path", "item_block", "region_block", "region_offset")
    counts = wanted.groupBy(*spot).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("file_path").orderBy(*spot[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpointed(counts.select(*spot, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    met = wanted.join(F.broadcast(offsets) if is_small(offsets, MAX_SPLITS) else offsets, list(spot))
    compact = F.from_json(F.concat(F.lit("["), F.col("record"), F.lit("]")), "array<string>", {"mode": "FAILFAST"})
    return (
        met.select(compact[0].alias("record"), "file_path", (F.col("_before") + F.col("place")).alias("record_ord")),
        whole,
    )
