"""Benchmark decontamination by the q-gram lemma.

An item of m characters that occurs in a text with at most k edits shares at
least m - q + 1 - kq of its q-grams with it, and their diagonals (place in the
text less place in the item) span at most k. Shared q-grams are therefore counted
per item in bands of diagonals that overlap by k; bands that reach the bound are
verified by an alignment confined to the band. Items of fewer than q characters
have no q-gram; they are found without edits, as whole words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_type, named, over_batches, text_of

Q = 10
EDITS = 0.07
BLOCK_CHARS = 2_000_000
_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_MARKS = re.compile(r"[\W_]+")
_STEP_CHARS = 4_000_000


def normal(text: str) -> str:
    """Lower case; everything but letters and digits is a single space."""
    return _MARKS.sub(" ", text.lower()).strip()


def _folded(text: str) -> bytes:
    """One byte per character; different characters may share a byte, which only adds candidates."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return ((codes & 0x7F) | ((codes > 0x7F) << 7)).astype(np.uint8).tobytes()


def _grams(data: bytes, q: int) -> np.ndarray:
    """A key for every q consecutive bytes (8 <= q <= 16)."""
    if len(data) < q:
        return np.zeros(0, dtype=np.uint64)
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    count = len(data) - q + 1
    return (eight[:count] * _MIX) ^ (eight[q - 8 : q - 8 + count] * _OTHER)


@dataclass
class Index:
    """The q-grams of a block of items, and for each the items and places where it stands."""

    items: list[str]
    q: int
    share: float

    def __post_init__(self) -> None:
        self.lengths = np.array([len(item) for item in self.items], dtype=np.int64)
        # short items get as many edits as still leave the bound at one q-gram or more
        self.budgets = np.array([self.budget(length) for length in self.lengths], dtype=np.int64)
        self.bounds = np.maximum(1, self.lengths - self.q + 1 - self.budgets * self.q)
        keys, items, places = [], [], []
        for number, item in enumerate(self.items):
            key = _grams(_folded(item), self.q)
            keys.append(key)
            items.append(np.full(len(key), number, dtype=np.int64))
            places.append(np.arange(len(key), dtype=np.int64))
        keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.starts, self.counts = np.unique(keys[order], return_index=True, return_counts=True)
        self.item = np.concatenate(items)[order] if items else np.zeros(0, dtype=np.int64)
        self.place = np.concatenate(places)[order] if items else np.zeros(0, dtype=np.int64)
        self.taken = np.zeros(1 << _BITS, dtype=bool)
        self.taken[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX) >> np.uint64(64 - _BITS)

    def budget(self, length: int) -> int:
        return max(0, min(int(self.share * length), (length - self.q) // self.q))

    def candidates(self, data: bytes) -> list[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the bands that reach the bound."""
        keys = _grams(data, self.q)
        at = np.flatnonzero(self.taken[self._slot(keys)])
        if not len(at) or not len(self.keys):
            return []
        slot = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        same = self.keys[slot] == keys[at]
        at, slot = at[same], slot[same]
        counts = self.counts[slot]
        first = np.repeat(self.starts[slot], counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        item, place = self.item[first + inner], self.place[first + inner]
        diagonal = np.repeat(at, counts) - place + int(self.lengths.max())
        width = self.budgets[item] + 1
        band = diagonal // width
        found = []
        for shift in (0, 1):  # band b covers diagonals [b * width, (b + 2) * width)
            found.append(item * (1 << 40) + band - shift)
        keys, counted = np.unique(np.concatenate(found), return_counts=True)
        item = (keys + 1) >> 40
        band = keys - item * (1 << 40)
        good = counted >= self.bounds[item]
        width = self.budgets[item] + 1
        low = band * width - int(self.lengths.max())
        return list(zip(item[good].tolist(), low[good].tolist(), (low + 2 * width)[good].tolist(), strict=True))


def aligned(item: np.ndarray, region: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """Fewest edits that turn the item into a piece of ``region``, and where the piece ends.

    Only diagonals ``low`` to ``high`` (place in region less place in item) are
    visited; the piece may start and end anywhere on them.
    """
    far = len(item) + len(region)
    span = np.arange(high - low + 1)
    row = np.where((span + low >= 0) & (span + low <= len(region)), 0, far)
    for i, letter in enumerate(item, 1):
        j = span + low + i
        inside = (j >= 1) & (j <= len(region))
        same = np.zeros(len(span), dtype=bool)
        same[inside] = region[j[inside] - 1] == letter
        step = np.minimum(np.where(inside, row + ~same, far), np.append(row[1:], far) + 1)
        step = np.where((j >= 0) & (j <= len(region)), step, far)
        row = np.minimum.accumulate(step - span) + span
        row = np.where((j >= 0) & (j <= len(region)), row, far)
    best = int(row.argmin())
    return int(row[best]), int(best + low + len(item))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def occurrences(texts: list[str], index: Index) -> list[list[tuple[int, int, int, int]]]:
    """Per normalised text: (item, edits, start, end) of the best occurrence of every item found."""
    data = [_folded(text) for text in texts]
    gap = bytes(index.q)
    starts = np.cumsum([0, *[len(part) + index.q for part in data]])
    best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    for item, low, high in index.candidates(gap.join(data)) if texts else []:
        middle = max(0, (low + high) // 2)
        for at in {int(np.searchsorted(starts, x, "right")) - 1 for x in (max(0, low), middle, max(0, high))}:
            if not 0 <= at < len(texts):
                continue
            text, letters = texts[at], index.items[item]
            if best[at].get(item, (1,))[0] == 0:
                continue
            budget = int(index.budgets[item])
            left = max(0, low - int(starts[at]) - budget)
            right = min(len(text), high - int(starts[at]) + len(letters) + budget)
            if right - left < len(letters) - budget:
                continue
            whole = text.find(letters, left, right)
            if whole >= 0:  # an occurrence without edits needs no alignment
                best[at][item] = (0, whole, whole + len(letters))
                continue
            region, wanted = _codes(text[left:right]), _codes(letters)
            edits, end = aligned(wanted, region, low - int(starts[at]) - left - budget, high - int(starts[at]) - left + budget)
            if edits > budget:
                continue
            back = region[:end][::-1]
            _, length = aligned(wanted[::-1], back, -budget, budget)
            found = (edits, left + end - length, left + end)
            if item not in best[at] or found < best[at][item]:
                best[at][item] = found
    return [[(item, *found) for item, found in sorted(per.items())] for per in best]


class ShortItems:
    """Items too short for a q-gram, in one automaton, with a space at both ends."""

    def __init__(self, items: dict[int, str]) -> None:
        numbers: dict[str, list[int]] = {}
        for number, item in items.items():
            numbers.setdefault(item, []).append(number)
        self.automaton = ahocorasick.Automaton()
        for item, found in numbers.items():
            self.automaton.add_word(f" {item} ", (len(item), found))
        self.automaton.make_automaton()
        self.any = bool(numbers)

    def occurrences(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of each item's first place in a normal text."""
        first: dict[int, tuple[int, int, int, int]] = {}
        if self.any:
            for last, (length, numbers) in self.automaton.iter(f" {text} "):
                start = last - length - 1
                for number in numbers:
                    first.setdefault(number, (number, 0, start, start + length))
        return [first[number] for number in sorted(first)]


@lru_cache(maxsize=1)
def _index(items: tuple[str, ...], q: int, share: float) -> tuple[Index, list[int], ShortItems]:
    """What finds the items of ``q`` and more characters, their numbers, and what finds the shorter ones."""
    long = [number for number, item in enumerate(items) if len(item) >= q]
    short = {number: item for number, item in enumerate(items) if len(item) < q}
    return Index([items[number] for number in long], q, share), long, ShortItems(short)


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    q: int = Q,
    edits: float = EDITS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per row of ``docs`` and benchmark item that occurs in it: ``id``, ``item``, ``edits``, ``start``, ``end``.

    Texts and items are compared in normal form (lower case, runs of other than
    letters and digits as one space); ``start`` and ``end`` count characters of
    the document's normal form. An item occurs if at most ``edits`` times its
    length separates it from a piece of the text; short items get fewer, so that
    the q-gram bound stays positive. Items of under ``q`` characters occur where
    their words stand whole and without edits.

    The items are sent to the tasks in blocks of about ``block_chars`` characters,
    one pass over the documents each, whatever their number. Documents stay where
    they are, so copies and hot sources make no difference. Null or empty texts
    contain nothing and null items are skipped; null ids come back as they are;
    repeated rows and items each get their rows. Empty tables give no rows. Other
    columns are ignored.
    """
    narrow = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    items = benchmark.select(*named(item=item_column), text_of(f"`{item_text_column}`").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_chars))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    schema = pa.schema(
        [("id", arrow_type(narrow, "id")), ("item", arrow_type(items, "item")), ("edits", pa.int32()),
         ("start", pa.int64()), ("end", pa.int64())]
    )
    result = narrow.select("id").schema.add("item", items.schema["item"].dataType).add("edits", "integer").add("start", "long").add("end", "long")
    found = None
    for number in range(blocks):
        rows_of = [(row["item"], normal(row["text"])) for row in items.filter(block == number).collect()]
        rows_of = sorted(((name, text) for name, text in rows_of if text), key=lambda row: (str(row[0]), row[1]))
        shared = docs.sparkSession.sparkContext.broadcast(rows_of)

        def rows(batch: pa.RecordBatch, shared=shared) -> dict:
            index, long, short = _index(tuple(text for _, text in shared.value), q, edits)
            names = [name for name, _ in shared.value]
            ids = batch.column("id").to_pylist()
            texts = [normal(text) for text in batch.column("text").to_pylist()]
            out: list[tuple] = []
            start = 0
            while start < len(texts):  # so many characters at a time that arrays stay small
                end, chars = start, 0
                while end < len(texts) and (end == start or chars + len(texts[end]) <= _STEP_CHARS):
                    chars += len(texts[end])
                    end += 1
                for at, hits in enumerate(occurrences(texts[start:end], index), start):
                    out += [(ids[at], names[long[item]], *rest) for item, *rest in hits]
                    out += [(ids[at], names[item], *rest) for item, *rest in short.occurrences(texts[at])]
                start = end
            columns = list(zip(*out, strict=True)) or [()] * 5
            return dict(zip(schema.names, map(list, columns), strict=True))

        part = narrow.mapInArrow(over_batches(rows, schema), result)
        found = part if found is None else found.unionByName(part)
    return found


def clean(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options: object
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, all columns kept; null and empty texts stay.

    Rows are told by id and text hash, so a row goes exactly if its own text holds an item.
    """
    key = F.struct(F.col(f"`{id_column}`").alias("id"), F.xxhash64(text_of(f"`{text_column}`")).alias("mark"))
    keyed = docs.select(key.alias("key"), text_of(f"`{text_column}`").alias("text"))
    found = contaminations(keyed, benchmark, "key", "text", **options).select("id.id", "id.mark").distinct()
    packed = docs.select(F.struct("*").alias("row"), key.alias("key"))
    kept = packed.join(
        found, F.col("key.id").eqNullSafe(found["id"]) & (F.col("key.mark") == found["mark"]), "left_anti"
    )
    return kept.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
