"""Token sequences of bounded length by hierarchical residual packing.

Documents are turned into token ids and cut into pieces of at most one sequence.
Every task packs the pieces it reads by best fit (longest first, into the bin they
leave the least room in) and sends out the bins that are nearly full. The bins that
are left are items themselves: groups of them are packed again, level by level, in
groups of the same size, so the number of groups falls as in a tree. A piece that was sent
out at once needs no join; the others look their place up level by level.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerloom.llm.common import arrow_type, held, named, over_batches, text_of
from ledgerloom.llm.resampling import groups
from ledgerloom.session import checkpointed

CAPACITY = 4096
END_ID = 1
#: A bin with at most this share of its room left is nearly full.
SPARE_SHARE = 1 / 256
#: Items that one best-fit run holds.
GROUP_ITEMS = 65_536
#: Words a Python worker keeps with their ids.
MOST_WORDS = 800_000


class WordIds:
    """Token ids of words, from a tokenizer that treats white space as a border.

    The tokenizer normalises and cuts at white space, so a text's ids are those of
    its words one after another. Words that come again are looked up; the store is
    emptied when it holds ``most_words``.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most_words = most_words
        self._empty()

    def _empty(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.lengths = np.zeros(0, dtype=np.int64)

    def numbered(self, words: list[str]) -> np.ndarray:
        """Each (distinct) word's number in the store, after the tokenizer has been asked for new ones."""
        if len(self.numbers) > self.most_words:
            self._empty()
        known = list(map(self.numbers.get, words))
        new = [word for word, number in zip(words, known, strict=True) if number is None]
        if new:
            found = [one.ids for one in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum()))])
            known = list(map(self.numbers.get, words))
        return np.array(known, dtype=np.int64)

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids end."""
        parts = pc.ascii_split_whitespace(texts)
        coded = pc.list_flatten(parts).dictionary_encode()
        words = self.numbered(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)]
        taken = self.lengths[words]
        ends = np.cumsum(taken)
        where = np.repeat((np.cumsum(self.lengths) - self.lengths)[words] - (ends - taken), taken)
        where += np.arange(len(where))
        word_ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        return self.ids[where], np.concatenate([[0], ends])[word_ends]


def pieces(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``ids`` (``with_ids``) of every piece of every text.

    A text's ids, ended by ``end_id``, are cut only if there are more than
    ``capacity``; null text is empty text and gives the end alone.
    """
    narrow = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema([("id", arrow_type(narrow, "id")), *fields])
    key = ("packing", path)

    def rows(batch: pa.RecordBatch) -> dict:
        words = held(key, lambda: WordIds(path))
        columns: dict = {name: [] for name, _ in fields}
        owner = []
        texts = batch.column("text")
        for first, length in groups(texts):
            ids, ends = words.of_texts(texts.slice(first, length))
            begin = 0
            for row, end in enumerate(ends.tolist(), first):
                own = np.append(ids[begin:end], np.uint32(end_id)).astype("<u4")
                begin = end
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    owner.append(row)
                    columns["piece"].append(piece)
                    columns["start"].append(start)
                    columns["length"].append(len(part))
                    columns["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        columns["ids"].append(part.astype(np.int32))
        return {"id": batch.column("id").take(pa.array(owner, pa.int64())), **columns}

    return narrow.mapInArrow(over_batches(rows, schema, keep=key), from_arrow_schema(schema))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of every item, its place in the bin, and the bins' sizes; longest items first, each where the least room is left."""
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    filled: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r left
    for at, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, len(filled)
            filled.append(0)
        bins[at], places[at] = bin_, filled[bin_]
        filled[bin_] += size
        if room > size:
            with_room[room - size].append(bin_)
            rooms |= 1 << (room - size)
    return bins, places, np.array(filled, dtype=np.int64)


def _number(level: int, part: int, run: int) -> int:
    """First of 2 ** 17 bin numbers that no other run of any level has."""
    return (level << 58) | (part << 37) | (run << 17)


def _packed_locally(items: DataFrame, capacity: int, spare: int, group_items: int) -> DataFrame:
    """``items`` with ``bin``, ``place`` and ``filled`` (the bin's size), packed in runs of ``group_items`` as they are read."""
    result = items.select("*", *[F.lit(0).cast("long").alias(name) for name in ("bin", "place", "filled")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: list[pa.RecordBatch] = []
        number = rows = 0

        def packed() -> pa.RecordBatch:
            whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            bins, places, filled = best_fit(whole.column("length").to_numpy(), capacity)
            return pa.RecordBatch.from_arrays(
                [*whole.columns, pa.array(bins + _number(0, part, number)), pa.array(places), pa.array(filled[bins])],
                names=[*whole.schema.names, "bin", "place", "filled"],
            )

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                slice_ = batch.slice(start, group_items - rows)
                waiting.append(slice_)
                rows += slice_.num_rows
                start += slice_.num_rows
                if rows == group_items:
                    yield packed()
                    waiting, rows, number = [], 0, number + 1
        if rows:
            yield packed()

    return items.mapInArrow(run, result)


def _packed_groups(bins: DataFrame, level: int, groups_: int, capacity: int) -> DataFrame:
    """Bins (``bin``, ``filled``) as items of one best-fit run a group: ``bin``, ``to_bin``, ``place`` and ``size``, the new bin's."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.sort_by("bin")
        to, places, filled = best_fit(table.column("filled").to_numpy(), capacity)
        return pa.table({
            "bin": table.column("bin"), "to_bin": pa.array(to + _number(level, 0, 0) + (group << 20)), "place": pa.array(places),
            "size": pa.array(filled[to]),
        })

    grouped = bins.select("bin", "filled", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups_)).alias("group"))
    return grouped.groupBy("group").applyInArrow(run, "bin long, to_bin long, place long, size long")


def packed(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    spare_share: float = SPARE_SHARE,
    group_items: int = GROUP_ITEMS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all texts (see ``pieces``) with ``sequence_id`` and ``offset``, their place in a sequence of ``capacity`` ids.

    ``path`` names a tokenizer file on every machine. A sequence's pieces follow
    each other from 0 without gaps. Null and empty texts are the end alone; very
    long texts are cut into full pieces, which are sequences of their own, and a
    rest; ids may be null or repeat, every row is a document; an empty table gives
    no rows; other columns are ignored. Equal lengths may take each other's place,
    so sequence numbers are not the same in every run.

    Levels of bins go on until one group holds all that are left, or a level saves
    less than a hundredth of its bins: what then remains does not fit together.
    A group is about ``group_items`` bins, whatever their number.
    """
    spare = int(capacity * spare_share)
    items = checkpointed(pieces(docs, path, id_column, text_column, capacity, end_id, with_ids))
    placed = checkpointed(_packed_locally(items, capacity, spare, group_items))
    open_bins = placed.filter((F.col("filled") < capacity - spare) & (F.col("place") == 0)).select("bin", "filled")
    links, level = [], 0
    count = open_bins.count()
    while count > 1:
        level += 1
        groups_ = -(-count // group_items)
        step = checkpointed(_packed_groups(open_bins, level, groups_, capacity))
        links.append(step)
        open_bins = step.filter((F.col("size") < capacity - spare) & (F.col("place") == 0)).select(
            F.col("to_bin").alias("bin"), F.col("size").alias("filled")
        )
        last, count = count, open_bins.count()
        if groups_ == 1 or count > 0.99 * last:
            break
    final = None
    for step in reversed(links):
        if final is None:
            final = step.select("bin", F.col("to_bin").alias("sequence_id"), "place")
        else:
            above = final.select(F.col("bin").alias("to_bin"), "sequence_id", F.col("place").alias("_above"))
            final = step.join(above, "to_bin", "left").select(
                "bin", F.coalesce("sequence_id", "to_bin").alias("sequence_id"),
                (F.col("place") + F.coalesce("_above", F.lit(0))).alias("place"),
            )
    columns = [*items.columns, "sequence_id", "offset"]
    at_once = F.col("filled") >= capacity - spare
    done = placed.filter(at_once).withColumn("sequence_id", F.col("bin")).withColumn("offset", F.col("place"))
    rest = placed.filter(~at_once)
    if final is None:
        moved = rest.withColumn("sequence_id", F.col("bin")).withColumn("offset", F.col("place"))
    else:
        moved = rest.join(final.withColumnRenamed("place", "_in"), "bin").withColumn("offset", F.col("place") + F.col("_in"))
    return done.select(*columns).unionByName(moved.select(*columns))
