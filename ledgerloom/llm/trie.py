"""Prefix trie of conversations: shared beginnings, who ends where, and sums over subtrees.

Two conversations share a node of depth d if their first d turns are equal. A
prefix is known by a polynomial of its turns' digests modulo 2 ** 127 - 1, which
can be put together from stretches: turns are sorted once over all conversations,
every sorted partition is summed up on its own, and one small record per partition
carries the running value on, so a conversation of any length is spread over tasks.

A node is named by its smallest member and its depth. The nodes of one smallest
member lie on one way down, and ``contraction`` sums subtrees over them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_order, named, text_of
from ledgerloom.llm.contraction import subtree_sums
from ledgerloom.session import checkpointed

PRIME = (1 << 127) - 1
#: Any number without structure serves as the base; digits of pi here.
BASE = 31415926535897932384626433832795028841
WORD = r"[^\x20\x09-\x0D]+"
SHARED_EVERY = 20
MOST_SHARED = 4
#: Ids that are joined into one row before the digest of a node is taken.
CHUNK = 512
#: A parent with more than this share of all nodes as children is looked up in a broadcast of at most 1 / share rows.
HOT_SHARE = 0.001


def shared_turns(conv: str, most: int) -> Column:
    """How many turns a conversation takes from its base: unsigned crc32 of the decimal id, modulo ``most``."""
    return (F.crc32(F.col(conv).cast("string").cast("binary")) % most).cast("int")


def turn_rows(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Narrow turns: ``conv``, ``turn``, ``role``, ``mark`` (16 bytes of a digest of role and text) and ``words``."""
    said, who = text_of(f"`{text}`"), text_of(f"`{role}`")
    together = F.concat(F.length(who).cast("string"), F.lit(":"), who, said)
    return conversations.filter(F.col(f"`{conv}`").isNotNull()).select(
        *named(conv=conv, turn=turn), who.alias("role"),
        F.substring(F.unhex(F.sha2(together.cast("binary"), 256)), 1, 16).alias("mark"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    ).withColumn("conv", F.col("conv").cast("long"))


def with_shared(turns: DataFrame, every: int, most: int) -> DataFrame:
    """All turns, and in front of them (``own`` false) the turns that a conversation takes from its base.

    The first turns of a base are found by a rank limit that is applied before
    the shuffle, so a base of any length sends few rows.
    """
    first = Window.partitionBy("conv").orderBy("turn", "role", "mark")
    heads = (
        turns.filter(F.col("conv") % every == 0).withColumn("at", F.row_number().over(first)).filter(F.col("at") < most)
    ).select(F.col("conv").alias("base"), F.col("at").cast("long").alias("turn"), "role", "mark", "words")
    takers = turns.select("conv").distinct().filter(F.col("conv") % every != 0).select(
        "conv", (F.col("conv") - F.col("conv") % every).alias("base"), shared_turns("conv", most).alias("limit")
    )
    taken = takers.join(heads, "base").filter(F.col("turn") <= F.col("limit"))
    return turns.withColumn("own", F.lit(True)).unionByName(
        taken.select("conv", "turn", "role", "mark", "words").withColumn("own", F.lit(False))
    )


@dataclass
class Stretch:
    """The last conversation of a sorted partition: its turns there, ready to be put behind earlier ones."""

    conv: int
    heads: int = 0
    head_value: int = 0
    first_own: list[int] = field(default_factory=list)
    own: int = 0
    own_value: int = 0


@dataclass(frozen=True)
class Carry:
    """Where a conversation stands at the start of a partition."""

    conv: int | None = None
    depth: int = 0
    value: int = 0
    own: int = 0


def skipped(conv: int, every: int, most: int) -> int:
    """Own turns that the base's turns stand for; Python's and SQL's remainders are zero together."""
    return zlib.crc32(str(conv).encode()) % most if every and conv % every else 0


def put_behind(before: Carry, part: Stretch, skip: int, most: int) -> Carry:
    """The state after a partition's stretch."""
    if before.conv != part.conv:
        before = Carry(part.conv)
    value = (before.value * pow(BASE, part.heads, PRIME) + part.head_value) % PRIME
    depth, own = before.depth + part.heads, before.own
    for mark in part.first_own:
        own += 1
        if own > skip:
            value, depth = (value * BASE + mark) % PRIME, depth + 1
    rest = part.own - len(part.first_own)
    value = (value * pow(BASE, rest, PRIME) + part.own_value) % PRIME
    return Carry(part.conv, depth + rest, value, own + rest)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in ("conv", "own", "mark", "words")), strict=True)


_SUMMARY = "part int, first long, single boolean, conv long, heads long, head_value binary, first_own array<binary>, own long, own_value binary"


def _summaries(rows: DataFrame, most: int) -> DataFrame:
    """One row per sorted partition that is not empty: its first conversation and its last one's stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, part, single = None, None, True
        for conv, own, mark, _ in _rows(batches):
            if part is None or conv != part.conv:
                single = part is None
                part = Stretch(conv)
                first = conv if single else first
            mark = int.from_bytes(mark, "big") % PRIME
            if not own:
                part.heads += 1
                part.head_value = (part.head_value * BASE + mark) % PRIME
            else:
                part.own += 1
                if part.own < most:
                    part.first_own.append(mark)
                else:
                    part.own_value = (part.own_value * BASE + mark) % PRIME
        if part is None:
            return
        wide = lambda value: value.to_bytes(16, "big")
        yield pa.RecordBatch.from_pylist(
            [{
                "part": TaskContext.get().partitionId(), "first": first, "single": single, "conv": part.conv,
                "heads": part.heads, "head_value": wide(part.head_value), "first_own": [wide(mark) for mark in part.first_own],
                "own": part.own, "own_value": wide(part.own_value),
            }],
            schema=pa.schema([
                ("part", pa.int32()), ("first", pa.int64()), ("single", pa.bool_()), ("conv", pa.int64()), ("heads", pa.int64()),
                ("head_value", pa.binary()), ("first_own", pa.list_(pa.binary())), ("own", pa.int64()), ("own_value", pa.binary()),
            ]),
        )

    return rows.mapInArrow(run, _SUMMARY)


def prefix_rows(rows: DataFrame, every: int, most: int) -> DataFrame:
    """Every prefix of every conversation: ``conv``, ``prefix``, ``above`` (null for the whole conversation), ``depth``, ``words``.

    A conversation's turns give one row each; at its end stands one more, with the
    prefix that is the whole conversation and a null ``above``. The driver gets
    one short record per sorted partition.
    """
    sorted_rows = in_order(rows, "conv", "own", "turn", "role", "mark").select("conv", "own", "mark", "words")
    number = lambda raw: int.from_bytes(raw, "big")
    entering: dict[int, Carry] = {}
    following: dict[int, int] = {}
    state, previous = Carry(), None
    for row in sorted(_summaries(sorted_rows, most).collect(), key=lambda row: row["part"]):
        entering[row["part"]] = state
        if previous is not None:
            following[previous] = row["first"]
        part = Stretch(
            row["conv"], row["heads"], number(row["head_value"]), [number(mark) for mark in row["first_own"]], row["own"],
            number(row["own_value"]),
        )
        state = put_behind(state if row["single"] else Carry(), part, skipped(row["conv"], every, most), most)
        previous = row["part"]
    schema = pa.schema([
        ("conv", pa.int64()), ("prefix", pa.binary()), ("above", pa.binary()), ("depth", pa.int64()), ("words", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        now = entering.get(at, Carry())
        conv, depth, value, seen = now.conv, now.depth, now.value, now.own
        skip = 0 if conv is None else skipped(conv, every, most)
        name = lambda: value.to_bytes(16, "big") + depth.to_bytes(8, "big")
        here, out = None, []
        for next_conv, own, mark, words in _rows(batches):
            if here is not None and next_conv != here:
                out.append((here, name(), None, depth, None))
            if next_conv != conv:
                conv, depth, value, seen, skip = next_conv, 0, 0, 0, skipped(next_conv, every, most)
            here = next_conv
            seen += own
            if not own or seen > skip:
                above = name()
                value, depth = (value * BASE + int.from_bytes(mark, "big")) % PRIME, depth + 1
                out.append((conv, name(), above, depth, words))
            if len(out) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if here is not None and following.get(at) != here:
            out.append((here, name(), None, depth, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return sorted_rows.mapInArrow(run, "conv long, prefix binary, above binary, depth long, words long")


def ends_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``prefix`` and ``ends_sha256`` of its conversations' decimal ids in ascending order, joined by commas.

    Ids are sorted and joined in chunks by all tasks. A digest has to be fed in
    order, so one task reads the chunks of a node one by one, without holding them.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("prefix", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        prefix, ids = None, []
        for batch in batches:
            out = []
            for own, conv in zip(batch.column("prefix").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if ids and (own != prefix or len(ids) >= chunk):
                    out.append({"prefix": prefix, "first": ids[0], "ids": ",".join(map(str, ids))})
                    ids = []
                prefix = own
                ids.append(conv)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if ids:
            yield pa.RecordBatch.from_pylist([{"prefix": prefix, "first": ids[0], "ids": ",".join(map(str, ids))}], schema=schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("prefix", pa.binary()), ("ends_sha256", pa.string())])
        prefix, digest = None, None
        for batch in batches:
            out = []
            for own, ids in zip(batch.column("prefix").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own == prefix:
                    digest.update(b",")
                else:
                    if prefix is not None:
                        out.append({"prefix": prefix, "ends_sha256": digest.hexdigest()})
                    prefix, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if prefix is not None:
            yield pa.RecordBatch.from_pylist([{"prefix": prefix, "ends_sha256": digest.hexdigest()}], schema=schema)

    joined = (
        ends.repartitionByRange("prefix", "conv").sortWithinPartitions("prefix", "conv")
        .mapInArrow(chunks, "prefix binary, first long, ids string")
    )
    return joined.repartition("prefix").sortWithinPartitions("prefix", "first").mapInArrow(digests, "prefix binary, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``up``, the smallest member of the parent; parents of very many children by a broadcast of bounded size."""
    total = nodes.count()
    names = nodes.filter(F.col("kids") > 0).select(F.col("prefix").alias("above"), F.col("conv").alias("up"), "kids")
    hot = names.filter(F.col("kids") > HOT_SHARE * total).drop("kids")
    met = nodes.join(F.broadcast(hot.withColumnRenamed("up", "_up")), "above", "left")
    cold = met.filter(F.col("_up").isNull() & F.col("above").isNotNull()).drop("_up").join(names.drop("kids"), "above")
    done = met.filter(F.col("_up").isNotNull() | F.col("above").isNull()).withColumnRenamed("_up", "up")
    return done.unionByName(cold)


def conversation_trie(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    shared_every: int = SHARED_EVERY,
    most_shared: int = MOST_SHARED,
) -> DataFrame:
    """One row per distinct beginning of the conversations, from the empty one on.

    Turns are ordered by turn, null first; turns of one number by role, then by
    the digest of role and text; repeated rows each count as a turn. A null
    role or text is empty. A conversation c takes the first h = crc32(c) %
    ``most_shared`` turns of conversation c - c % ``shared_every`` (all if there
    are fewer, none if it is absent) in place of its own first h; with
    ``shared_every`` 0 conversations stay as they are. % has the sign of c.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null
    for the root), ``n_convs``, ``n_children``, ``n_leaves`` and
    ``saved_tokens`` summed over the subtree, ``ends_sha256`` and ``prefix``, the
    node's key. A conversation left without turns is a member of the root. Rows without
    a conversation id belong to none. An empty table gives no rows. Other columns
    are ignored. Very long texts are read once, in the JVM, and only their digests
    and word counts go on.
    """
    turns = turn_rows(conversations, conv_column, turn_column, role_column, text_column)
    rows = with_shared(turns, shared_every, most_shared) if shared_every else turns.withColumn("own", F.lit(True))
    prefixes = checkpointed(prefix_rows(rows, shared_every, most_shared))
    whole = prefixes.filter(F.col("above").isNull())
    root = F.lit(bytes(24))
    sums = (
        prefixes.filter(F.col("above").isNotNull()).groupBy("prefix")
        .agg(F.min("above").alias("above"), F.min("depth").alias("depth"), F.min("conv").alias("conv"),
             F.count("*").alias("n_convs"), F.min("words").alias("words"))
        .unionByName(
            whole.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter(F.col("n_convs") > 0).select(
                root.alias("prefix"), F.lit(None).cast("binary").alias("above"), F.lit(0).cast("long").alias("depth"), "conv",
                "n_convs", F.lit(0).cast("long").alias("words"),
            )
        )
    )
    sums = checkpointed(sums)
    kids = sums.filter(F.col("above").isNotNull()).groupBy(F.col("above").alias("prefix")).agg(F.count("*").alias("kids"))
    counted = checkpointed(sums.join(kids, "prefix", "left").withColumn("kids", F.coalesce("kids", F.lit(0))))
    nodes = checkpointed(_with_parents(counted))
    forest = nodes.select(
        F.col("conv").alias("path"), "depth", "up", (F.col("depth") - 1).alias("up_depth"), "kids",
        F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    below = subtree_sums(forest, ("n_leaves", "saved_tokens")).withColumnRenamed("path", "conv")
    ends = ends_digests(whole.select("prefix", "conv"))
    return (
        nodes.join(below, ["conv", "depth"]).join(ends, "prefix", "left").select(
            F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs",
            F.col("kids").alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), F.hex("prefix").alias("prefix"),
        )
    )
