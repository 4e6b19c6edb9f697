"""SimHash near-duplicates by a binary trie joined with itself.

Fingerprints are the leaves of a binary trie over their 64 bits. Two nodes of
equal depth are visited together, the bits in which their prefixes differ are
added up, and a pair of nodes is dropped as soon as the sum exceeds the budget.
The top of the trie is walked with DataFrame joins until every node holds a
bounded number of fingerprints; the node pairs that survive are the groups of
work below which each task walks the rest of the two subtries with arrays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_type, named, over_batches, text_of
from ledgerloom.llm.graph import components
from ledgerloom.session import checkpointed

SEED = 42
STEP = 4
LEAF_ROWS = 32_768
FRONTIER = 400_000
_CHUNK = 65_536


def fingerprint(raw: bytes, shingle_words: int = 3) -> int:
    """SimHash of a text as a signed 64-bit integer.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A bit
    is set if it is set in over half of the shingles' XXH64. A text with fewer
    words than a shingle is one shingle; a text without words has fingerprint 0.
    """
    words = raw.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    width = min(shingle_words, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, _CHUNK):
        part = words[start : min(start + _CHUNK, total) + width - 1]
        shingles = zip(*[part[shift : len(part) - width + 1 + shift] for shift in range(width)], strict=True)
        hashed = b"".join([digest(b" ".join(shingle), SEED) for shingle in shingles])
        bits = np.unpackbits(np.frombuffer(hashed, dtype=np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3) -> DataFrame:
    """``id`` and ``fp`` (long) for every row; null text counts as empty."""
    narrow = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    schema = pa.schema([("id", arrow_type(narrow, "id")), ("fp", pa.int64())])

    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").cast(pa.binary())
        return {"id": batch.column("id"), "fp": [fingerprint(text.as_py(), shingle_words) for text in texts]}

    return narrow.mapInArrow(over_batches(rows, schema), narrow.select("id").schema.add("fp", "long"))


def _top(value: Column, depth: int) -> Column:
    """The first ``depth`` bits, left-aligned; the rest are zero."""
    if depth == 0:
        return F.lit(0).cast("long")
    mask = ((1 << depth) - 1) << (64 - depth)
    return value.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def _leaves(prints: DataFrame, rows: int, leaf_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """Trie nodes below which at most ``leaf_rows`` fingerprints lie.

    Returns the fingerprints with their leaf (``depth``, ``prefix``), the leaves,
    and the deepest depth. Heavy nodes are opened four bits at a time; only their
    fingerprints are counted again.
    """
    depth = min(64, STEP * -(-max(0, (rows - 1) // leaf_rows).bit_length() // STEP))
    open_prints, members, leaves = prints.select("fp"), [], []
    while True:
        counted = checkpointed(
            open_prints.groupBy(_top(F.col("fp"), depth).alias("prefix")).agg(F.count("*").alias("n"))
        )
        heavy = counted.filter(F.col("n") > leaf_rows) if depth < 64 else counted.limit(0)
        at = F.lit(depth).alias("depth")
        placed = open_prints.select("fp", at, _top(F.col("fp"), depth).alias("prefix"))
        any_heavy = not heavy.isEmpty()
        light = counted.filter(F.col("n") <= leaf_rows) if any_heavy else counted
        leaves.append(light.select(at, "prefix"))
        if not any_heavy:
            members.append(placed)
            break
        members.append(placed.join(light.select("prefix"), "prefix", "left_semi").select(*placed.columns))
        open_prints = checkpointed(placed.join(heavy.select("prefix"), "prefix", "left_semi").select("fp"))
        depth += STEP
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    return union(members), checkpointed(union(leaves)), depth


def _node_pairs(leaves: DataFrame, deepest: int, budget: int) -> DataFrame:
    """Leaf pairs whose common prefix depth differs in at most ``budget`` bits, walked from the root."""
    spark = leaves.sparkSession
    pairs = spark.createDataFrame([(0, 0, 0, 0)], "da int, pa long, db int, pb long")
    for depth in range(STEP, deepest + 1, STEP):
        below = leaves.filter(F.col("depth") >= depth).select(
            F.lit(depth - STEP).alias("from_depth"),
            _top(F.col("prefix"), depth - STEP).alias("from_prefix"),
            F.lit(depth).alias("depth"),
            _top(F.col("prefix"), depth).alias("prefix"),
        )
        done = leaves.filter(F.col("depth") < depth).select(
            F.col("depth").alias("from_depth"), F.col("prefix").alias("from_prefix"), "depth", "prefix"
        )
        steps = below.distinct().unionByName(done)
        left = steps.select(*[F.col(c).alias(f"l_{c}") for c in steps.columns])
        right = steps.select(*[F.col(c).alias(f"r_{c}") for c in steps.columns])
        joined = pairs.join(
            left, (F.col("da") == F.col("l_from_depth")) & (F.col("pa") == F.col("l_from_prefix"))
        ).join(right, (F.col("db") == F.col("r_from_depth")) & (F.col("pb") == F.col("r_from_prefix")))
        shared = F.least("l_depth", "r_depth")
        mask = F.expr("shiftleft(-1L, 64 - least(l_depth, r_depth))")
        differing = F.when(shared == 0, 0).otherwise(
            F.bit_count(F.col("l_prefix").bitwiseXOR(F.col("r_prefix")).bitwiseAND(mask))
        )
        pairs = joined.filter((F.col("l_prefix") <= F.col("r_prefix")) & (differing <= budget)).select(
            F.col("l_depth").alias("da"), F.col("l_prefix").alias("pa"),
            F.col("r_depth").alias("db"), F.col("r_prefix").alias("pb"),
        )
    return pairs


class _Subtrie:
    """A sorted array of distinct fingerprints; a node is the index of its first entry."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.sort(values)

    def children(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per node: first entry of the 0 child and of the 1 child (-1: none), and whether it is a single entry."""
        values, size = self.values, len(self.values)
        starts = np.flatnonzero(np.r_[True, (values[1:] >> np.uint64(64 - depth)) != (values[:-1] >> np.uint64(64 - depth))]) if depth else np.zeros(1, dtype=np.int64)
        ends = np.r_[starts[1:], size]
        shift = np.uint64(63 - depth)
        split = np.clip(np.searchsorted(values, (values[starts] >> shift | np.uint64(1)) << shift), starts, ends)
        zero, one = np.full(size, -1, dtype=np.int32), np.full(size, -1, dtype=np.int32)
        zero[starts] = np.where(split > starts, starts, -1)
        one[starts] = np.where(split < ends, split, -1)
        single = np.zeros(size, dtype=bool)
        single[starts] = ends - starts == 1
        return zero, one, single


def _merge(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the classes of linked entries; ``label`` keeps the smallest entry of each class."""
    while len(left):
        a, b = label[left], label[right]
        differ = a != b
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label[:] = further


def joined_subtries(left: np.ndarray, right: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (entry, smallest entry of its class) between two subtries, or inside one if ``right`` is None.

    Node pairs are walked level by level in blocks of at most ``FRONTIER`` pairs,
    so memory does not depend on how dense the fingerprints lie. Pairs of single
    entries are finished at once by counting their differing bits.
    """
    a = _Subtrie(left)
    b = a if right is None else _Subtrie(right)
    offset = 0 if right is None else len(a.values)
    label = np.arange(len(a.values) + (0 if right is None else len(b.values)))
    levels: dict[int, tuple] = {}
    zero = np.zeros(1, dtype=np.int32)
    stack = [(0, zero, zero, np.zeros(1, dtype=np.int8))]
    while stack:
        depth, na, nb, diff = stack.pop()
        if depth < 64 and depth not in levels:
            levels[depth] = (a.children(depth), b.children(depth))
        if depth == 64:
            done = np.ones(len(na), dtype=bool)
        else:
            done = levels[depth][0][2][na] & levels[depth][1][2][nb]
        if done.any():
            i, j = na[done], nb[done]
            close = np.bitwise_count(a.values[i] ^ b.values[j]) <= budget
            _merge(label, i[close].astype(np.int64), j[close].astype(np.int64) + offset)
            keep = ~done
            na, nb, diff = na[keep], nb[keep], diff[keep]
        if depth == 64 or not len(na):
            continue
        kids_a, kids_b = levels[depth]
        found = []
        for bit_a in (0, 1):
            for bit_b in (0, 1):
                ca, cb, cost = kids_a[bit_a][na], kids_b[bit_b][nb], diff + np.int8(bit_a != bit_b)
                good = (ca >= 0) & (cb >= 0) & (cost <= budget)
                if right is None and bit_a > bit_b:
                    good &= na != nb
                found.append((ca[good], cb[good], cost[good]))
        na, nb, diff = (np.concatenate(part) for part in zip(*found, strict=True))
        for start in range(0, len(na), FRONTIER):
            part = slice(start, start + FRONTIER)
            stack.append((depth + 1, na[part], nb[part], diff[part]))
    every = a.values if right is None else np.concatenate([a.values, b.values])
    linked = np.flatnonzero(label != np.arange(len(label)))
    return every[linked], every[label[linked]]


def links(prints: DataFrame, budget: int = 2, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``budget`` differing bits.

    Each pair of subtries returns a spanning forest of its links instead of every
    close pair, so no more rows come back than went in.
    """
    members, leaves, deepest = _leaves(prints, prints.count(), leaf_rows)
    pairs = checkpointed(_node_pairs(leaves, deepest, budget))
    key = ["da", "pa", "db", "pb"]
    members = members.select(F.col("depth").alias("d"), F.col("prefix").alias("p"), "fp")
    first = members.join(pairs, (F.col("d") == F.col("da")) & (F.col("p") == F.col("pa")))
    second = members.join(
        pairs.filter((F.col("da") != F.col("db")) | (F.col("pa") != F.col("pb"))),
        (F.col("d") == F.col("db")) & (F.col("p") == F.col("pb")),
    )
    work = first.select(*key, F.lit(False).alias("second"), "fp").unionByName(
        second.select(*key, F.lit(True).alias("second"), "fp")
    )

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy().astype(np.int64).view(np.uint64)
        other = group["second"].to_numpy(dtype=bool)
        node, root = joined_subtries(values[~other], values[other] if other.any() else None, budget)
        return pd.DataFrame({"a": node.view(np.int64), "b": root.view(np.int64)})

    return work.groupBy(*key).applyInPandas(walk, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 3,
    budget: int = 2,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Class of near-duplicates of every row: ``id``, ``fp``, ``component`` and ``copies``.

    ``component`` is the smallest id reachable over links of at most ``budget``
    differing fingerprint bits, ``copies`` the number of rows with the same
    fingerprint. Rows are first collapsed by fingerprint, so a text copied any
    number of times is one entry of the trie.

    Null or empty text and text without words has fingerprint 0 and is linked like
    any other. A null id is never smallest; a class of null ids only has a null
    component. Repeated rows each come back. An empty table gives no rows. Other
    columns are ignored.
    """
    prints = checkpointed(fingerprints(docs, id_column, text_column, shingle_words))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("copies")))
    roots = checkpointed(components(links(distinct, budget, leaf_rows)))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = linked.groupBy("root").agg(F.min("low").alias("component"))
    facts = linked.join(smallest, "root").select("fp", "component", "copies")
    return prints.join(facts, "fp").select("id", "fp", "component", "copies")


def representatives(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3, budget: int = 2,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: of the smallest id, then smallest text hash; null ids last.

    All columns stay. Rows that agree in id and text are one document, of which
    one row stays. The choice is made on (id, text hash) alone; each task marks
    the rows it read, so texts are fingerprinted and shuffled once.
    """
    packed = docs.select(F.struct("*").alias("row"), *named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    schema = pa.schema([("id", arrow_type(packed, "id")), ("mark", pa.int64()), ("fp", pa.int64())])
    narrow = packed.select("id", F.xxhash64("text").alias("mark"), "text")

    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").cast(pa.binary())
        return {
            "id": batch.column("id"), "mark": batch.column("mark"),
            "fp": [fingerprint(text.as_py(), shingle_words) for text in texts],
        }

    prints = checkpointed(
        narrow.mapInArrow(over_batches(rows, schema), packed.select("id").schema.add("mark", "long").add("fp", "long"))
    )
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "mark")).alias("best")
    distinct = checkpointed(prints.groupBy("fp").agg(best))
    roots = components(links(distinct, budget, leaf_rows)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    chosen = checkpointed(
        rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.id").alias("own_id"), F.col("best.mark").alias("own_mark"))
    )
    marked = packed.select("row", "id", F.xxhash64("text").alias("mark"))
    kept = marked.join(chosen, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark")), "left_semi")
    single = kept.groupBy("id", "mark").agg(F.first("row").alias("row"))
    return single.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
