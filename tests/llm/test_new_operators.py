"""The prefix trie, resampling and packing against brute force on small tables with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import contraction, packing, resampling, trie
from ledgerloom.llm.queries import QUERIES, WORDS_FILE

CONVERSATIONS = "conv_id long, turn long, role string, text string, prefix string, path long, depth long, kids long"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, piece int, weight long, bin long"


def brute_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    built = {}
    for conv, turns in own.items():
        taken = zlib.crc32(str(conv).encode()) % 4
        built[conv] = own.get(conv - int(math.fmod(conv, 20)), [])[:taken] + turns[taken:]
    members, kids = {}, {}
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0d]+", key[-1][1])) if key else 0
        below = [sums[kid] for kid in kids.get(key, [])]
        sums[key] = sum(s[0] for s in below) or 1, sum(s[1] for s in below) + (len(members[key]) - 1) * words
    return sorted(
        (
            (min(own_), len(key), min(members[key[:-1]]) if key else None, len(own_), len(kids.get(key, [])), *sums[key],
             hashlib.sha256(",".join(str(c) for c in sorted(own_) if len(built[c]) == len(key)).encode()).hexdigest())
            for key, own_ in members.items()
        ),
        key=str,
    )


def trie_rows(spark, rows):
    df = spark.createDataFrame([(*row, "p", 1, 2, 3) for row in rows], CONVERSATIONS).repartition(3)
    return sorted((tuple(row)[:8] for row in trie.conversation_trie(df).collect()), key=str)


def test_trie(spark, monkeypatch):
    draw = random.Random(1)
    rows = [
        (conv, turn, draw.choice(["user", "assistant"]), draw.choice(["a b", "c", "d\te f"]))
        for conv in [*range(-25, 45)] for turn in range(draw.randint(1, 5))
    ]
    rows += [(3, None, None, "x"), (None, 1, "u", "t"), (7, 2, "user", None), (7, 2, "user", None), (1, 9, "u", "w " * 3000)]
    rows += [(41, turn, "u", f"w {turn % 7}") for turn in range(200)]  # a long chain
    rows += [(1000 + length, turn, "u", f"deep {turn}") for length in range(25) for turn in range(length)]  # every beginning
    rows += [(200 + i, turn, "u", "same") for i in range(40) for turn in range(4)]  # a large group of copies
    monkeypatch.setattr(contraction, "STRETCH", 16)
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "u", "t")]) == []
    assert trie_rows(spark, [(21, None, None, None)]) == brute_trie([(21, None, None, None)])  # left without turns


def test_stretches_put_together():
    """A conversation cut anywhere has the same value as in one piece."""
    draw = random.Random(2)
    for _ in range(200):
        heads, own = draw.randint(0, 3), [draw.getrandbits(120) for _ in range(draw.randint(0, 9))]
        turns = [(False, draw.getrandbits(120)) for _ in range(heads)] + [(True, mark) for mark in own]
        skip = draw.randint(0, 3)
        value = depth = seen = 0
        for is_own, mark in turns:
            seen += is_own
            if not is_own or seen > skip:
                value, depth = (value * trie.BASE + mark) % trie.PRIME, depth + 1
        state = trie.Carry()
        cuts = sorted(draw.sample(range(len(turns) + 1), min(3, len(turns) + 1)))
        for first, last in zip([0, *cuts], [*cuts, len(turns)]):
            part = trie.Stretch(5)
            for is_own, mark in turns[first:last]:
                if not is_own:
                    part.heads, part.head_value = part.heads + 1, (part.head_value * trie.BASE + mark) % trie.PRIME
                else:
                    part.own += 1
                    if part.own < 4:
                        part.first_own.append(mark)
                    else:
                        part.own_value = (part.own_value * trie.BASE + mark) % trie.PRIME
            if last > first:
                state = trie.put_behind(state, part, skip, 4)
        assert (state.depth, state.value) == (depth, value)


def features_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(gram.encode()) % 10_000 for gram in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute_resampling(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features_of(text)[1])
    for text in target:
        t.update(features_of(text)[1])
    all_s, all_t = s.total(), t.total()
    gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n_words, found = features_of(text)
        weight = sum(gains[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, n_words])
    fit = sorted((row for row in rows if row[4] >= 20), key=lambda row: (-row[3], row[0] is not None, row[0] or 0))
    ranks = {id(row): rank for rank, row in enumerate(fit[: len(fit) * 25 // 100], 1)}
    return sorted(((*row[:4], ranks.get(id(row))) for row in rows), key=str)


def document_rows(spark, docs):
    return spark.createDataFrame([(*doc, "en", "s", 0, 1, 2, 3) for doc in docs], DOCUMENTS).repartition(3)


def awkward_documents():
    draw = random.Random(4)
    stems = ["alpha", "Beta", "ΓΆΜΜΑ", "naïve", "x1", "42", "漢字", "it's", "end.", "\U0001f600"]
    docs = [(i, " ".join(draw.choices(stems, k=draw.randint(0, 60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " \n\t.;"), (203, "one"), (None, docs[3][1] + " more" * 30), (None, None)]
    docs += [docs[5]] * 3 + [(300 + i, "same words again " * 9) for i in range(40)] + [(400, "long tail " * 40_000)]
    return docs


def test_resampling(spark, monkeypatch):
    monkeypatch.setattr(resampling, "GROUP_BYTES", 2000)
    docs, target = awkward_documents(), ["alpha beta 漢字 x1", None, "it's 42", ""]
    bench = spark.createDataFrame([(i, text) for i, text in enumerate(target)], "item_id long, text string")
    found = resampling.resampled(document_rows(spark, docs), bench)
    assert found.columns == ["id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(row) for row in found.collect()), key=str) == brute_resampling(docs, target)
    assert resampling.resampled(document_rows(spark, []), bench).collect() == []
    assert {r["weight"] for r in resampling.resampled(document_rows(spark, [(1, "a b")]), bench.limit(0)).collect()} == {
        brute_resampling([(1, "a b")], [])[0][2]
    }


def test_longer_ngrams():
    import pyarrow as pa

    texts = ["a b c d a b c", "b", "", "c d a"]
    at, owner, _ = resampling.features(pa.array(texts), 3, 1 << 32)
    for row, text in enumerate(texts):
        words = text.split()
        grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        assert sorted(at[owner == row].tolist()) == sorted(zlib.crc32(gram.encode()) for gram in grams)


@pytest.mark.parametrize("capacity, group_items", [(4096, 65_536), (64, 7)])
def test_packing(spark, capacity, group_items):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORDS_FILE))
    docs = awkward_documents() + [(500, "ends<|endoftext|> here"), (501, "ΟΔΟΣ \x0b Σ á ́b")]
    found = packing.packed(
        document_rows(spark, docs), public_tokenizers.path(WORDS_FILE), capacity=capacity, group_items=group_items, with_ids=True
    ).collect()
    expected = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            expected.append((doc_id, start // capacity, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), part))
    assert sorted((tuple(row)[:6] for row in found), key=str) == sorted(expected, key=str)
    sequences = {}
    for row in found:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(row["length"] for row in found) // capacity)
    assert len(sequences) <= least * 1.02 + 2


def test_packing_of_nothing(spark):
    assert packing.packed(document_rows(spark, []), public_tokenizers.path(WORDS_FILE)).collect() == []


def test_best_fit_takes_the_least_room():
    bins, places, filled = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and places.tolist() == [0, 0, 6, 5, 8] and filled.tolist() == [10, 10]


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("op11_prefix_trie", "conversations", ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]),
        ("op12_resampling", "documents", ["doc_id", "n_features", "weight", "score", "rank"]),
        ("op13_packing", "documents", ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]),
    ],
)
def test_contract_columns_and_whole_tables(spark, name, table, columns):
    rows = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert rows.columns == columns
    source = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
    if table == "documents":
        docs = [tuple(row) for row in source.select("doc_id", "text").collect()]
        assert {row["doc_id"] for row in rows.collect()} == {doc_id for doc_id, _ in docs}
        if name == "op12_resampling":
            target = [row[0] for row in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()]
            assert sorted((tuple(row) for row in rows.collect()), key=str) == brute_resampling(docs, target)
    else:
        turns = [tuple(row) for row in source.select("conv_id", "turn", "role", "text").collect()]
        assert sorted((tuple(row) for row in rows.collect()), key=str) == brute_trie(turns)
