"""The quality fit keeps unlike texts apart and counts copies once."""

import math
import random

import pytest
import xxhash

from ledgerloom.llm import quality


def test_unlike_texts_are_not_folded(spark):
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("abcdefgh", k=5)) for _ in range(4000)}, key=xxhash.xxh64_intdigest)
    common, others = words[:2], words[2:]  # every text has the two words of least hash
    rows = []
    for i in range(120):
        own = draw.sample(others, 20) + common
        rows.append((i, " ".join(own + (["unwanted"] if i % 2 else [])), i % 2))
    rows += [(200 + i, "copied " + " ".join(words[:8]) + " " * i, 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, text string")
    labels = spark.createDataFrame([(i, low) for i, _, low in rows], "id long, low int")
    found = quality.learned(docs, labels, ["low"])["low"]
    assert "unwanted" in found
    assert "copied" not in found


def naive_ratios(texts, flags, words_wanted):
    """Log ratios of presence and absence, counted plainly over texts that differ."""
    single = {}
    for text, flag in zip(texts, flags, strict=True):
        key = (" ".join(text.lower().split()), flag)
        single.setdefault(key, set()).add(frozenset([*quality.words_of(text), *quality.shape_features(text)]))
    rows = [(set(next(iter(found))), flag) for (_, flag), found in single.items()]
    yes = sum(flag for _, flag in rows)
    no = len(rows) - yes
    shapes, words = {}, []
    for name in set().union(*[found for found, _ in rows]):
        hit = sum(flag for found, flag in rows if name in found)
        n = sum(name in found for found, _ in rows)
        if n < quality.MIN_DOCS:
            continue
        p = (hit + quality.SMOOTHING) / (yes + 2 * quality.SMOOTHING)
        q = (n - hit + quality.SMOOTHING) / (no + 2 * quality.SMOOTHING)
        pooled = n / (yes + no)
        z = abs(hit / yes - (n - hit) / no) / math.sqrt(pooled * (1 - pooled) * (1 / yes + 1 / no) + 1e-12)
        if name.startswith("#"):
            shapes[name] = (math.log(p / q), 0.0)
        elif z >= quality.Z and abs(math.log(p / q)) >= math.log(quality.RATIO):
            absent = math.log((1 - min(p, 1 - 1e-6)) / (1 - min(q, 1 - 1e-6)))
            words.append((-z, name, (math.log(p / q), absent)))
    return shapes | {name: ratio for _, name, ratio in sorted(words)[:words_wanted]}


@pytest.mark.parametrize("features", [2000, 1, 0])
def test_fit_equals_plain_counts(spark, features):
    draw = random.Random(11)
    usual = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(60)]
    rows = []
    for i in range(300):
        low = int(i % 3 == 0)
        text = " ".join(draw.choices(usual, k=draw.choice([3, 30])) + (["bad", "worse"][: 1 + i % 2] if low else ["fine"] * (i % 2)))
        rows.append((i, text.upper() if low and i % 4 else text, low))
    rows += [(400 + i, rows[0][1], 1) for i in range(30)] + [(500, "", 0)]
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "id long, text string")
    labels = spark.createDataFrame([(i, low) for i, _, low in rows], "id long, low int")
    found = quality.learned(docs, labels, ["low"], features=features)["low"]
    expected = naive_ratios([text for _, text, _ in rows], [low for _, _, low in rows], features)
    assert found.keys() == expected.keys() and sum(name.startswith("#") for name in found) > 5
    assert all(found[name] == pytest.approx(expected[name]) for name in found)
    assert sum(not name.startswith("#") for name in found) == min(features, sum(not n.startswith("#") for n in expected))


def test_posterior_equals_plain_sum(spark):
    """Evidence of every feature, present or absent, and the site's rate, by hand."""
    draw = random.Random(12)
    rows = []
    for i in range(240):
        low = int(draw.random() < (0.6 if i % 2 else 0.1))
        words = draw.choices("alpha beta gamma delta epsilon zeta".split(), k=12) + (["junk"] if low and i % 5 else [])
        rows.append((i, " ".join(words), "ab"[i % 2], "xy"[i % 3 > 0], low))
    docs = spark.createDataFrame([row[:4] for row in rows] + [(900, None, None, "x")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(row[0], row[4]) for row in rows], "doc_id long, low int")
    got = {r["id"]: r["p_low"] for r in quality.classified(docs, labels, {"low": "low = 1"}).collect()}
    ratios = naive_ratios([row[1] for row in rows], [row[4] for row in rows], quality.FEATURES)
    sites = spark.createDataFrame([(row[2], row[3], row[4]) for row in rows], "host string, path string, low int")
    facts, _, world = quality.priors(sites, ["low"])
    prior = {(r["host"], r["path"]): r["prior_low"] for r in facts.collect()}
    for doc_id, text, host, path, *_ in [*rows, (900, "", None, "x")]:
        present = quality.words_of(text) | set(quality.shape_features(text))
        evidence = sum(here if name in present else absent for name, (here, absent) in ratios.items())
        rate = prior.get((host, path), world["low"])
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-(evidence + math.log(rate / (1 - rate))))))
    assert len(got) == len(rows) + 1
