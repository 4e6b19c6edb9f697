"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is the log likelihood ratio of its features, words and
binned shape figures, under the labels. Its prior is the labelled rate of its
path, shrunk towards its host's, shrunk towards the global rate. How strongly is
estimated from the spread of the groups' rates themselves.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_type, named, over_batches, text_of
from ledgerloom.operators.scale import broadcast_if_small
from ledgerloom.session import checkpointed

LABELLED_ROWS = 20_000
FEATURES = 2_000
MIN_DOCS = 5
Z = 6.0
RATIO = 4.0
SMOOTHING = 0.5
MAX_STRENGTH = 1e6
MIN_STRENGTH = 1.0
_WORD = re.compile(r"\w+")
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def shape_features(text: str) -> list[str]:
    """Figures of a text, each in one of a few bins; the names cannot be words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line]
    size, count = max(1, len(raw)), max(1, len(words))
    share = {
        "symbols": len(raw) - len(raw.translate(None, _SYMBOLS)),
        "upper": len(raw) - len(raw.translate(None, _UPPER)),
        "digits": len(raw) - len(raw.translate(None, _DIGITS)),
    }
    out = [f"#{name}:{int(20 * math.sqrt(number / size))}" for name, number in share.items()]
    out.append(f"#words:{len(words).bit_length()}")
    out.append(f"#length:{min(20, size // count)}")
    out.append(f"#distinct:{int(10 * len(set(words)) / count)}")
    out.append(f"#repeated:{int(10 * (1 - len(set(lines)) / max(1, len(lines))))}")
    return out


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _rates(names: list[str]) -> list[Column]:
    return [F.sum(F.col(name).cast("double")).alias(name) for name in names]


def priors(labelled: DataFrame, kinds: list[str]) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Shrunk rates per (host, path) and per host of each 0/1 column in ``kinds``, and the global rates.

    A group's rate is (hits + s * parent) / (rows + s), where s makes the
    beta-binomial's spread match what the groups' rates show beyond chance. Sums
    are combined before each shuffle; only single rows reach the driver.
    """
    paths = checkpointed(labelled.groupBy("host", "path").agg(F.count("*").alias("n"), *_rates(kinds)))
    hosts = checkpointed(paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(k).alias(f"host_{k}") for k in kinds]))
    total = hosts.agg(F.sum("host_n"), *[F.sum(f"host_{k}") for k in kinds]).first()
    rows = total[0] or 0
    world = {kind: ((total[i] or 0) + SMOOTHING) / (rows + 2 * SMOOTHING) for i, kind in enumerate(kinds, 1)}
    of_host = hosts.select(F.col("host").alias("host_key"), *[
        ((F.col(f"host_{kind}") + strength * world[kind]) / (F.col("host_n") + strength)).alias(f"rate_{kind}")
        for kind in kinds
        for strength in [_strength(hosts, "host_n", f"host_{kind}", F.lit(world[kind]))]
    ])
    facts = paths.join(of_host, F.col("host").eqNullSafe(F.col("host_key"))).drop("host_key")
    facts = facts.select("host", "path", *[
        ((F.col(kind) + strength * F.col(f"rate_{kind}")) / (F.col("n") + strength)).alias(f"prior_{kind}")
        for kind in kinds
        for strength in [_strength(facts, "n", kind, F.col(f"rate_{kind}"))]
    ])
    return facts, of_host.withColumnRenamed("host_key", "host"), world


def _strength(groups: DataFrame, n: str, hits: str, parent: Column) -> float:
    """Prior rows that explain the groups' spread around their parent, by moments; no spread beyond chance is the most."""
    chance = parent * (F.lit(1.0) - parent)
    gap = F.col(hits) / F.col(n) - parent
    sums = groups.agg(
        F.sum(F.col(n) * gap * gap), F.sum(chance), F.sum(F.col(n) * chance)
    ).first()
    if not sums[1] or sums[2] is None:
        return MAX_STRENGTH
    # E[n * gap^2] = chance * (1 + (n - 1) * rho), summed over groups
    beyond = sums[2] - sums[1]
    rho = (sums[0] - sums[1]) / beyond if beyond > 0 else 0.0
    return min(MAX_STRENGTH, max(MIN_STRENGTH, 1 / rho - 1)) if rho > 0 else MAX_STRENGTH


def learned(
    docs: DataFrame, labels: DataFrame, kinds: list[str], sample_rows: int = LABELLED_ROWS, features: int = FEATURES
) -> dict[str, dict[str, tuple[float, float]]]:
    """Per kind, log likelihood ratios of a feature's presence and absence.

    ``docs`` has ``id`` and ``text``, ``labels`` one row per id. Fitted on the
    ``sample_rows`` labelled rows with the smallest hash of their id. Texts that
    are equal but for case and white space are copies and count once. A word is a
    feature if it parts the labels by ``Z`` standard errors and a ratio of
    ``RATIO``; of these the ``features`` clearest are taken. Shape figures always
    are features, beside the words; there are some two hundred of them.
    """
    sample = labels.filter(F.col("id").isNotNull()).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample_rows)
    texts = docs.join(F.broadcast(sample), "id")
    schema = pa.schema([("copy", pa.binary()), ("features", pa.list_(pa.string())), *[(kind, pa.int32()) for kind in kinds]])

    def read(batch: pa.RecordBatch) -> dict:
        copies, found = [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            copies.append(xxhash.xxh3_128_digest(" ".join(text.lower().split()).encode("utf-8", "surrogatepass")))
            found.append(sorted(words) + shape_features(text))
        return {"copy": copies, "features": found, **{kind: batch.column(kind).cast(pa.int32()) for kind in kinds}}

    result = "copy binary, features array<string>, " + ", ".join(f"{kind} int" for kind in kinds)
    rows = checkpointed(texts.select("text", *kinds).mapInArrow(over_batches(read, schema), result))
    single = rows.groupBy("copy", *kinds).agg(F.min(F.to_json("features")).alias("features")).select(
        *kinds, F.from_json("features", "array<string>").alias("features")
    )
    single = checkpointed(single)
    totals = single.agg(F.count("*"), *[F.sum(kind) for kind in kinds]).first()
    counts = checkpointed(
        single.select(*kinds, F.explode("features").alias("feature")).groupBy("feature")
        .agg(F.count("*").alias("n"), *_rates(kinds)).filter(F.col("n") >= MIN_DOCS)
    )
    out: dict[str, dict[str, tuple[float, float]]] = {}
    for i, kind in enumerate(kinds, 1):
        yes, no = float(totals[i] or 0), float(totals[0] - (totals[i] or 0))
        out[kind] = {}
        if not yes or not no:
            continue
        hit, miss = F.col(kind), F.col("n") - F.col(kind)
        p, q = (hit + SMOOTHING) / (yes + 2 * SMOOTHING), (miss + SMOOTHING) / (no + 2 * SMOOTHING)
        pooled = F.col("n") / (yes + no)
        z = F.abs(hit / yes - miss / no) / F.sqrt(pooled * (F.lit(1.0) - pooled) * (1 / yes + 1 / no) + 1e-12)
        shape = F.col("feature").startswith("#")
        rated = counts.withColumns({"p": p, "q": q, "z": z})
        clear = rated.filter(~shape & (F.col("z") >= Z) & (F.abs(F.log(p / q)) >= math.log(RATIO)))
        chosen = rated.filter(shape).unionByName(clear.orderBy(F.desc("z"), "feature").limit(features))
        for row in chosen.collect():
            p_, q_ = row["p"], row["q"]
            absent = 0.0 if row["feature"].startswith("#") else math.log((1 - min(p_, 1 - 1e-6)) / (1 - min(q_, 1 - 1e-6)))
            out[kind][row["feature"]] = (math.log(p_ / q_), absent)
    return out


def classified(
    docs: DataFrame, labels: DataFrame, kinds: dict[str, str], id_column: str = "doc_id", text_column: str = "text",
    host_column: str = "source", path_column: str = "lang", label_id_column: str = "doc_id",
    sample_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """``id`` and, per kind, the posterior probability ``p_<kind>`` that the document is of that kind.

    ``kinds`` names boolean SQL expressions over ``labels``, such as low quality. All
    labelled documents make the hierarchy's rates; the classifier is fitted on a
    sample of at most ``sample_rows`` of them. Repeated labels of an id are
    joined by their maximum; null labels count as false, labels with a null id or
    without a document as absent.

    Null or empty text has the shape of an empty text. Null hosts and paths are
    groups of their own; a path without labels has its host's rate, a host without
    labels the global one. Without labels every probability is 0.5.
    Repeated rows each come back. An empty table gives no rows. Other columns are
    ignored.
    """
    names = list(kinds)
    base = docs.select(
        *named(id=id_column, host=host_column, path=path_column), text_of(f"`{text_column}`").alias("text")
    )
    flags = labels.select(
        *named(id=label_id_column), *[F.coalesce(F.expr(flag).cast("int"), F.lit(0)).alias(name) for name, flag in kinds.items()]
    ).groupBy("id").agg(*[F.max(name).alias(name) for name in names])
    flags = checkpointed(flags)
    model = learned(base.select("id", "text"), flags, names, sample_rows)
    facts, of_host, world = priors(base.select("id", "host", "path").join(flags, "id"), names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = ("id", "host", "path")
    schema = pa.schema([*[(name, arrow_type(base, name)) for name in keep], *[(f"e_{name}", pa.float64()) for name in names]])
    state: dict[str, float] = {}

    def read(batch: pa.RecordBatch) -> dict:
        known = shared.value
        if not state:
            state.update({name: sum(absent for _, absent in known[name].values()) for name in names})
        out: dict = {name: batch.column(name) for name in keep} | {f"e_{name}": [] for name in names}
        for text in batch.column("text").to_pylist():
            words, shape = words_of(text), shape_features(text)
            for name in names:
                own = known[name]
                score = state[name] + sum(own[word][0] - own[word][1] for word in own.keys() & words)
                out[f"e_{name}"].append(score + sum(own[part][0] for part in shape if part in own))
        return out

    result = base.select(*keep).schema
    for name in names:
        result = result.add(f"e_{name}", "double")
    evidence = base.mapInArrow(over_batches(read, schema), result)
    joined = broadcast_if_small(of_host, ["host"], broadcast_if_small(facts, ["host", "path"], evidence))
    for name in names:
        prior = F.coalesce(F.col(f"prior_{name}"), F.col(f"rate_{name}"), F.lit(world[name]))
        odds = F.col(f"e_{name}") + F.log(prior / (F.lit(1.0) - prior))
        joined = joined.withColumn(f"p_{name}", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))
    return joined.select("id", *[f"p_{name}" for name in names])
