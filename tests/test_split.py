import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import scale, split

VECTORS = {
    0: (0, 0, 0), 1: (1, 0, 0), 2: (2, 0, 0), 3: (1, 1, 1), 4: (2, 1, 1), 5: (3, 1, 1),
    7: (5, 1, 1), 10: (8, 1, 1), 416: (333, 42, 41), 417: (333, 42, 42),
    8333: (6667, 833, 833), 8334: (6667, 834, 833),
}


def test_allocation_vectors(spark):
    totals = spark.createDataFrame([(n,) for n in VECTORS], "n bigint")
    rows = split.allocate_counts(totals, "n", (0.8, 0.1, 0.1)).collect()
    assert {r.n: (r.train, r.validation, r.test) for r in rows} == VECTORS


def test_allocation_with_an_unwanted_split(spark):
    totals = spark.createDataFrame([(n,) for n in (1, 2, 3, 9)], "n bigint")
    rows = split.allocate_counts(totals, "n", (0.9, 0.0, 0.1)).collect()
    assert {r.n: (r.train, r.validation, r.test) for r in rows} == {
        1: (1, 0, 0), 2: (1, 0, 1), 3: (2, 0, 1), 9: (8, 0, 1),
    }


def brute(rows, ratios, seed):
    import hashlib

    groups = {}
    for stratum, row_id in rows:
        digest = hashlib.md5(f"{seed}|{row_id}".encode()).hexdigest()
        groups.setdefault(stratum, []).append((digest, row_id))
    labels = {}
    for members in groups.values():
        train, held, _ = VECTORS[len(members)]
        for at, (_, row_id) in enumerate(sorted(members)):
            labels[row_id] = "train" if at < train else "validation" if at < train + held else "test"
    return labels


@pytest.mark.parametrize("partitions, digits", [(1, 1), (7, 3)])
def test_split_equals_brute_force(spark, partitions, digits):
    sizes = {"hot": 8334, "a": 416, "b": 10, "c": 3, "d": 2, "e": 1}
    rows = [(name, f"{name}-{at}") for name, size in sizes.items() for at in range(size)]
    df = spark.createDataFrame(rows, "category string, id string").repartition(partitions)
    got = split.stratified_split(df, seed=7, bucket_digits=digits).collect()
    assert {r.id: r.split for r in got} == brute(rows, (0.8, 0.1, 0.1), 7)


def test_split_with_too_many_strata_to_broadcast(spark, monkeypatch):
    rows = [(f"s{at % 40}", at) for at in range(400)]
    df = spark.createDataFrame(rows, "category string, id bigint")
    wide = split.stratified_split(df).collect()
    original = scale.broadcast_if_small
    monkeypatch.setattr(
        split, "broadcast_if_small", lambda facts, keys, frame: original(facts, keys, frame, max_rows=3, salts=4)
    )
    salted = split.stratified_split(df).collect()
    assert sorted(wide) == sorted(salted) and len(salted) == 400


def test_bad_ratios():
    with pytest.raises(ValueError):
        split.check_ratios((0.5, 0.1, 0.1))


def test_hot_keys_are_salted_without_changing_the_join(spark):
    rows = spark.createDataFrame([(at, 0 if at % 3 else at) for at in range(300)], "id int, k int")
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    plain = rows.join(facts, "k").select("id", "k", "n", "s")
    salted = scale.join_group_facts(rows, facts, "k", "n", ["id"], hot_rows=10, salts=4)
    assert sorted(plain.collect()) == sorted(salted.select("id", "k", "n", "s").collect())


def test_running_cuts_with_weights(spark):
    rows = [("a", at // 3, at, at % 4) for at in range(20)] + [("b", 0, 0, 5)]
    df = spark.createDataFrame(rows, "g string, bucket int, at int, w bigint")
    got = scale.running_cuts(df, ["g"], ["bucket"], ["at"], "w", targets={"cap": F.lit(7)}).collect()
    total, cut = 0, None
    for _, _, at, w in rows[:20]:
        total += w
        if cut is None and total >= 7:
            cut = at
    assert {r.g: r.cap_key.at for r in got} == {"a": cut}


def test_step_plan(spark):
    df = spark.createDataFrame([("train",)] * 35 + [("test",)], "split string")
    rows = {r.split: (r.rows, r.steps_per_epoch, r.total_steps) for r in split.split_sizes(df).collect()}
    assert rows == {"train": (35, 2, 6), "test": (1, 0, 0)}


def test_seeded_order_does_not_depend_on_partitions(spark):
    import hashlib

    df = spark.range(500)
    expected = sorted(range(500), key=lambda n: hashlib.md5(f"3|{n}".encode()).hexdigest())
    for partitions in (1, 5, 16):
        mixed = split.shuffled(df.repartition(3), seed=3, partitions=partitions)
        assert [r.id for r in mixed.collect()] == expected
