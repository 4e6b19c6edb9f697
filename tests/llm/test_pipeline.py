"""The pipeline's stages on a small table, each against what its input says it must do."""

import random

import corpus_pipeline

from ledgerloom.llm import simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, count, alphabet):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(alphabet, k=draw.randint(2, 6))) for _ in range(count))


def test_stages(spark, tmp_path):
    item = words(1, 30, "abcdefgh")
    passage = words(2, 60, "abcdefgh")
    rows = []
    for i in range(80):
        lang, alphabet = (("aa", "abcdefgh"), ("bb", "stuvwxyz"))[i % 2]
        rows.append((i, words(100 + i, 80, alphabet), lang))
    rows += [(200, None, "aa"), (201, "123 456", "aa"), (202, rows[4][1], "aa"), (203, rows[6][1] + " ab", "aa")]
    rows += [(204, words(5, 50, "abcdefgh") + "\n" + passage, "aa"), (205, passage + "\n" + words(6, 50, "abcdefgh"), None)]
    rows += [(206, words(7, 40, "abcdefgh") + " " + item + " " + words(8, 40, "abcdefgh"), "aa")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], COLUMNS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "tokens"]

    spoken = stage["language_id"](spark, docs, str(tmp_path))
    assert spoken.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in spoken.collect()} == {200, 201}
    lines = stage["line_dedup"](spark, docs, str(tmp_path))
    assert lines.columns == docs.columns and lines.count() == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert passage in by_id[204] and passage not in by_id[205] and by_id[202] == ""
    near = stage["near_dedup"](spark, docs, str(tmp_path))
    classes = {r["id"]: r["component"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(set(classes.values()))
    pure = stage["decontamination"](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in pure.collect()} == {206}

    result = corpus_pipeline.run(spark, str(tmp_path))
    done = {r["doc_id"]: r for r in result.collect()}
    assert not {200, 201, 206} & set(done) and {0, 1, 204, 205} <= set(done)
    assert done[202]["n_tokens"] == 0  # all its lines stand earlier; of documents left without text one stays
    assert all(r["n_tokens"] == len(r["ids"]) for r in done.values())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
