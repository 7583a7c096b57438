"""The pipeline's decisions on planted documents, each stage on its own input."""

import numpy as np
import pytest

import corpus_pipeline


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    text = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 4000, n))
    rows, labels = [], []
    for n in range(120):
        words = text(80).split()
        if n % 6 == 0:
            words[10] = words[30] = words[50] = "idiot"
        rows.append((n, " ".join(words), "en", "s", 0))
        labels.append((n, 1, int(n % 6 == 0)))
    item = text(40)
    rows += [(200, rows[1][1], "en", "s", 0), (201, rows[2][1].replace(" ", "  ").upper(), "en", "s", 0), (202, text(30) + " " + item + " " + text(30), "en", "s", 0), (203, text(50) + " a@b.example.com", "en", "s", 0)]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, made):
    pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet(f"{made}/documents.parquet")
    left = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, docs, made))
        if n < 4:
            assert out.columns == docs.columns
            left[name] = {r["doc_id"]: r["text"] for r in out.collect()}
            docs = out
    clean = {n for n in range(120) if n % 6} | {200, 201, 202, 203}
    assert set(left["toxicity"]) == clean
    assert set(left["near_duplicates"]) == clean - {200, 201}
    assert set(left["decontamination"]) == clean - {200, 201, 202}
    assert set(left["personal_data"]) == set(left["decontamination"]) and left["personal_data"][203].endswith(" <EMAIL>")
    assert left["personal_data"][1] == left["decontamination"][1]
    packed = out.collect()
    assert {r["doc_id"] for r in packed} == set(left["personal_data"])
    assert {tuple(r) for r in corpus_pipeline.run(spark, made).collect()} == {tuple(r) for r in packed}


def test_near_duplicates_with_null_and_shared_ids(spark):
    rng = np.random.default_rng(4)
    a, b, c, d, e = (" ".join(f"w{k}" for k in rng.integers(0, 4000, 80)) for _ in range(5))
    near = "other " + b.split(" ", 1)[1]
    rows = [(None, a, "en", None), (None, a, None, "en"), (None, b, "en", "s"), (None, near, "en", "s"), (1, c, "en", "s"), (7, c, "en", "s"), (7, d, "en", "s"), (7, e, "en", "s"), (7, e, "en", "s")]
    docs = corpus_pipeline.written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    near_copies = [t for t in got if t[1] in (b, near)]
    assert len(near_copies) == 1 and near_copies[0][0] is None
    assert sorted((i or 0, t) for i, t in got if t not in (b, near)) == sorted([(0, a), (1, c), (7, d), (7, e)])


ODD = "doc_id long, text string, lang string, row string, _row long, node binary, key int, n_chars long"


@pytest.mark.parametrize("n", range(5))
def test_stages_take_odd_tables(spark, made, n):
    """Nulls in any column, empty and very long texts, repeated rows, an empty table, columns of the operators' own names."""
    pytest.importorskip("public_tokenizers")
    name, stage = corpus_pipeline.STAGES[n]
    long_ = " ".join(f"word{k}" for k in range(150_000))
    rows = [(None, None, None, None, None, None, None, None), (1, "", "en", "r", 5, b"n", 2, 0), (2, long_, "en", "r", 5, b"n", 2, 9), (None, "some text of a few words", "en", "x", 6, b"n", 2, 9)]
    rows += [(3, "another text of some words here", "en", "y", 7, b"n", 2, 9)] * 2
    docs = corpus_pipeline.written(spark.createDataFrame(rows, ODD))
    got = stage(spark, docs, made)
    if name == "packing":
        assert got.where("piece = 0").count() == 6 and got.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").isEmpty()
    else:
        assert got.columns == docs.columns
        kept = sorted(map(repr, got.drop("n_chars").collect()))  # which redacting counts anew
        wanted = [r for r in docs.drop("n_chars").collect() if name != "near_duplicates" or r["doc_id"] is not None or r["text"]]
        assert kept == sorted(map(repr, {repr(r): r for r in wanted}.values() if name == "near_duplicates" else wanted))
    assert stage(spark, docs.limit(0), made).count() == 0
