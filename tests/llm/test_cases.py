"""Empty, null, repeated and odd rows through the Spark operators."""

import pytest
from pyspark.sql import functions as F

from gridlode.llm import bagminhash, decontamination, html_text, language_model, neighbours, packing, pii, sharding, toxicity, url_rules

LONG = " ".join(f"word{n}" for n in range(3000))
NEAR = LONG.replace("word7 ", "other ")
ROWS = [(1, LONG), (2, NEAR), (3, None), (4, ""), (5, "tiny"), (6, "x@mail.com is an idiot"), (6, "x@mail.com is an idiot"), (None, "no id")]
SCHEMA = "doc_id long, text string, node string, key int, label int, bands int, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "n", 1, 2, 3, 4) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(docs, none):
    got = sharding.shard(docs, "doc_id", "text", 1000).collect()
    assert len(got) == 8 and all(r["fits"] or r["shard_rows"] == 1 for r in got)
    assert sharding.shard(none, "doc_id", "text", 1000).count() == 0


def test_near_duplicates(docs, none):
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.Duplicates(docs).classes().collect()}
    assert got[1] == got[2] == 1 and got[3] == got[4] == 3 and got[5] == 5 and got[6] == 6
    assert bagminhash.Duplicates(docs).classes().count() == 8 and bagminhash.Duplicates(none).classes().count() == 0


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, " ".join(f"word{n}" for n in range(100, 140))), (2, None), (3, "absent words " * 8)], "item_id long, text string")
    assert {r["doc_id"] for r in decontamination.contaminated(docs, bench).collect()} == {1, 2}
    assert decontamination.clean(docs, bench).count() == 6 and decontamination.contaminated(none, bench).count() == 0
    assert decontamination.clean(docs, bench.limit(0)).count() == 8


def test_personal_data(docs, none):
    crf = pii.Crf(pii.labelled_table(150), epochs=4)
    got = {r["doc_id"]: r for r in pii.find(docs, crf).collect()}
    assert got[6]["n_email"] == 1 and got[6]["spans"].startswith("email:0:10") and got[3]["spans"] == ""
    red = {r["doc_id"]: r for r in pii.redact(docs, crf).collect()}
    assert red[6]["text"].startswith("<EMAIL> is") and red[6]["n_chars"] == len(red[6]["text"]) and red[3]["text"] is None
    assert pii.find(none, crf).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (5, None), (77, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).count() == 8 and toxicity.score(none, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).where("score <> 0").count() == 0


def test_packing(docs, none):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("word_bpe_49k.json")
    got = packing.pack(docs, path).collect()
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and sum(r["piece"] == 0 for r in got) == 8 and packing.pack(none, path).count() == 0


def test_language_model(docs, none):
    held = F.coalesce(F.col("doc_id"), F.lit(0)) == 5
    got = language_model.LanguageModel(docs, held).score().collect()
    assert len(got) == 8 and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in got)
    assert next(r for r in got if r["doc_id"] == 3)["n_tokens"] == 1 and next(r for r in got if r["doc_id"] == 5)["n_known"] == 1
    assert language_model.LanguageModel(none, held).score().count() == 0


def test_language_model_hears_the_word_before(spark):
    order = "the cat sat on a mat while it rained all day".split()
    rows = [(n, " ".join(order)) for n in range(20)] + [(100, " ".join(order)), (101, " ".join(order[::-1])), (102, "unseen cat")]
    held = F.col("doc_id") >= 100
    model = language_model.LanguageModel(spark.createDataFrame(rows, "doc_id long, text string"), held)
    got = {r["doc_id"]: r for r in model.score().collect()}
    assert got[100]["base_score"] == pytest.approx(got[101]["base_score"])
    assert got[100]["score"] > got[101]["score"] + 5
    assert got[102]["score"] < got[102]["n_tokens"] * -0.3 and got[102]["n_known"] == 2
    assert model.trace[-1]["context tables"] < model.tokens


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://A.Example.com/en/1?x", None), (2, None, ""), (3, "http://x.net/fr/", "<p>a</p>"), (3, "http://www.example.com/en/", "<p>a</p>"), (4, "ftp://h#f", "x")], "page_id long, url string, html string")
    assert sorted(r["n_chars"] for r in html_text.extract(pages).collect()) == [0, 0, 1, 1, 1]
    labelled = spark.createDataFrame([], "url string, bad boolean")
    got = {(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, labelled).collect()}
    assert got == {("a.example.com", "/en/1", "example.com/en/", "block"), ("", "", None, "allow"), ("x.net", "/fr/", "net/fr/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"), ("h", "", None, "allow")}
    many = spark.createDataFrame([(f"http://bad.org/p/{n}", True) for n in range(20)] + [(f"http://good.org/p/{n}", False) for n in range(20)], "url string, bad boolean")
    odd = spark.createDataFrame([(1, "https://bad.org/q"), (2, "https://good.org/q")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge(odd, many).collect()} == {1: "block", 2: "allow"}


def test_neighbours(spark):
    nan = float("nan")
    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [1.0]), (40, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 40, 2.0), (20, 2, 1, 1.0), (20, 3, 2, 0.0), (40, 1, 1, 2.0), (40, 2, 20, 2.0), (40, 3, 2, 0.0)]
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_arrow_batches_are_given_back(spark, docs):
    from gridlode.llm.common import own_batches, small_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own_batches(spark)
    before = spark.conf.get(name)
    small_batches(small_batches(docs))
    assert spark.conf.get(name) == "1000"
    own_batches(spark)
    assert spark.conf.get(name) == before
    own_batches(spark)
    assert spark.conf.get(name) == before
