"""Extra columns with the operators' own names, empty tables, rows over limits, very long texts."""

import pytest
from pyspark.sql import functions as F

from gridlode.llm import html_text, language_model, neighbours, sharding, url_rules


def test_pages_with_clashing_columns(spark):
    rows = [(1, "http://a.b/en/1", "<p>x y</p>", "t", 5, [1], "h"), (None, None, None, None, None, None, None), (1, "http://a.b/en/1", "<p>x y</p>", "t", 5, [1], "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, tags array<int>, lines string")
    got = [tuple(r) for r in html_text.extract(pages).collect()]
    assert sorted(got, key=repr) == sorted([(1, "http://a.b/en/1", "x y", 3)] * 2 + [(None, None, "", 0)], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_urls_with_clashing_columns(spark):
    schema = "page_id long, url string, host string, path string, rule string, listed string, mined boolean, tokens string, antecedent int, token string"
    rows = [(1, "http://bad.org/" + "p/" * 20_000 + "x", *["c"] * 4, True, "d", 1, "e"), (2, None, *[None] * 8), (2, "HTTP://WWW.Example.COM/en/", *[None] * 8)]
    pages = spark.createDataFrame(rows, schema)
    many = [(f"http://{h}.org/p/{n}", h == "bad", "x") for n in range(30) for h in ("bad", "good")]
    labelled = spark.createDataFrame(many + [(None, True, "x"), ("http://bad.org/p", None, "x")], "url string, bad boolean, items string")
    got = {(r["page_id"], r["host"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, labelled).collect()}
    assert got == {(1, "bad.org", None, "block"), (2, "", None, "allow"), (2, "www.example.com", "www.example.com/en/", "allow")}
    assert url_rules.judge(pages.limit(0), labelled).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages, labelled.limit(0)).collect()} == {"allow"}


def test_vectors_with_clashing_columns(spark):
    rows = [(n, [float(n % 7), 1.0, float(n % 3)], 1, 2, b"v", 3, "s", 4) for n in range(60)] + [(20, [1.0, 1.0, 1.0], 1, 2, b"v", 3, "s", 4)] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int, part int, v binary, nr int, same string, salt int")
    plain = {tuple(r) for r in neighbours.nearest(df.select("vec_id", "embedding")).collect()}
    assert plain == {tuple(r) for r in neighbours.nearest(df).collect()} and {r[0] for r in plain} == {0, 20, 40} and all(r[0] != r[2] for r in plain)


def test_shards_with_ties_and_rows_over_the_limit(spark):
    rows = [(n, "x" * 50, n, 1, "s") for n in range(40)] + [(100, "y" * 5_000, 0, 0, None)] + [(777, "z" * 300, 1, 1, "t")] * 6 + [(None, None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, h long, depth int, shard string")
    got = sharding.shard(df, "doc_id", "text", 1_000).collect()
    assert len(got) == 50
    for shard in {r["shard"] for r in got}:
        own = [r for r in got if r["shard"] == shard]
        assert sum(r["bytes"] for r in own) == own[0]["shard_bytes"] and len(own) == own[0]["shard_rows"]
        # over the limit only where all rows share one hash: a single long row, or copies
        assert own[0]["fits"] == (own[0]["shard_bytes"] <= 1_000) and (own[0]["fits"] or len({(r["doc_id"], r["bytes"]) for r in own}) == 1)
    assert {r["shard_rows"] for r in got if r["doc_id"] == 777} == {6} and not any(r["fits"] for r in got if r["doc_id"] in (777, 100))


@pytest.mark.parametrize("size", [50, 1 << 21])
def test_language_model_takes_odd_tables(spark, monkeypatch, size):
    """Many blocks or one; a text longer than a block; null ids; columns of the tables' own names."""
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", size)
    long_ = " ".join(f"w{k % 3000}" for k in range(60_000))
    rows = [(1, long_, 1, 2, 3), (2, None, None, None, None), (None, "a b", 1, 2, 3), (None, "a b", 1, 2, 3), (None, None, 1, 2, 3), (5, "a c", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, to int, kind int, held_out int")
    got = language_model.LanguageModel(docs, F.coalesce(F.col("doc_id"), F.lit(0)) == 5).score().collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 1), (0, 3), (0, 3), (1, 60_001), (2, 1), (5, 3)]
    assert {r["train_tokens"] for r in got} == {60_001 + 1 + 3 + 3 + 1} and [r["held_out"] for r in got if r["doc_id"] == 5] == [True]
    assert len({r["score"] for r in got if r["doc_id"] is None and r["n_tokens"] == 3}) == 1
