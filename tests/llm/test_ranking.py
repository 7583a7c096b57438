"""Ranked search against a plain scan of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gridlode.llm import ranking


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(docs, items):
    """Rows (nr, item_id, rank, doc_id, score)."""
    bags = [(i, plain_terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for nr, (item, text) in enumerate(items):
        found = []
        for doc, bag in bags:
            tf, score = Counter(bag), 0
            for term in plain_terms(text):
                if tf[term]:
                    m = 100 - 75 + 75 * len(bag) * n_docs // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (1_000_000_000 * tf[term] // (1000 * tf[term] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(nr, item, k + 1, doc, -score) for k, (score, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:10])]
    return out


def corpus(rng, n, words=400):
    kinds = [f"w{k}" for k in range(words)] + ["Été", "naïve", "日本", "A b", "x9"]
    for k in range(n):
        size = rng.choice([0, 3, 20, 60])
        yield k, rng.choice([" ", ", ", "-"]).join(kinds[min(int(rng.paretovariate(0.4)) - 1, len(kinds) - 1)] for _ in range(size))


@pytest.mark.parametrize("range_,leaf,fan", [(1 << 13, 64, 8), (64, 4, 2), (300, 1, 3)])
def test_search_equals_a_plain_scan(spark, monkeypatch, range_, leaf, fan):
    for name, value in (("RANGE", range_), ("LEAF", leaf), ("FAN", fan)):
        monkeypatch.setattr(ranking, name, value)
    rng = random.Random(range_)
    docs = list(corpus(rng, 500))
    docs += [(1000 + k, "copied Copied text w1 here") for k in range(40)] + [(None, "copied text w1"), (None, None), (7, "w3"), (7, "w3"), (2000, "w5 " * 5_000)]
    items = list(corpus(rng, 12)) + [(90, "copied TEXT w1"), (91, None), (92, ""), (93, "absent-word"), (90, "copied TEXT w1"), (94, "w1 w1 w1 w5"), (95, ";;")]
    docs_df = spark.createDataFrame([(i, t, 1, "t", 2) for i, t in docs], "doc_id long, text string, n int, terms string, score int").repartition(3)
    items_df = spark.createDataFrame([(i, t, 1, 5) for i, t in items], "item_id long, text string, rank int, nr int").coalesce(1)
    got = sorted((r["item_id"], r["rank"], r["score"], str(r["doc_id"])) for r in ranking.best_documents(docs_df, items_df).collect())
    assert got == sorted((i, k, s, str(d)) for _, i, k, d, s in plain(docs, items))


def test_blocks_change_nothing_and_tables_may_be_empty(spark, monkeypatch):
    rng = random.Random(3)
    docs, items = list(corpus(rng, 80)), list(corpus(rng, 30))
    docs_df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 10)
    monkeypatch.setattr(ranking, "POSTINGS", 50)
    assert len(list(ranking.item_blocks(items_df))) > 3
    got = sorted(tuple(r) for r in ranking.best_documents(docs_df, items_df).collect())
    assert got == sorted(x[1:] for x in plain(docs, items))
    assert ranking.best_documents(docs_df.limit(0), items_df).count() == 0 and ranking.best_documents(docs_df, items_df.limit(0)).count() == 0


def test_terms_are_those_of_the_pattern():
    for text in (None, "", "A_b C9\x00d\x7fÉé É x y z😀", "".join(map(chr, range(300)))):
        assert [t.decode() for t in ranking.terms((text or "").encode())] == plain_terms(text)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    n, weights = 4_000, np.array([9_000] * 40 + [300] * 40)
    own = [np.unique(rng.integers(0, 80, 6)) for _ in range(n)]
    own = [np.unique(np.concatenate([o[o >= 40], o[o < 40][:1]])) for o in own]
    own = [o if len(o) else np.array([50]) for o in own]
    sizes = np.array([len(o) for o in own])
    values = rng.integers(1, 1_000_000, sizes.sum())
    part = ranking.Range(np.arange(n), np.zeros(n, bool), sizes, np.concatenate(own), values, weights)
    query, best = np.array([3, 55]), ranking.Best()
    part.search(query, weights[query], best)
    ends = np.cumsum(sizes)
    scores = [sum(int(weights[t]) * int(v) for t, v in zip(own[d], values[ends[d] - sizes[d] : ends[d]]) if t in query) for d in range(n)]
    want = sorted(((-s, d) for d, s in enumerate(scores) if s))[:10]
    assert [(-s, d) for s, d in zip(best.scores.tolist(), best.ids.tolist())] == want
    assert part.opened < 0.1 * n / ranking.LEAF  # documents of one heaviest term stand together
    for below, above in zip(part.levels, part.levels[1:]):
        assert (np.repeat(above, ranking.FAN, axis=0)[: len(below)] >= below).all()
