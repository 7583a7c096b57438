"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Fit, on FIT_ROWS labelled rows at most (those of the smallest doc_id hashes, so
the same at every layout): a lexicon of words and word beginnings that lean to
the toxic class, then trees over the features below, then an isotonic map from
raw scores to probabilities. The score is 0.98 of the map's value plus 0.02 of
the trees' own probability, which keeps the order of texts within a flat piece
of the map; so it lies within 0.02 of the calibrated value. Lexicon, trees and map are cross-fitted in FOLDS:
a row's features come from a lexicon, and its raw score for the map from trees,
that have not seen the row.

Features of a text: densities and sums over lexicon hits, hits near words of
the second person, capitals, punctuation, obfuscated spellings (marks or digits
inside a word that give a lexicon word), length. Scoring is one narrow pass.

Defined cases: a null text is empty; an empty text gets the score of its
all-zero features; labels that are null or neither 0 nor 1, or of unknown
documents, are unused; of repeated labels one is used; with fewer than two
labelled classes every score is the share of toxic ones (0 with no labels);
repeated rows give a row each; an empty table gives no rows; other columns play
no part. A tie between cuts of a tree goes to the first feature and cut, one
between labelled rows' hashes to the smaller doc_id; a very long text is split
whole, at some 100 bytes of a worker's memory a word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import crc_mod, shared, small_batches

FIT_ROWS = 8_000
FOLDS = 4
THRESHOLD = 0.3
PREFIX = 5
NEAR = 4
CACHE = 200_000

# Words of the second person, and letters that marks and digits stand for.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi vous votre ton tes usted ustedes tú tus vos".split())
LEET = str.maketrans("013457@$!", "oieastasi", "*-_.~'")
MARKS = ".,;:!?\"'#$%&*|()[]{}<>"

NAMES = (
    "hits_a_word", "hits", "weight_a_word", "weight", "strongest", "starts_a_word", "starts", "start_weight", "near_second",
    "second_a_word", "caps_words", "caps_letters", "bang", "question", "marks", "obfuscated", "digits", "log_words", "mean_word",
)


def entries(word: str) -> tuple[str, str | None]:
    """The lexicon entries of a bare word: itself and, if it is long enough, its beginning."""
    return word, f"{word[:PREFIX]}*" if len(word) > PREFIX else None


def bare(word: str) -> str:
    return word.strip(MARKS).lower()


def lexicon(texts: list[str], toxic: np.ndarray, least: int = 2, lead: float = 2.0) -> dict[str, float]:
    """Entry -> log ratio of its document shares, for entries that lean clearly to the toxic class."""
    seen = (Counter(), Counter())
    for text, t in zip(texts, toxic):
        words = {bare(w) for w in set(text.split())}
        seen[int(t)].update(e for e in set(chain.from_iterable(map(entries, words))) if e)
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    out = {}
    for e, k in seen[1].items():
        if k >= least:
            weight = float(np.log((k + 0.5) / (n1 + 1)) - np.log((seen[0][e] + 0.5) / (n0 + 1)))
            if weight >= lead:
                out[e] = weight
    return out


class WordKinds(dict):
    """word -> row of its own features: hit, start hit, second person, all capitals, obfuscated hit."""

    def __init__(self, lex: dict[str, float]) -> None:
        self.lex, self.rows, self.known = lex, [], {}

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        low = bare(word)
        whole, start = entries(low)
        hit, begin, hidden = self.lex.get(whole, 0.0), self.lex.get(start, 0.0) if start else 0.0, 0.0
        if not hit and low and not low.isalpha():
            hit = hidden = self.lex.get(low.translate(LEET), 0.0)
        row = (hit, begin, float(low in SECOND), float(len(low) > 1 and word.isupper()), float(hidden > 0))
        got = self.known.get(row)
        if got is None:
            got = self.known[row] = len(self.rows)
            self.rows.append(row)
        self[word] = got
        return got


def features(texts: list[str], kinds: WordKinds) -> np.ndarray:
    """(texts, NAMES)."""
    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ids = np.fromiter(map(kinds.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    table = np.array(kinds.rows).reshape(-1, 5)
    n, owner = len(texts), np.repeat(np.arange(len(texts)), sizes)
    out = np.zeros((n, len(NAMES)))
    words = np.maximum(sizes, 1)
    total = lambda x, where=None: np.bincount(owner if where is None else owner[where], x if where is None else x[where], n)
    if len(ids):
        hit, begin, second, caps, hidden = table[ids].T
        found = np.flatnonzero(hit > 0)
        out[:, 1], out[:, 3] = total((hit > 0) * 1.0), total(hit)
        np.maximum.at(out[:, 4], owner[found], hit[found])
        out[:, 6], out[:, 7] = total((begin > 0) * 1.0), total(begin)
        you = np.concatenate([[0], np.cumsum(second)])
        ends = np.cumsum(sizes)
        lo, hi = np.maximum(found - NEAR, (ends - sizes)[owner[found]]), np.minimum(found + NEAR + 1, ends[owner[found]])
        out[:, 8] = np.bincount(owner[found], (you[hi] > you[lo]) * 1.0, n)
        out[:, 9], out[:, 10], out[:, 15] = total(second) / words, total(caps) / words, total(hidden) / words
        out[:, 0], out[:, 2], out[:, 5] = out[:, 1] / words, out[:, 3] / words, out[:, 6] / words
    chars = np.fromiter((max(1, len(t)) for t in texts), np.float64, n)
    count = lambda marks: np.array([sum(map(t.count, marks)) for t in texts], np.float64)
    out[:, 11] = np.array([_capitals(t) for t in texts]) / chars
    out[:, 12], out[:, 13], out[:, 14], out[:, 16] = count("!") / chars, count("?") / chars, count("*#$%&|") / chars, count("0123456789") / chars
    out[:, 17], out[:, 18] = np.log1p(sizes), np.where(sizes > 0, chars / words, 0)
    return out


_UPPER = bytes(255 if 65 <= b <= 90 else 0 for b in range(256))


def _capitals(text: str) -> int:
    return text.encode("utf-8", "replace").translate(_UPPER).count(b"\xff")


class Trees:
    """Boosted regression trees on the logistic loss, over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.12, bins: int = 32, ridge: float = 2.0, least: float = 2.0) -> None:
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base, self.depth, self.trees = float(np.log(share / (1 - share))), depth, []
        raw = np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            tree, leaf = self._grow(binned, y - p, p * (1 - p), bins, ridge, least)
            self.trees.append((*tree, leaf[1] * rate))
            raw += leaf[1][leaf[0]] * rate

    def _grow(self, binned, grad, hess, bins, ridge, least):
        """Level by level; a node that gains nothing sends all its rows to the left."""
        node = np.zeros(len(grad), np.int64)
        feature, cut = np.zeros(2**self.depth, np.int64), np.full(2**self.depth, bins + 1)
        for level in range(self.depth):
            first, many = 2**level, 2**level
            best = np.full(many, 1e-6)
            for f in range(binned.shape[1]):
                cell = node * (bins + 1) + binned[:, f]
                g = np.bincount(cell, grad, many * (bins + 1)).reshape(many, -1)
                h = np.bincount(cell, hess, many * (bins + 1)).reshape(many, -1)
                gl, hl, g, h = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1], g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                gain[(hl < least) | (h - hl < least)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(many), at]
                better = top > best
                best[better] = top[better]
                feature[first : first + many][better], cut[first : first + many][better] = f, at[better]
            here = first + node
            node = node * 2 + (binned[np.arange(len(node)), feature[here]] > cut[here])
        g, h = np.bincount(node, grad, 2**self.depth), np.bincount(node, hess, 2**self.depth)
        return (feature, cut), (node, g / (h + ridge))

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                here = 2**level + node
                node = node * 2 + (binned[rows, feature[here]] > cut[here])
            out += leaf[node]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best non-decreasing map from raw scores to labels, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, sum of raw
    for r, t in zip(raw[order], y[order]):
        blocks.append([float(t), 1.0, float(r)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, s = blocks.pop()
            a = blocks[-1]
            blocks[-1] = [(a[0] * a[1] + m * w) / (a[1] + w), a[1] + w, a[2] + s]
    return np.array([s / w for _, w, s in blocks]), np.array([m for m, _, _ in blocks])


class Model:
    def __init__(self, texts: list[str], toxic: np.ndarray) -> None:
        self.share = float(toxic.mean()) if len(toxic) else 0.0
        self.trees = None
        if len(set(toxic.tolist())) < 2:
            self.lexicon = {}
            return
        n = len(texts)
        fold = np.random.default_rng(3).permutation(n) % FOLDS
        parts = [lexicon([t for t, f in zip(texts, fold) if f != k], toxic[fold != k]) for k in range(FOLDS)]
        x = np.zeros((n, len(NAMES)))
        for k in range(FOLDS):
            x[fold == k] = features([t for t, f in zip(texts, fold) if f == k], WordKinds(parts[k]))
        raw = np.zeros(n)
        for k in range(FOLDS):
            raw[fold == k] = Trees(x[fold != k], toxic[fold != k]).raw(x[fold == k])
        self.lexicon, self.trees = lexicon(texts, toxic), Trees(x, toxic)
        self.knots = isotonic(raw, toxic)

    def kinds(self) -> WordKinds:
        return WordKinds(self.lexicon)

    def scores(self, texts: list[str], kinds: WordKinds) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        raw = self.trees.raw(features(texts, kinds))
        # a little of the raw probability keeps the order within a flat piece of the map
        return 0.98 * np.interp(raw, *self.knots) + 0.02 / (1 + np.exp(-raw))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn from the rows of labels whose documents are not held out."""
    wanted = (
        labels.where("toxic in (0, 1)").where(crc_mod("doc_id", 4) != 2)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # `rows` rows at most
    got = sorted((r[0], r[1], r[2]) for r in found.collect())
    return Model([t for _, _, t in got], np.array([float(y) for _, y, _ in got]))


CHARS_AT_ONCE = 1 << 20


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    begin, texts, size = 0, [], 0
    for n, text in enumerate(batch.column(column)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHARS_AT_ONCE:
            yield begin, texts
            begin, texts, size = n + 1, [], 0
    if texts:
        yield begin, texts


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model_of = shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of()
        kinds = model.kinds()
        for batch in batches:
            for begin, texts in _chunks(batch, 2):
                got = model.scores(texts, kinds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), batch.column(1).slice(begin, len(texts)), pa.array(got), pa.array((got >= THRESHOLD).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 4) == 2).alias("held_out"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, that are not predicted toxic."""
    model_of = shared(docs.sparkSession, model)
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of()
        kinds = model.kinds()
        for batch in batches:
            for begin, texts in _chunks(batch, column):
                yield batch.slice(begin, len(texts)).filter(pa.array(model.scores(texts, kinds) < THRESHOLD))

    return small_batches(docs).mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    return score(docs, fit(docs, read("labels")))
