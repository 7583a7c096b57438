"""Ranked lexical search: the best documents of each item, by branch and bound over trees of term maxima.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased. A document's score for an item sums, over the item's terms with
repeats, the term's weight times a saturating function of its count and the
document's length (`impacts`), all in 64-bit integers but for the logarithm.

Index: a first pass reads each text once and writes the length of each document
and its counts of the items' terms. Documents and lengths in all, and documents
by term, are sums over that table. Tasks then read it in ranges of RANGE
documents, ordered by their heaviest term so that like ones stand together. Each
range has for each of its terms a tree of the greatest impact in nodes of LEAF
documents, of FAN of those nodes, and so on up to the range. An item's bound for a
node is the weighted sum of its terms' maxima there, which no document of the
node exceeds.

Search: a range whose root lies below the item's tenth score so far is passed
over. Else the node of the highest bound is opened next, into its children or, a
leaf, into the exact scores of its documents, until the highest bound left lies
below the tenth score. Nodes at the very tenth score are opened too, as a tie may
go to a smaller doc_id there. A task carries its tens from range to range, so
later ranges are pruned by earlier ones, and hands on ten rows an item. Those are
cut to ten by salt and then by item.

Items go to the workers in blocks that end at BLOCK_TERMS terms, each in a pass of its own, so
no more than that is collected or broadcast.

Defined cases: a null text has no terms; an item without terms, or whose terms no
document holds, gets no rows; rows of the benchmark are items of their own, even
with equal ids; rows of documents are ranked one by one, so copies get equal
scores and ranks in turn; equal scores go by ascending doc_id, null ids last;
an empty table on either side gives no rows; a very long text is held whole, at
some 100 bytes of a worker's memory a word; other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlode.llm.common import shared, small_batches, written

BEST = 10
BLOCK_TERMS = 1 << 17
RANGE, LEAF, FAN = 1 << 13, 64, 8
POSTINGS = 1 << 21  # a range ends early at so many
SALTS = 32

#: ASCII bytes that are no letter or digit become spaces, A-Z become a-z; bytes of other characters stay.
_BYTES = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))

COUNTED = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "nr long, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 75 + (75 * lengths * n_docs) // n_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Items:
    """A block of items: for each (nr, item_id), its terms' numbers and how often it has them."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.keys: list[tuple] = []
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        self.size = 0

    def add(self, nr: int, item_id, text: str | None) -> None:
        found = Counter(terms((text or "").encode()))
        if found:
            self.keys.append((nr, item_id))
            self.terms.append(np.array([self.numbers.setdefault(t, len(self.numbers)) for t in found], np.int64))
            self.repeats.append(np.array(list(found.values()), np.int64))
            self.size += len(found)


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """All items in blocks of some BLOCK_TERMS terms."""
    block = Items()
    for nr, (item_id, text) in enumerate(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator()):
        block.add(nr, item_id, text)
        if block.size >= BLOCK_TERMS:
            yield block
            block = Items()
    if block.keys:
        yield block


def counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Each document's number of terms, and which of the numbered ones it has how often."""
    get = shared(docs.sparkSession, numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = get()
        for batch in batches:
            lengths, own, often = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = terms(text.as_py() or b"")
                found = Counter(words)
                mine = [(known[t], found[t]) for t in found.keys() & known.keys()]
                lengths.append(len(words))
                own.append([t for t, _ in mine])
                often.append([c for _, c in mine])
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip((lengths, own, often), kinds))], ["doc_id", "n", "terms", "counts"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, COUNTED)


class Range:
    """A range of documents with a tree of maxima for each of its terms."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, sizes: np.ndarray, terms_: np.ndarray, values: np.ndarray, weights: np.ndarray) -> None:
        """ids, missing (no id) and sizes by document; terms_ and values (impacts) of the documents in turn."""
        self.vocabulary, local = np.unique(terms_, return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), sizes)
        at = np.lexsort((weights[terms_] * values, owner))  # each document's heaviest term comes last
        heaviest = terms_[at[np.cumsum(sizes) - 1]]  # sizes are 1 or more
        order = np.argsort(heaviest, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        by_place = np.argsort(place[owner], kind="stable")
        self.ids, self.missing = ids[order], missing[order]
        self.terms, self.values = local[by_place], values[by_place]
        self.ends = np.concatenate([[0], np.cumsum(sizes[order])])
        # level 0 has the leaves, the last one the range itself; a column for each term
        leaves = -(-len(ids) // LEAF)
        level = np.zeros((leaves, len(self.vocabulary)), np.int32)
        np.maximum.at(level, (np.repeat(np.arange(len(ids)) // LEAF, sizes[order]), self.terms), self.values)
        self.levels = [level]
        while len(level) > 1:
            level = np.maximum.reduceat(level, np.arange(0, len(level), FAN), axis=0)
            self.levels.append(level)
        self.opened = 0
        self._weight = np.zeros(len(self.vocabulary), np.int64)

    def scores(self, leaf: int) -> tuple[int, np.ndarray]:
        """The leaf's first document and the exact scores of its documents, by the weights that are set."""
        first, last = leaf * LEAF, min(len(self.ids), (leaf + 1) * LEAF)
        a, b = self.ends[first], self.ends[last]
        return first, np.add.reduceat(self._weight[self.terms[a:b]] * self.values[a:b], self.ends[first:last] - a)

    def search(self, own: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Put into best whatever belongs there, for an item of the terms `own` with these weights."""
        at = np.searchsorted(self.vocabulary, own)
        here = at < len(self.vocabulary)
        here[here] = self.vocabulary[at[here]] == own[here]
        at, weights = at[here], weights[here]
        bound = lambda depth, a, b: self.levels[depth][a:b, at].astype(np.int64) @ weights
        top = len(self.levels) - 1
        root = int(bound(top, 0, 1)[0]) if len(at) else 0
        if root < max(1, best.least()):
            return
        self._weight[at] = weights
        waiting = [(-root, top, 0)]
        while waiting and -waiting[0][0] >= max(1, best.least()):
            _, depth, node = heapq.heappop(waiting)
            if depth == 0:
                self.opened += 1
                first, scores = self.scores(node)
                good = np.flatnonzero(scores >= max(1, best.least()))
                if len(good):
                    best.add(scores[good], self.ids[first + good], self.missing[first + good])
                continue
            a = node * FAN
            for k, value in enumerate(bound(depth - 1, a, a + FAN).tolist()):
                if value >= max(1, best.least()):
                    heapq.heappush(waiting, (-value, depth - 1, a + k))
        self._weight[at] = 0


class Best:
    """The highest scores so far, at most BEST, equal ones by id."""

    def __init__(self) -> None:
        self.scores, self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """The score that a document must reach to be among them."""
        return int(self.scores[-1]) if len(self.scores) == BEST else 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores, ids, missing = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort((ids, missing, -scores))[:BEST]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def ranges(batches: Iterator[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[Range]:
    """Ranges of the rows of counted(), without documents that have none of the terms."""
    waiting, docs, postings = [], 0, 0

    def made() -> Range:
        ids, missing, lengths, sizes, own, often = (np.concatenate(x) for x in zip(*waiting))
        return Range(ids, missing, sizes, own, impacts(often, np.repeat(lengths, sizes), n_docs, n_terms), weights)

    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        own, often = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (2, 3))
        kept, ends = np.flatnonzero(sizes), np.cumsum(sizes)
        ids, lengths = batch.column(0).fill_null(0).to_numpy(), batch.column(1).to_numpy()
        missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        for part in np.array_split(kept, max(1, len(kept) // 256)):
            if not len(part):
                continue
            a, b = ends[part[0]] - sizes[part[0]], ends[part[-1]]
            waiting.append((ids[part], missing[part], lengths[part], sizes[part], own[a:b], often[a:b]))
            docs, postings = docs + len(part), postings + b - a
            if docs >= RANGE or postings >= POSTINGS:
                yield made()
                waiting, docs, postings = [], 0, 0
    if waiting:
        yield made()


def block_best(docs: DataFrame, block: Items) -> DataFrame:
    """nr, item_id, doc_id, score: what each task found best, at most BEST rows an item and task."""
    spark = docs.sparkSession
    table = written(counted(docs, block.numbers))
    n_docs, n_terms = table.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = table.select(F.explode("terms").alias("term")).groupBy("term").count()  # a row for each of the block's terms
    weights = np.zeros(len(block.numbers), np.int64)
    for term, n in df.collect():
        weights[term] = weight(n_docs, n)
    get = shared(spark, (block.keys, block.terms, block.repeats, weights, n_docs, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, own, repeats, weights, n_docs, n_terms = get()
        best = [Best() for _ in keys]
        for part in ranges(batches, weights, n_docs, n_terms):
            for k in range(len(keys)):
                part.search(own[k], repeats[k] * weights[own[k]], best[k])
        for k, b in enumerate(best):
            if len(b.scores):
                columns = [pa.array([keys[k][0]] * len(b.ids), pa.int64()), pa.array([keys[k][1]] * len(b.ids), pa.int64()), pa.array(b.ids, mask=b.missing), pa.array(b.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["nr", "item_id", "doc_id", "score"])

    return table.mapInArrow(run, FOUND)


def top(found: DataFrame, *by) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= BEST)


def best_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's BEST highest-scoring documents."""
    out = docs.sparkSession.createDataFrame([], FOUND)
    for block in item_blocks(items):
        out = out.unionByName(block_best(docs, block))
    salted = top(out.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), "nr", "salt")
    return top(salted, "nr").select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir):
    return best_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH q AS (SELECT nr, item_id, term, count(*) AS q FROM (
       SELECT nr, item_id, unnest(ws) AS term FROM (SELECT row_number() OVER () AS nr, item_id, {_TERMS} AS ws FROM benchmark)) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS ws FROM documents),
c AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS words FROM d WHERE len(ws) > 0),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term),
s AS (SELECT nr, item_id, row, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), c GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY nr ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= {BEST}
"""
