"""Near-duplicate classes by BagMinHash, banding and exact multiset overlap.

A document is the bag of its five-word shingles. For each shingle, the weight
axis is cut into the dyadic blocks (0, 1], (1, 2], (2, 4], ...; each block has
a Poisson process of its own, whose points carry a time, a discretised weight
and a signature position, all drawn from the hash of shingle and block. A bag
sees a point if its weight for the shingle reaches the point's weight; the
signature keeps the earliest visible time at each position. Two bags agree at a
position with a probability of exactly their weighted Jaccard similarity. A
process ends once its time is past the latest of the signature, so large bags
need about one point a shingle.

Different texts are banded, and all pairs of a bucket that can be similar are
found without forming all pairs: buckets up to SMALL members give theirs. In
larger ones, members are linked to a pivot. Then, as long as a bucket falls into
several components, only members of those matter, and of them only nodes that
can have a partner: one that is similar enough shares SIMILARITY of its elements
with others, so elements that no other such node has rule a node out. The rest
are linked to the pivot with the fewest elements of its own, and what is still
apart is joined on rare elements: with elements in order of frequency, two bags
that are similar enough have an element in common among the first few of each
(prefix filter). No pair of different components is passed over. Pairs are
verified on the shingles themselves. Classes are the connected components of
verified pairs.

Defined cases: a null text counts as empty; texts that are equal but for case
and white space are one class, empty ones among themselves too; a text under
five words is one shingle; repeated rows give a row each; of equal doc_ids or
sizes the smaller node counts as first, so a tie can't change a class; an empty
table gives no rows; a text is handled whole, at some 300 bytes of a worker's
memory a word; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import erase, kept, small_batches, written
from gridlode.llm.components import components
from gridlode.llm.shingles import Words, bags, mix, occurrences, shingle

SIMILARITY = 0.8
BANDS, ROWS = 26, 5
SMALL = 8
CHUNK = 1 << 20  # characters handled at once

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(owner: np.ndarray, found: np.ndarray, weights: np.ndarray, docs: int, size: int) -> np.ndarray:
    """(docs, size) times of the earliest visible points; inf where there are none."""
    best = np.full(docs * size, np.inf)
    blocks = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1
    at = np.repeat(np.arange(len(found)), blocks)
    block = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)
    width = np.maximum(low, 1)
    key = mix(found[at] + (block.astype(np.uint64) + np.uint64(1)) * _B)
    doc, weight, time = owner[at], weights[at], np.zeros(len(at))
    latest = np.full(docs, np.inf)
    step = 0
    while len(key):
        step += 1
        draw = mix(key + np.uint64(step * int(_A) % 2**64))
        time = time - np.log(_uniform(draw)) / width
        alive = time < latest[doc]
        key, draw, time, doc, weight, low, width = (x[alive] for x in (key, draw, time, doc, weight, low, width))
        if not len(key):
            break
        other = mix(draw ^ _C)
        place = (other % np.uint64(size)).astype(np.int64)
        level = low + 1 + ((other >> np.uint64(32)) % width.astype(np.uint64)).astype(np.int64)
        seen = level <= weight
        np.minimum.at(best, (doc * size + place)[seen], time[seen])
        live = np.unique(doc) if len(doc) < docs else np.arange(docs)
        latest[live] = best.reshape(docs, size)[live].max(axis=1)
    return best.reshape(docs, size)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[tuple[list, list[str]]]:
    """Keys (doc_id, row) and texts from rows of (doc_id, text, row), some `limit` characters at a time."""
    for batch in batches:
        keys, texts, size = [], [], 0
        for doc, text, row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            keys.append((doc, row))
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= limit:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts


def _node(words: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits that name each document's word sequence."""
    ends = np.cumsum(sizes)
    return [xxhash.xxh3_128_digest(words[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist())]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = kept("words", Words)
    for keys, texts in _chunks(batches):
        words, sizes = cache.hashes(texts)
        owner, found, weights = bags(*shingle(words, sizes))
        times = signatures(owner, found, weights, len(texts), BANDS * ROWS)
        sig = (mix(times.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        key = np.zeros((len(texts), BANDS), np.uint64)
        for r in range(ROWS):
            key = mix(key + sig.reshape(len(texts), BANDS, ROWS)[:, :, r].astype(np.uint64) * _A + np.arange(1, BANDS + 1, dtype=np.uint64) * _C)
        full = sizes > 0
        bands = [k.tolist() if f else [] for k, f in zip(key.view(np.int64), full)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array(_node(words, sizes), pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "row", "node", "bands"],
        )


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = kept("words", Words)
    for keys, texts in _chunks(batches):
        words, sizes = cache.hashes(texts)
        owner, found, weights = bags(*shingle(words, sizes))
        cut = np.searchsorted(owner, np.arange(len(texts) + 1))
        bag = [occurrences(found[a:b], weights[a:b]).tobytes() for a, b in zip(cut, cut[1:])]
        size = pa.array([len(b) // 8 for b in bag], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(_node(words, sizes), pa.binary()), pa.array(bag, pa.binary()), size], ["node", "bag", "size"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, element) for each element of each bag."""
    for batch in batches:
        for node, bag in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = np.frombuffer(bag.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([node] * len(found), pa.binary()), pa.array(found)], ["node", "element"])


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            got.append(both / (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.float64())], ["a", "b", "similarity"])


def _several(labelled: DataFrame) -> DataFrame:
    """Keys of the buckets that hold more than one component."""
    return written(labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair once, a < b."""
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def row_hash(columns: Iterable[str]) -> Column:
    """64 bits that name a row by these columns; never null, and a null is no other value's like."""
    columns = list(columns)
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))


class Duplicates:
    """The tables that lead to classes: signed documents, nodes, verified links. Rows are told apart by `columns`."""

    def __init__(self, docs: DataFrame, similarity: float = SIMILARITY, columns: Iterable[str] = ("doc_id", "text")) -> None:
        self.similarity = similarity
        texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), row_hash(columns).alias("row"))
        self.signed = written(texts.mapInArrow(_signed, "doc_id long, row long, node binary, bands array<long>"))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))  # null ids last
        nodes = self.signed.groupBy("node").agg(first.alias("first"), F.first("bands").alias("bands"), F.count("*").alias("copies"))
        self.nodes = written(nodes.select("node", "first", F.col("first.doc_id").alias("doc_id"), "copies", "bands"))
        keyed = self.nodes.select("node", F.explode("bands").alias("key"))
        pivot = F.min(F.struct(F.xxhash64("node"), "node"))["node"]  # mostly the same in all bands of a group
        buckets = written(keyed.groupBy("key").agg(F.count("*").alias("n"), pivot.alias("pivot")).where("n > 1"))
        self.members = written(keyed.join(buckets, "key"))
        wanted = written(self.nodes.join(self.members.select("node").distinct(), "node", "left_semi").select("node", F.col("first.row").alias("row")))
        # by row, as a doc_id may be null or shared; another text of the same row hash goes with the node
        bags_ = texts.join(wanted.select("row").distinct(), "row", "left_semi").select("doc_id", "text", "row").mapInArrow(_shingled, "node binary, bag binary, size long")
        self.bags = written(bags_.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("bag").alias("bag"), F.first("size").alias("size")))
        erase(buckets, wanted)
        self.links, self.labels = self._linked()
        erase(self.members, self.bags)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        a = self.bags.select(F.col("node").alias("a"), F.col("bag").alias("x"))
        b = self.bags.select(F.col("node").alias("b"), F.col("bag").alias("y"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
        return both.mapInArrow(_similarity, "a binary, b binary, similarity double").where(F.col("similarity") >= self.similarity)

    def _linked(self) -> tuple[DataFrame, DataFrame]:
        """Verified links, and the label of each linked node."""
        small = self.members.where(F.col("n") <= SMALL).select("key", "node")
        pairs = small.select("key", F.col("node").alias("a")).join(small.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b")
        large = self.members.where(F.col("n") > SMALL)
        star = large.select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        links = written(self._verified(_ordered(pairs.unionByName(star))))
        labels = components(links.select("a", "b"))
        for more in (self._to_best_pivots, self._by_rare_elements):
            able = self._able(large.select("key", "node"), labels)
            if able.isEmpty():
                break
            found = written(self._verified(_ordered(more(able))))
            erase(able)
            if found.isEmpty():
                continue
            before, links = links, written(links.unionByName(found))
            labels, old = self._joined(labels, found), labels
            erase(before, found, old)
        return links, labels

    def _joined(self, labels: DataFrame, found: DataFrame) -> DataFrame:
        """labels after more links: components of the components that these join."""
        of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"_{side}"))
        both = found.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
        over = components(both.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
        over = over.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        known = labels.join(over, labels["label"] == over["_node"], "left").select("node", F.coalesce("_label", "label").alias("label"))
        fresh = over.join(labels.select("node"), over["_node"] == labels["node"], "left_anti").select(F.col("_node").alias("node"), F.col("_label").alias("label"))
        return written(known.unionByName(fresh))

    def _able(self, large: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of buckets with several components, without nodes that share too little to have a partner."""
        labelled = large.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        apart = written(labelled.join(_several(labelled), "key", "left_semi"))
        nodes = apart.select("node", "label").distinct()
        found = self.bags.join(nodes.select("node"), "node").select("node", "bag").mapInArrow(_elements, "node binary, element long")
        own = found.groupBy("element").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count("*").alias("own"))
        sizes = self.bags.select("node", "size").join(written(own), "node", "left").select("node", "size", F.coalesce("own", F.lit(0)).alias("own"))
        able = apart.join(sizes, "node").where(F.col("size") - F.col("own") >= self.similarity * F.col("size"))
        able = written(able)
        out = written(able.join(_several(able), "key", "left_semi"))
        erase(apart, able)
        return out

    def _to_best_pivots(self, able: DataFrame) -> DataFrame:
        """Pairs of each bucket's members with the one that has the smallest share of elements of its own."""
        best = F.min(F.struct(F.col("own") / F.col("size"), F.xxhash64("node"), "node", "label")).alias("p")
        pivots = written(able.groupBy("key").agg(best))
        return able.join(pivots, "key").where(F.col("label") != F.col("p.label")).select(F.col("node").alias("a"), F.col("p.node").alias("b"))

    def _by_rare_elements(self, able: DataFrame) -> DataFrame:
        """All pairs of different components that can be similar enough.

        With n and m >= n elements, such bags have s / (1 + s) (n + m) elements in common at least: no less
        than 2 s / (1 + s) n, and than s m. So one of them is among the first n - 2 s / (1 + s) n + 1
        of the smaller and the first m - s m + 1 of the larger, and behind the first one, with it, either
        bag has that many left.
        """
        nodes = written(able.select("node", "label", "size").distinct())
        found = written(self.bags.join(nodes.select("node"), "node").select("node", "bag").mapInArrow(_elements, "node binary, element long"))
        often = written(found.groupBy("element").agg(F.count("*").alias("n")))
        ranked = found.join(often, "element").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "element"))).alias("elements"))
        least = lambda share: F.col("size") - F.ceil(share * F.col("size") - 1e-9) + 1
        s = self.similarity
        first = ranked.join(nodes, "node").select("node", "label", "size", least(2 * s / (1 + s)).alias("short"), F.posexplode(F.slice("elements", 1, least(s).cast("int"))).alias("place", "e"))
        first = written(first.where("e.n > 1").select("node", "label", "size", F.col("e.element").alias("element"), (F.col("size") - F.col("place")).alias("left"), (F.col("place") < F.col("short")).alias("early")))
        x, y = (first.select("element", "early", *(F.col(c).alias(f"{c}_{m}") for c in ("node", "label", "size", "left"))) for m in "xy")
        common = F.ceil(s / (1 + s) * (F.col("size_x") + F.col("size_y")) - 1e-9)
        on = (F.least("left_x", "left_y") >= common) & (F.col("size_x") >= s * F.col("size_y") - 1e-9) & (F.struct("size_x", "node_x") < F.struct("size_y", "node_y")) & (F.col("label_x") != F.col("label_y"))
        return x.where("early").drop("early").join(y.drop("early"), "element").where(on).select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))

    def _labelled(self) -> DataFrame:
        label = F.coalesce("label", "node")
        return self.nodes.select("node", "doc_id", "first", "copies").join(self.labels, "node", "left").select("node", "doc_id", "first", "copies", label.alias("label"))

    def firsts(self) -> DataFrame:
        """The row hash of one row of each class: the smallest doc_id's, null ids last."""
        return self._labelled().groupBy("label").agg(F.min("first")["row"].alias("row")).select("row").distinct()

    def classes(self) -> DataFrame:
        """doc_id, class_id (the smallest doc_id of the class), class_size (its rows), n_links and copies for each row.

        n_links are the other texts that this one was verified to be similar to: all of
        them in buckets of SMALL texts at most, in larger ones those that hold its class
        together, as all pairs of a large group are never made. copies are the rows of
        its very text, itself included.
        """
        nodes = self._labelled()
        first = nodes.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
        ends = self.links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        of_node = nodes.join(first, "label").join(ends, "node", "left").select("node", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies")
        return self.signed.select("doc_id", "node").join(of_node, "node").select("doc_id", "class_id", "class_size", "n_links", "copies")


def query(spark, sf_dir):
    return Duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).classes()
