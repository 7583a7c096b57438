"""Benchmark decontamination by CGK embedding, bit sampling and exact edit distance.

Texts and items are word sequences (lower case, split at white space). A
document contains an item if some stretch of it is within a word edit distance
of floor((1 - similarity) * words of the item).

The CGK embedding walks over a sequence with one random bit for each step and
word, advancing when the bit is set; sequences at a small edit distance agree
at many steps. An item of over PIECE words is looked for by its pieces, of equal
length: of edits within the item's bound, some piece has no more than its own
bound. Items and pieces are classed by length. In each class, a repeat samples
STEPS_SAMPLED steps of the walk, and a window whose sampled words are all those
of a piece becomes a candidate. The number of repeats is raised until pieces
edited as heavily as allowed, with other words behind them, are found with the
target recall, to MOST_REPEATS. A class that misses the target even so takes all
windows for candidates that hold enough of the piece's word pairs (see below),
which loses none. Items too short for an edit are looked up by a hash of their
words, all of them. Candidates are verified by the edit distance itself, of the
whole item, over the window and its surroundings.

Every position of every text starts a window. Windows that hold too few word
pairs of the benchmark are skipped before the walk: an edit breaks two pairs at
most, so n words at distance d still hold n - 1 - 2 d of them, and none is lost.

Items go to the workers in blocks of BLOCK_WORDS words at most, each block in a pass of its
own, so no more than that is ever broadcast. The passes are narrow.

Defined cases: a null text or item is empty; an empty item is contained in
nothing; a tie between places goes to the first; repeated rows of documents and
items give a row each; empty tables give no rows; a very long text is held whole,
at some 150 bytes of a worker's memory a word, and all else in parts of CELLS
numbers, however long an item is; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import shared, small_batches
from gridlode.llm.shingles import mix

SIMILARITY = 0.8
RECALL = 0.97
STEPS_SAMPLED = 2
MOST_REPEATS = 512
BITS_A_PAIR, OWN_BITS = 16, 11
BLOCK_WORDS = 1 << 20
TRIALS = 256  # edited items from which a class's repeats are set
WORDS_AT_ONCE = 1 << 19
PIECE = 128
CELLS = 1 << 22
OTHER, PAD = 0, 1

_SEED = 0x5851F42D4C957F2D
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def edit_distances(items: np.ndarray, lengths: np.ndarray, stretches: np.ndarray) -> np.ndarray:
    """For each row, the least edit distance of the item's first words to any part of the stretch."""
    n, most = items.shape
    kind = np.int16 if most + stretches.shape[1] < 30_000 else np.int32
    steps = np.arange(most + 1, dtype=kind)
    last = np.broadcast_to(steps, (n, most + 1)).copy()
    rows, best = np.arange(n), lengths.astype(kind)
    for t in range(stretches.shape[1]):
        now = last + 1
        now[:, 0] = 0
        np.minimum(now[:, 1:], last[:, :-1] + (items != stretches[:, t, None]), out=now[:, 1:])
        now = np.minimum.accumulate(now - steps, axis=1) + steps
        best = np.minimum(best, now[rows, lengths])
        last = now
    return best


def pair_code(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return (a.astype(np.int64) * 0x9E3779B1 + b.astype(np.int64) * 0x85EBCA77 >> 12) & ((1 << bits) - 1)


def allowed(sizes, similarity: float):
    return np.floor((1 - similarity) * np.asarray(sizes) + 1e-9).astype(np.int64)


def own_pairs(item: np.ndarray) -> np.ndarray:
    """Which word pairs the item has, by hash: a clash only lets a window through."""
    out = np.zeros(1 << OWN_BITS, bool)
    out[pair_code(item[:-1], item[1:], OWN_BITS)] = True
    return out


class LengthClass:
    """Pieces of similar length, their walks' samples and the repeats that the recall takes."""

    def __init__(self, members: list[int], pieces: list[np.ndarray], bits, similarity: float, recall: float) -> None:
        sizes = np.array([len(pieces[m]) for m in members])
        self.members, self.low, self.high = np.array(members), int(sizes.min()), int(sizes.max())
        self.sizes = sizes
        self.allowed = allowed(sizes, similarity)
        self.need = int((sizes - 1 - 2 * self.allowed).min())  # word pairs that survive the edits
        self.table = np.full((len(members), self.high), -1, np.int64)
        for k, m in enumerate(members):
            self.table[k, : len(pieces[m])] = pieces[m]
        self.own_need = sizes - 1 - 2 * self.allowed
        self.own_pairs = np.stack([own_pairs(pieces[m]) for m in members])
        self.steps = max(STEPS_SAMPLED, int(1.5 * self.low))
        rng = np.random.default_rng([self.low, self.high])
        self.samples = np.stack([np.sort(rng.choice(self.steps, STEPS_SAMPLED, replace=False)) for _ in range(MOST_REPEATS)])
        own = self.walk(np.where(self.table < 0, PAD, self.table), bits)
        self.repeats = self._repeats(pieces, own, bits, rng, recall)
        self.exhaustive = self.recall < recall
        self.samples = self.samples[: 0 if self.exhaustive else self.repeats]
        signed = [self._signature(own, s) for s in self.samples]
        order = [np.argsort(s, kind="stable") for s in signed]
        self.keys = [s[o] for s, o in zip(signed, order)]
        self.owners = order

    def walk(self, rows: np.ndarray, bits) -> np.ndarray:
        """The embedding of each row of a matrix; past its end stands PAD."""
        n, width = rows.shape
        rows = np.concatenate([rows, np.full((n, 1), PAD)], axis=1).ravel()
        base = np.arange(n) * (width + 1)
        return self.walk_at(rows, base, base + width, bits)

    def walk_at(self, sequence: np.ndarray, start: np.ndarray, end: np.ndarray, bits) -> np.ndarray:
        at, out = start.copy(), np.empty((self.steps, len(start)), np.int32)
        for j in range(self.steps):
            seen = sequence[np.minimum(at, end)]
            out[j] = seen
            at += bits(j)[seen]
        return out

    @staticmethod
    def _signature(walked: np.ndarray, sample: np.ndarray) -> np.ndarray:
        got = np.zeros(walked.shape[1], np.int64)
        for j in sample:
            got = (got << 21) | walked[j]  # exact: word numbers have 21 bits at most
        return got

    def _repeats(self, pieces, own, bits, rng, recall: float) -> int:
        """Edit pieces as heavily as is allowed, inside a longer text, and count in which repeat each is found first."""
        picks = np.resize(np.arange(len(self.members)), TRIALS)
        starts = int(self.allowed.max()) + 1  # later windows over the same stretch find it too
        edited, of = [], []
        for n, k in enumerate(picks):
            row = list(pieces[self.members[k]])
            for _ in range(int(self.allowed[k])):
                kind, at = rng.integers(3), int(rng.integers(max(1, len(row))))
                if kind == 0 and row:
                    row[at] = OTHER
                elif kind == 1 and row:
                    row.pop(at)
                else:
                    row.insert(at, OTHER)
            for s in range(starts):
                part = row[s : s + self.steps]
                edited.append(part + [OTHER] * (self.steps - len(part)))  # the document goes on with other words
                of.append(n)
        walked = self.walk(np.array(edited, np.int64), bits)
        same = walked == own[:, picks[of]]
        hit = np.stack([np.bincount(of, same[s].all(axis=0), len(picks)) > 0 for s in self.samples])
        found = np.maximum.accumulate(hit, axis=0).mean(axis=1)
        enough = np.flatnonzero(found >= recall)
        self.recall = float(found[enough[0]] if len(enough) else found[-1])
        return int(enough[0]) + 1 if len(enough) else MOST_REPEATS

    def candidates(self, sequence, start: np.ndarray, end: np.ndarray, bits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, member) pairs that agree in a repeat, each once, in parts."""
        if self.exhaustive:
            many = max(1, CELLS // len(self.members))
            for k in range(0, len(start), many):
                part = start[k : k + many]
                yield np.repeat(part, len(self.members)), np.tile(np.arange(len(self.members)), len(part))
            return
        many = max(1, CELLS // self.steps)
        for k in range(0, len(start), many):
            part = start[k : k + many]
            window, member = self._agreeing(self.walk_at(sequence, part, end[k : k + many], bits))
            yield part[window], member

    def _agreeing(self, walked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for sample, keys, owners in zip(self.samples, self.keys, self.owners):
            got = self._signature(walked, sample)
            lo = np.searchsorted(keys, got)
            hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == got)
            if len(hit):
                many = np.searchsorted(keys, got[hit], side="right") - lo[hit]
                window = np.repeat(hit, many)
                nth = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
                out.append(window * len(self.members) + owners[np.repeat(lo[hit], many) + nth])
        pairs = np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)
        return pairs // len(self.members), pairs % len(self.members)


class Exact:
    """Items of one length that allow no edit, by a hash of their words."""

    def __init__(self, members: list[int], items: list[np.ndarray], word_hashes: np.ndarray) -> None:
        self.members, self.size = np.array(members), len(items[members[0]])
        self.table = np.stack([items[m] for m in members])
        keys = _prefix(word_hashes[self.table.T])[-1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], order

    def find(self, sequence, start, hashes: np.ndarray, powers: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item number, place) of the first place of each item in each text; `hashes` are the sequence's prefixes."""
        # both sides times the power of the start: no division
        got = (hashes[start + self.size] - hashes[start]) * powers[len(powers) - 1 - start]
        keys = self.keys * powers[-1]
        order = np.argsort(keys, kind="stable")
        keys, owners = keys[order], self.owners[order]
        lo = np.searchsorted(keys, got)
        hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == got)
        many = np.searchsorted(keys, got[hit], side="right") - lo[hit]
        at = np.repeat(start[hit], many)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        member = owners[np.repeat(lo[hit], many) + nth]
        same = np.ones(len(at), bool)
        for k in range(self.size):
            same &= sequence[at + k] == self.table[member, k]
        at, member = at[same], member[same]
        _, one = np.unique(text[at] * len(self.members) + member, return_index=True)
        # `at` rises, so the first of equals is the first place
        return zip(text[at[one]].tolist(), self.members[member[one]].tolist(), at[one].tolist())


def _powers(n: int) -> np.ndarray:
    """Powers 0 to n of an odd base, modulo 2^64."""
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _prefix(hashes: np.ndarray) -> np.ndarray:
    """Sums of hash times power along the first axis, from nothing on."""
    powers = _powers(len(hashes) - 1 if len(hashes) else 0)[: len(hashes)]
    sums = np.cumsum(hashes * powers.reshape(-1, *[1] * (hashes.ndim - 1)), axis=0, dtype=np.uint64)
    return np.concatenate([np.zeros((1, *hashes.shape[1:]), np.uint64), sums])


class Benchmark:
    """One block of items, ready to be looked for."""

    def __init__(self, rows: list[tuple[int, str | None]], similarity: float = SIMILARITY, recall: float = RECALL) -> None:
        texts = [words(t) for _, t in rows]
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.vocabulary = {w: n for n, w in enumerate(dict.fromkeys(w for t in texts for w in t), PAD + 1)}
        seeds = np.array([11, 13, *(xxhash.xxh64_intdigest(w) for w in self.vocabulary)], np.uint64)
        self._seeds, self._bits = seeds, {}
        items = [np.array([self.vocabulary[w] for w in t], np.int64) for t in texts]
        # by hash, where a clash only lets a window through: as many bits as keep nearly all other pairs out
        self.pair_bits = max(OWN_BITS, (BITS_A_PAIR * sum(len(item) for item in items)).bit_length())
        self.pairs = np.zeros(1 << self.pair_bits, bool)
        for item in items:
            self.pairs[pair_code(item[:-1], item[1:], self.pair_bits)] = True
        self.items, self.similarity = items, similarity
        pieces: list[np.ndarray] = []
        of: list[tuple[int, int]] = []  # of each piece, its item and its place there
        exact: dict[int, list[int]] = {}
        for n in sorted((n for n in range(len(items)) if len(items[n])), key=lambda n: len(items[n])):
            if not allowed(len(items[n]), similarity):
                exact.setdefault(len(items[n]), []).append(n)
                continue
            at = 0
            for part in np.array_split(items[n], -(-len(items[n]) // PIECE)):
                pieces.append(part)
                of.append((n, at))
                at += len(part)
        self.of = np.array(of, np.int64).reshape(-1, 2)
        groups: dict[int, list[int]] = {}
        for k, part in enumerate(pieces):
            groups.setdefault(int(np.log(len(part)) / np.log(1.25)), []).append(k)
        self.exact = [Exact(m, items, mix(self._seeds)) for m in exact.values()]
        self.classes = [LengthClass(m, pieces, self.bits, similarity, recall) for m in groups.values()]

    def bits(self, j: int) -> np.ndarray:
        if j not in self._bits:
            self._bits[j] = (mix(self._seeds + np.uint64(j * _SEED % 2**64)) >> np.uint64(33) & np.uint64(1)).astype(np.int64)
        return self._bits[j]

    def find(self, texts: list[list[str]]) -> list[tuple[int, int, int, int]]:
        """(text number, item number, distance, first word) of every item in every text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1) - 1  # each text is followed by PAD
        sequence = np.full(int(sizes.sum()) + len(texts), PAD, np.int32)
        inside = np.ones(len(sequence), bool)
        inside[ends] = False
        sequence[inside] = np.fromiter(map(self.vocabulary.get, chain.from_iterable(texts), repeat(OTHER)), np.int32, int(sizes.sum()))
        end_of = np.repeat(ends.astype(np.int32), sizes + 1)
        known = sequence > PAD
        both = np.flatnonzero(known[:-1] & known[1:])
        pairs = np.zeros(len(sequence) + 1, np.int32)
        pairs[both[self.pairs[pair_code(sequence[both], sequence[both + 1], self.pair_bits)]] + 1] = 1
        begun = np.cumsum(pairs, dtype=np.int32)  # pairs that begin before each position
        found: dict[tuple[int, int], tuple[int, int]] = {}
        tried: set[tuple[int, int, int]] = set()  # places of long items
        if self.exact:
            hashes, powers = _prefix(mix(self._seeds)[sequence]), _powers(len(sequence))
            text = np.repeat(np.arange(len(texts)), sizes + 1)
            begin = ends - sizes
            places = np.flatnonzero(known)
            for e in self.exact:
                start = places[places + e.size <= end_of[places]]
                start = start[begun[start + e.size - 1] - begun[start] == e.size - 1]
                for t, i, p in e.find(sequence, start, hashes, powers, text):
                    found[t, i] = 0, int(p - begin[t])
        if not self.classes:
            return [(t, i, d, p) for (t, i), (d, p) in sorted(found.items())]
        most, least = max(c.high for c in self.classes), min(c.need for c in self.classes)
        at = np.arange(len(sequence), dtype=np.int32)
        at = np.flatnonzero(begun[np.minimum(at + np.int32(most - 1), end_of)] - begun[:-1] >= least)
        for c in self.classes:
            start = at[begun[np.minimum(at + c.high - 1, end_of[at])] - begun[at] >= c.need]
            if not len(start):
                continue
            for place, member in c.candidates(sequence, start, end_of[start].astype(np.int64), self.bits):
                if len(place):
                    self._checked(c, sequence, ends, end_of, place, member, found, tried)
        return [(t, i, d, p) for (t, i), (d, p) in sorted(found.items())]

    def _checked(self, c, sequence, ends, end_of, place, member, found, tried) -> None:
        # one stretch serves all windows of a piece that begin within the same `spare` words
        spare = int(c.allowed.max())
        text = np.searchsorted(ends, place)
        _, one = np.unique(np.stack([member, text, place // (spare + 1)]), axis=1, return_index=True)
        place, member, text = place[one], member[one], text[one]
        many = max(1, CELLS // (c.high + 4 * spare))
        for k in range(0, len(place), many):
            self._verify(c, sequence, ends, end_of, *(x[k : k + many] for x in (place, member, text)), found, tried)

    def _verify(self, c, sequence, ends, end_of, start, member, text, found, tried) -> None:
        spare = int(c.allowed.max())
        begin = np.concatenate([[0], ends[:-1] + 1])[text]
        first = np.maximum(start - spare, begin)
        reach = first[:, None] + np.arange(c.high + 4 * spare)
        stretch = np.where(reach < end_of[start][:, None], sequence[np.minimum(reach, len(sequence) - 1)], -2)
        own = c.own_pairs[member[:, None], pair_code(stretch[:, :-1], stretch[:, 1:], OWN_BITS)].sum(axis=1)
        keep = own >= c.own_need[member]  # the bound on pairs again, for this very piece
        start, member, text, begin, stretch = (x[keep] for x in (start, member, text, begin, stretch))
        distance = edit_distances(c.table[member], c.sizes[member], stretch)
        for n in np.flatnonzero(distance <= c.allowed[member]):
            item, at = self.of[c.members[member[n]]].tolist()
            if len(self.items[item]) > PIECE:
                self._whole(item, int(start[n]) - at, int(text[n]), int(begin[n]), int(ends[text[n]]), sequence, found, tried)
                continue
            key, got = (int(text[n]), item), (int(distance[n]), int(start[n] - begin[n]))
            found[key] = min(found.get(key, got), got)

    def _whole(self, item: int, start: int, text: int, begin: int, end: int, sequence, found, tried) -> None:
        """Verify a long item of which a piece was found; `start` is where the item would begin without edits."""
        words_ = self.items[item]
        most = int(allowed(len(words_), self.similarity))
        cell = (start - begin) // (most + 1)
        if (text, item, cell) in tried:
            return
        tried.add((text, item, cell))
        low = begin + cell * (most + 1) - most  # edits before the piece move it by `most` at most
        stretch = sequence[max(begin, low) : max(begin, min(end, low + len(words_) + 4 * most + 2))]
        if own_pairs(words_)[pair_code(stretch[:-1], stretch[1:], OWN_BITS)].sum() < len(words_) - 1 - 2 * most:
            return
        distance = int(edit_distances(words_[None], np.array([len(words_)]), stretch[None])[0])
        if distance <= most:
            key, got = (text, item), (distance, max(0, start - begin))
            found[key] = min(found.get(key, got), got)


def blocks(benchmark: DataFrame, size: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str | None]]]:
    """Items in blocks of `size` words at most, or of one item."""
    block, total = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        n = len(words(text))
        if block and total + n > size:
            yield block
            block, total = [], 0
        block.append((item, text))
        total += n
    if block:
        yield block


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[list[str]]]]:
    """(from row, to row, words) for some WORDS_AT_ONCE words at a time."""
    begin, split, size = 0, [], 0
    for n, text in enumerate(batch.column(column)):
        split.append(words(text.as_py()))
        size += len(split[-1])
        if size >= WORDS_AT_ONCE:
            yield begin, n + 1, split
            begin, split, size = n + 1, [], 0
    if split:
        yield begin, begin + len(split), split


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, item_id, distance, first_word for each item in each document."""
    schema = "doc_id long, item_id long, distance int, first_word long"
    spark = docs.sparkSession
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark):
        bench_of = shared(spark, Benchmark(block, similarity, recall))

        def run(batches: Iterator[pa.RecordBatch], bench_of=bench_of) -> Iterator[pa.RecordBatch]:
            bench = bench_of()
            for batch in batches:
                for begin, _, split in _texts(batch, 1):
                    got = bench.find(split)
                    doc = batch.column(0).take(pa.array([begin + t for t, _, _, _ in got], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [doc, pa.array([int(bench.ids[i]) for _, i, _, _ in got], pa.int64()), pa.array([d for _, _, d, _ in got], pa.int32()), pa.array([p for _, _, _, p in got], pa.int64())],
                        ["doc_id", "item_id", "distance", "first_word"],
                    )

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of docs, all columns, whose text contains no item."""
    for block in blocks(benchmark):
        bench_of = shared(docs.sparkSession, Benchmark(block, similarity, recall))
        column = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], bench_of=bench_of, column=column) -> Iterator[pa.RecordBatch]:
            bench = bench_of()
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for begin, _, split in _texts(batch, column):
                    for t, _, _, _ in bench.find(split):
                        keep[begin + t] = False
                yield batch.filter(pa.array(keep))

        docs = small_batches(docs).mapInArrow(run, docs.schema)
    return docs


def query(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return contaminated(read("documents"), read("benchmark"))
