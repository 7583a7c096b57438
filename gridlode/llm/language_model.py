"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling.

A text is a sequence of words and one end. Outcomes are those of the base score:
each training token and, as one outcome, every word that training hasn't seen.
Each context, the word before or the text's start, has a restaurant of the
tokens that follow it. All share one parent, the word restaurant, whose customers
are the contexts' tables and whose base is uniform over the outcomes. `score` is
the log10 probability of a text's tokens in this model, averaged over SAMPLES.

Gibbs sampling: all customers of one dish leave their restaurant and are seated
again, given the tables of all other dishes there and the parent's probability
of the dish. For c customers the number of tables t has the exact conditional

    S(c, t) * product of (strength + discount * (other tables + i)), i < t, * p^t

with the generalised Stirling numbers S. Dishes of more than EXACT customers are
seated customer by customer instead, in steps of STEP_SHARE of those seated, with
a normal draw for a step's tables. A dish of one customer has one table always. A
restaurant's dishes go in GROUPS turns, each given the tables of the turns before;
up to GROUPS dishes, that is one by one. Restaurants that many tasks share (the
word restaurant, and contexts dealt to several shards) use the totals of the
sweep before for the other tasks' dishes. After BURN_IN sweeps of contexts and
words, each further one is a sample. Draws are hashes of dish and sweep.

How it is spread: texts are cut to blocks of BLOCK_TOKENS tokens or one text. A block asks
each shard for its different (context, word) pairs, once each, with their counts
in training texts; shards own contexts by hash, contexts with a large share of all
tokens (HOT_SHARE of a shard in a sample of the texts) by hash of the pair, so a
common word or pair is spread and reaches a shard once a block at most. Sweeps
exchange only tables of words in pairs that occur twice or more. A shard's answers
are in the order of the block's question and need no keys. The sample steers where
pairs go, never what is counted.

Defined cases: a null text is empty; an empty text is the end alone; without
training texts N and V are 0 and the unseen outcome is certain; equal texts score
alike and repeated rows give a row each, null ids too; a tie can't arise; an empty
table gives no rows; a very long text is one block of its own, whose words one
Python worker holds (some 150 bytes a word); other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import crc_mod, erase, kept, packed, small_batches, unpacked, written
from gridlode.llm.shingles import mix

STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 3
EXACT, GROUPS, STEP_SHARE = 256, 8, 0.05
BLOCK_TOKENS = 1 << 21
SHARD_TOKENS = 1 << 22
HOT_SHARE = 0.25
SAMPLED = 1 / 32
CACHE = 300_000
START, END = 2, 3  # in place of a word's hash

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_QUESTION, _TEXTS, _SHARD = 0, 1, 2


def split(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lowered, as UTF-8; bytes.split() parts at exactly \\x20 and \\x09-\\x0D."""
    return (text or "").encode().lower().split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got

    def sequence(self, text: str | None) -> np.ndarray:
        """The text's word hashes between START and END."""
        words = split(text)
        out = np.empty(len(words) + 2, np.uint64)
        out[0], out[-1] = START, END
        out[1:-1] = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        if len(self) > CACHE:
            self.clear()
        return out


def _uniform(seed: np.ndarray, turn: int) -> np.ndarray:
    bits = mix(seed + np.uint64((turn * 0x9E3779B97F4A7C15) % 2**64))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.9)) if ones else 0.5


def log_stirling(most: int, d: float) -> np.ndarray:
    """log S(c, t) for c and t up to `most`: S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(1, most + 1)
    with np.errstate(divide="ignore"):
        for c in range(most):
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], out[c, 1:] + np.log(np.maximum(c - t * d, 0)))
    return out


def _stepped(counts: np.ndarray, base: np.ndarray, others: np.ndarray, d: float, seed: np.ndarray) -> np.ndarray:
    """Tables of dishes whose customers come in turn, many at a step once many are seated."""
    order = np.argsort(-counts, kind="stable")
    c, p, s, more = counts[order].astype(np.float64), base[order], seed[order], others[order]
    t, done, turn = np.ones(len(c)), 1.0, 0
    while (live := int(np.searchsorted(-c, -done))) > 0:  # dishes with more than `done` customers
        n = max(1.0, np.floor(done * STEP_SHARE))
        k = np.minimum(n, c[:live] - done)
        new = (STRENGTH + d * (more[:live] + t[:live])) * p[:live]
        share = new / (done - d * t[:live] + new)
        turn += 2
        u = _uniform(s[:live], turn)
        if n == 1:
            t[:live] += u < share
        else:
            normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * _uniform(s[:live], turn + 1))
            t[:live] += np.clip(np.rint(k * share + np.sqrt(k * share * (1 - share)) * normal), 0, k)
        done += n
    out = np.empty(len(c))
    out[order] = t
    return out


def reseated(counts: np.ndarray, base: np.ndarray, others: np.ndarray, d: float, seed: np.ndarray, stirling: np.ndarray) -> np.ndarray:
    """New numbers of tables of dishes, given the other dishes' tables in their restaurants and the parent's probabilities."""
    out = np.ones(len(counts))
    width = 2
    while width <= 2 * EXACT:
        at = np.flatnonzero((counts > width // 2) & (counts <= min(width, EXACT)))
        for part in np.array_split(at, max(1, -(-len(at) * width // (1 << 20)))) if len(at) else ():
            w = min(width, EXACT)
            rise = np.log(STRENGTH + d * (others[part, None] + np.arange(w))) + np.log(np.maximum(base[part, None], 1e-300))
            logs = stirling[counts[part], 1 : w + 1] + np.cumsum(rise, axis=1)
            share = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            draw = _uniform(seed[part], 1) * share[:, -1]
            out[part] = 1 + (share < draw[:, None]).sum(axis=1)
        width *= 2
    large = counts > EXACT
    if large.any():
        out[large] = _stepped(counts[large], base[large], others[large], d, seed[large])
    return out


def route(a: np.ndarray, b: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    """The shard of each pair: the context's, or the pair's own where the context is hot."""
    key = mix(a ^ _B)
    if len(hot):
        own = np.isin(a, hot)
        key[own] = mix(key[own] + b[own] * _A)
    return (key % np.uint64(n)).astype(np.int64)


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    new = np.ones(len(sorted_), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(sorted_)))


_FIELDS = ("x1", "x2", "x3", "x4", "x5", "x6")
#: One table holds questions, texts and shards, so that the texts are read once.
_ROW = "to int, kind int, source long, " + ", ".join(f"{x} binary" for x in _FIELDS) + ", ids array<long>, parts array<binary>"
_TYPES = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * len(_FIELDS), pa.list_(pa.int64()), pa.list_(pa.binary()))
_NAMES = ("to", "kind", "source", *_FIELDS, "ids", "parts")


def _row(to: int, kind: int, source: int, arrays=(), ids=None, parts=None) -> pa.RecordBatch:
    data = [packed(x) for x in arrays]
    values = (to, kind, source, *data, *[None] * (len(_FIELDS) - len(data)), ids, parts)
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES)], list(_NAMES))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dictionaries, their arrays unpacked."""
    for batch in batches:
        for n in range(len(batch)):
            row = {name: batch.column(k)[n] for k, name in enumerate(batch.schema.names)}
            out = {name: row[name].as_py() for name in ("to", "kind", "source", "ids", "parts")}
            yield out | {x: unpacked(row[x].as_buffer()) if row[x].is_valid else None for x in _FIELDS}


def _asking(shards: int, hot: np.ndarray):
    """Texts to questions and coded texts, block by block."""

    def block(number: int, ids: list, held: list[bool], sequences: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) - 1 for s in sequences])
        words, code = np.unique(np.concatenate(sequences), return_inverse=True)
        last = np.cumsum(sizes + 1) - 1
        left, right = np.delete(code, last), np.delete(code, np.append(0, last[:-1] + 1))
        pairs, where = np.unique(left * len(words) + right, return_inverse=True)
        count = np.bincount(where, np.repeat(~np.array(held, bool), sizes), len(pairs)).astype(np.int64)
        a, b = pairs // len(words), pairs % len(words)
        shard = route(words[a], words[b], hot, shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        codes = place[where].astype(np.int32)
        yield _row(int(mix(np.array([number], np.uint64))[0] % np.uint64(shards)), _TEXTS, number, (codes, sizes, np.array(held, np.uint8)), ids)
        at, lengths = _runs(shard[order])
        for begin, n in zip(at.tolist(), lengths.tolist()):
            own = order[begin : begin + n]
            first, run = _runs(a[own])
            follow, index = np.unique(b[own], return_inverse=True)
            arrays = (words[a[own[first]]], run.astype(np.int32), words[follow], index.astype(np.int32), count[own])
            yield _row(int(shard[own[0]]), _QUESTION, number, arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, number = kept("language", _Hashes), TaskContext.get().partitionId() << 32
        ids, held, sequences, size = [], [], [], 0
        for batch in batches:
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids.append(doc)
                held.append(out)
                sequences.append(cache.sequence(text.as_py()))
                size += len(sequences[-1])
                if size >= BLOCK_TOKENS:
                    yield from block(number, ids, held, sequences)
                    number += 1
                    ids, held, sequences, size = [], [], [], 0
        if ids:
            yield from block(number, ids, held, sequences)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's questions to one table of pairs and each block's places in it; texts pass through."""
    asked: dict[int, list[dict]] = {}
    for row in _rows(batches):
        if row["kind"] == _TEXTS:
            yield _row(row["to"], _TEXTS, row["source"], [row[x] for x in _FIELDS[:3]], row["ids"])
        else:
            asked.setdefault(row["to"], []).append(row)
    for to, rows in asked.items():
        contexts, words = (np.unique(np.concatenate([r[x] for r in rows])) for x in ("x1", "x3"))
        codes = [np.repeat(np.searchsorted(contexts, r["x1"]), r["x2"]) * len(words) + np.searchsorted(words, r["x3"])[r["x4"]] for r in rows]
        pairs, where = np.unique(np.concatenate(codes), return_inverse=True)
        count = np.bincount(where, np.concatenate([r["x5"] for r in rows]), len(pairs)).astype(np.int64)
        ends = np.cumsum([len(c) for c in codes])
        parts = [packed(np.diff(where[e - len(c) : e], prepend=0).astype(np.int32)) for c, e in zip(codes, ends)]  # places rise
        sizes = np.bincount(pairs // len(words), minlength=len(contexts)).astype(np.int32)
        yield _row(to, _SHARD, 0, (contexts, sizes, words, (pairs % len(words)).astype(np.int32), count), [r["source"] for r in rows], parts)


class _Shard:
    """A shard's pairs, from its row."""

    def __init__(self, row: dict) -> None:
        self.contexts, self.sizes, self.words, self.word, self.count = (row[x] for x in _FIELDS[:5])
        self.context = np.repeat(np.arange(len(self.contexts)), self.sizes)
        self.heavy = np.flatnonzero(self.count > 1)

    def context_sums(self, values: np.ndarray, at=slice(None)) -> np.ndarray:
        return np.bincount(self.context[at], values, len(self.contexts))


def _given(base: np.ndarray, totals: tuple[float, float, float, int]) -> np.ndarray:
    """The word restaurant's probabilities from its dishes' own mass, its discount, customers, tables and outcomes."""
    d, customers, tables, outcomes = totals
    return (base + (STRENGTH + d * tables) / outcomes) / (STRENGTH + customers)


class LanguageModel:
    """Counts and samples, from the rows of docs that are not held out."""

    def __init__(self, docs: DataFrame, held_out) -> None:
        self.spark = docs.sparkSession
        self.rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text"))
        self.shards, self.hot = self._layout()
        asked = self.rows.mapInArrow(_asking(self.shards, self.hot), _ROW)
        self.table = written(asked.repartitionById(self.shards, "to").mapInArrow(_merged, _ROW), partition="kind")
        self.texts, self.pairs = (self.table.where(F.col("kind") == k).select(*_NAMES) for k in (_TEXTS, _SHARD))
        self.trace: list[dict] = []
        self._counted()
        self._sampled()

    def _layout(self) -> tuple[int, np.ndarray]:
        """The number of shards and the contexts that all of them share, from a sample of the texts."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache = kept("language", _Hashes)
            for batch in batches:
                if len(batch):
                    h, n = np.unique(np.concatenate([cache.sequence(t.as_py())[:-1] for t in batch.column(0)]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        seen = self.rows.select("text").sample(SAMPLED, 1).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        seen = written(seen)
        total = seen.agg(F.sum("n")).first()[0] or 0
        shards = max(self.spark.sparkContext.defaultParallelism, int(total / SAMPLED / SHARD_TOKENS) + 1)
        least = total * HOT_SHARE / shards  # so there are shards / HOT_SHARE of them at most
        hot = [r["h"] for r in seen.where(F.col("n") > least).select("h").collect()] if total else []
        erase(seen)
        return shards, np.array(sorted(hot), np.int64).view(np.uint64)

    def _counted(self) -> None:
        """Totals, each shard's repeated pairs, and each word's tables so far: one for each pair."""
        hot = self.hot

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                s = _Shard(row)
                trained = (s.count > 0).astype(np.float64)
                ones, twos, all_ = int((s.count == 1).sum()), int((s.count == 2).sum()), int(s.count.sum())
                singles = s.context_sums(s.count == 1)
                of, words = np.unique(s.word[s.heavy], return_inverse=True)
                contexts, run_ = _runs(s.context[s.heavy])
                contexts = s.context[s.heavy][contexts]
                heavy = (s.contexts[contexts], run_.astype(np.int32), singles[contexts].astype(np.int64), s.words[of], words.astype(np.int32), s.count[s.heavy])
                yield _row(row["to"], 0, 0, heavy, [ones, twos, all_])
                tables = np.bincount(s.word, trained, len(s.words)).astype(np.int64)
                mark = np.zeros(len(s.words), np.uint8)
                mark[of] = 1
                to = (mix(s.words ^ _A) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                for begin, n in zip(*(x.tolist() for x in _runs(to[order]))):
                    own = order[begin : begin + n]
                    yield _row(int(to[own[0]]), 1, row["to"], (s.words[own], tables[own], mark[own], np.bincount(s.word[s.heavy], minlength=len(s.words))[own]))
                if len(hot):
                    at = np.flatnonzero(np.isin(s.contexts, hot))
                    sums = s.context_sums(s.count)
                    yield _row(row["to"], 2, 0, (s.contexts[at], sums[at], s.context_sums(trained)[at]), s.contexts[at].view(np.int64).tolist())

        shards = self.shards
        got = written(self.pairs.mapInArrow(run, _ROW), partition="kind")
        self.heavy = got.where("kind = 0").select(*_NAMES)
        said = self.heavy.select(*(F.sum(F.col("ids")[k]).alias(n) for k, n in enumerate(("ones", "twos", "all")))).first()
        self.tokens, self.discount = said["all"] or 0, discount(said["ones"] or 0, said["twos"] or 0)
        self.ends = self.rows.where(~F.col("held_out")).count()
        self.hot_counts = self._hot_sums(got.where("kind = 2").select(*_NAMES), "x2")
        self.hot_tables = [self._hot_sums(got.where("kind = 2").select(*_NAMES), "x3")]

        def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One row for each part of the word restaurant: its words, singles and messages' places."""
            by: dict[int, list[dict]] = {}
            for row in _rows(batches):
                by.setdefault(row["to"], []).append(row)
            for to, rows in by.items():
                words, where = np.unique(np.concatenate([r["x1"] for r in rows]), return_inverse=True)
                tables = np.bincount(where, np.concatenate([r["x2"] for r in rows]), len(words))
                heavy = np.bincount(where, np.concatenate([r["x4"] for r in rows]), len(words))
                ends = np.cumsum([len(r["x1"]) for r in rows])
                places = [where[e - len(r["x1"]) : e].astype(np.int32) for r, e in zip(rows, ends)]
                parts = [p for r, at in zip(rows, places) for p in (packed(at), packed(r["x3"]))]
                yield _row(to, 3, 0, (words, (tables - heavy).astype(np.int64), tables.astype(np.int64)), [r["source"] for r in rows], parts)

        self.parents = written(got.where("kind = 1").select(*_NAMES).repartitionById(shards, "to").mapInArrow(parents, _ROW))
        self._counted_table = got

    def _hot_sums(self, rows: DataFrame, field: str) -> dict[int, float]:
        """Sums over shards for the contexts that many share; there are few of them, by _layout."""
        if not len(self.hot):
            return {}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row[field], pa.float64())], ["h", "n"])

        got = rows.mapInArrow(run, "h long, n double").groupBy("h").agg(F.sum("n").alias("n"))
        return {r["h"] % 2**64: r["n"] for r in got.collect()}

    def _parent_sweep(self, sweep: int, messages: DataFrame | None, totals) -> DataFrame:
        """Seat the word restaurant. Rows: to a shard (0: for its repeated pairs' words, 1: for all its words), and sums (2)."""
        final = sweep >= BURN_IN
        d, tables, outcomes = totals

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            stirling = log_stirling(EXACT, d)
            own, said = {}, {}
            for row in _rows(batches):
                if row["kind"] == 3:
                    own[row["to"]] = row
                else:
                    said[row["to"], row["source"]] = row["x1"]
            for to, row in own.items():
                words, n = row["x1"], row["x3"]
                places = [unpacked(p) for p in row["parts"]]
                places, marks = places[::2], places[1::2]
                if said:
                    n = row["x2"].astype(np.float64)
                    for source, at, mark in zip(row["ids"], places, marks):
                        if (to, source) in said:
                            n[at[mark > 0]] += said[to, source]
                n = n.astype(np.int64)
                seed = mix(words + np.uint64((sweep * int(_B) + 7) % 2**64))
                t = np.minimum(n, 1).astype(np.float64)
                many = np.flatnonzero(n > 1)
                t[many] = reseated(n[many], np.full(len(many), 1 / outcomes), np.full(len(many), tables - 1.0), d, seed[many], stirling)
                t = t.astype(np.int64)
                yield _row(to, 2, 0, (), [int(n.sum()), int(t.sum())])
                for source, at, mark in zip(row["ids"], places, marks):
                    if final:
                        yield _row(source, 1, to, (n[at], t[at]))
                    if (mark > 0).any():
                        at = at[mark > 0]
                        yield _row(source, 0, to, (n[at], t[at]))

        rows = self.parents if messages is None else self.parents.unionByName(messages)
        return written(rows.repartitionById(self.shards, "to").mapInArrow(run, _ROW), partition="kind")

    def _context_sweep(self, sweep: int, replies: DataFrame, state: DataFrame | None, totals) -> DataFrame:
        """Seat the contexts' repeated pairs. Rows: new tables (4), messages to the word restaurant (5), shared contexts' tables (2)."""
        d, shards, hot = self.discount, self.shards, self.hot
        hot_tables = self.hot_tables[-1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            stirling = log_stirling(EXACT, d)
            own, tables, mass = {}, {}, {}
            for row in _rows(batches):
                if row["kind"] == 4:
                    tables[row["to"]] = row["x1"].astype(np.float64)
                elif row["x3"] is None:
                    mass[row["to"], row["source"]] = row["x1"] - totals[0] * row["x2"]
                else:
                    own[row["to"]] = row
            for to, row in own.items():
                contexts, run_, singles, words, word, count = (row[x] for x in _FIELDS)
                at = np.repeat(np.arange(len(contexts)), run_)
                t = tables.get(to, np.ones(len(count)))
                parent = (mix(words ^ _A) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(parent, kind="stable")
                base = np.empty(len(words))
                begins, lengths = _runs(parent[order])
                for begin, n in zip(begins.tolist(), lengths.tolist()):
                    mine = order[begin : begin + n]
                    base[mine] = mass[to, int(parent[mine[0]])]
                base = _given(base, totals)[word]
                total = singles + np.bincount(at, t, len(contexts))
                shared_ = np.flatnonzero(np.isin(contexts, hot))
                total[shared_] = [hot_tables[int(h)] for h in contexts[shared_]]
                seed = mix(mix(contexts)[at] + words[word] * _A + np.uint64(sweep * int(_B) % 2**64))
                rank = np.arange(len(at)) - np.repeat(np.cumsum(run_) - run_, run_)
                for g in range(GROUPS):
                    now = np.flatnonzero(rank % GROUPS == g)
                    if len(now):
                        new = reseated(count[now], base[now], total[at[now]] - t[now], d, seed[now], stirling)
                        total += np.bincount(at[now], new - t[now], len(contexts))
                        t[now] = new
                yield _row(to, 4, 0, (t.astype(np.int64),))
                sums = np.bincount(word, t, len(words)).astype(np.int64)
                for begin, n in zip(begins.tolist(), lengths.tolist()):
                    mine = order[begin : begin + n]
                    yield _row(int(parent[mine[0]]), 5, to, (sums[mine],))
                if len(shared_):
                    more = np.bincount(at, t - 1, len(contexts))[shared_]
                    yield _row(to, 2, 0, (more,), contexts[shared_].view(np.int64).tolist())

        rows = self.heavy.unionByName(replies)
        rows = rows if state is None else rows.unionByName(state)
        return written(rows.repartitionById(shards, "to").mapInArrow(run, _ROW), partition="kind")

    def _sampled(self) -> None:
        of = lambda df, k: df.where(F.col("kind") == k).select(*_NAMES)
        got = self.parents.mapInArrow(_sizes, "n1 long, n2 long, v long")
        n = got.agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"), F.sum("v").alias("v")).first()
        self.distinct = n["v"] or 0
        parent_discount, tables = discount(n["n1"] or 0, n["n2"] or 0), float(self.distinct)
        first_tables = self.hot_tables[0]
        self.samples: list[tuple] = []
        messages = state = seated = None
        for sweep in range(BURN_IN + SAMPLES):
            parent = self._parent_sweep(sweep, messages, (parent_discount, tables, self.distinct + 1))
            sums = of(parent, 2).select(F.sum(F.col("ids")[0]).alias("n"), F.sum(F.col("ids")[1]).alias("t")).first()
            tables = float(sums["t"] or 0)
            totals = (parent_discount, float(sums["n"] or 0), tables, self.distinct + 1)
            self.trace.append({"sweep": sweep, "context tables": totals[1], "word tables": tables})
            if sweep >= BURN_IN:  # the words, given the contexts as they are
                self.samples.append((totals, self.hot_tables[-1], of(parent, 1), state))
            if sweep == BURN_IN + SAMPLES - 1:
                break
            before, seated = seated, self._context_sweep(sweep, of(parent, 0), state, totals)
            more = self._hot_sums(of(seated, 2), "x1")
            self.hot_tables.append({h: t + more.get(h, 0) for h, t in first_tables.items()})
            state, messages = of(seated, 4), of(seated, 5)
            if sweep < BURN_IN:
                erase(parent, *([before] if before is not None else []))
        erase(self._counted_table, self.parents)

    def _answers(self) -> DataFrame:
        """(block, shard, log10 probabilities, context counts) in the order of each block's question."""
        d, hot, shards = self.discount, self.hot, self.shards
        known, hot_counts = [(totals, tables) for totals, tables, _, _ in self.samples], self.hot_counts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, mass, tables = {}, {}, {}
            for row in _rows(batches):
                if row["kind"] == _SHARD:
                    own[row["to"]] = row
                elif row["kind"] % 10 == 4:
                    tables[row["to"], row["kind"] // 10] = row["x1"]
                else:
                    k = row["kind"] // 10
                    mass[row["to"], k, row["source"]] = row["x1"] - known[k - 1][0][0] * row["x2"]
            for to, row in own.items():
                s = _Shard(row)
                parent = (mix(s.words ^ _A) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(parent, kind="stable")
                begins, lengths = _runs(parent[order])
                shared_ = np.flatnonzero(np.isin(s.contexts, hot))
                customers = s.context_sums(s.count)
                customers[shared_] = [hot_counts[int(h)] for h in s.contexts[shared_]]
                total = np.zeros(len(s.count))
                for k, (totals, hot_tables) in enumerate(known):
                    base = np.empty(len(s.words))
                    for begin, n in zip(begins.tolist(), lengths.tolist()):
                        mine = order[begin : begin + n]
                        base[mine] = mass[to, k + 1, int(parent[mine[0]])]
                    t = np.minimum(s.count, 1).astype(np.float64)
                    t[s.heavy] = tables[to, k + 1]
                    opened = s.context_sums(t)
                    opened[shared_] = [hot_tables[int(h)] for h in s.contexts[shared_]]
                    room = STRENGTH + d * opened
                    total += (s.count - d * t + room[s.context] * _given(base, totals)[s.word]) / (STRENGTH + customers)[s.context]
                logs = np.log10(total / len(known)).astype(np.float32)
                count = customers.astype(np.int64)[s.context]
                for block, part in zip(row["ids"], row["parts"]):
                    at = np.cumsum(unpacked(part))
                    yield _row(0, 0, block, (logs[at], count[at]), [to])

        marked = lambda df, k, n: df.withColumn("kind", F.lit(10 * k + n))  # noqa: E731  a sample's rows
        rows = self.pairs
        for k, (_, _, replies, state) in enumerate(self.samples, 1):
            rows = rows.unionByName(marked(replies, k, 1)).unionByName(marked(state, k, 4))
        return rows.repartitionById(shards, "to").mapInArrow(run, _ROW)

    def score(self) -> DataFrame:
        """A row for each text."""
        n, ends = self.tokens, self.ends
        floor = n + 0.5 * (self.distinct + 1)
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, answers = {}, {}
            for row in _rows(batches):
                if row["kind"] == _TEXTS:
                    texts[row["source"]] = row
                else:
                    answers.setdefault(row["source"], {})[row["ids"][0]] = row["x1"], row["x2"]
            for block, row in texts.items():
                logs, counts = (np.concatenate(x) for x in zip(*(got for _, got in sorted(answers.pop(block).items()))))
                codes, sizes, held = row["x1"], row["x2"], row["x3"].astype(bool)
                base = np.log10((counts + 0.5) / floor)[codes]
                known = (counts > 0)[codes].astype(np.int64)
                begin = np.cumsum(sizes) - sizes  # at the start's pair, whose context is no token; the end is one
                base[begin], known[begin] = np.log10((ends + 0.5) / floor), int(ends > 0)
                sums = [np.add.reduceat(x, begin) for x in (logs[codes].astype(np.float64), base, known)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array(held),
                        pa.array(sizes),
                        pa.array(sums[2]),
                        pa.array(np.full(len(sizes), n)),
                        pa.array(sums[1]),
                        pa.array(sums[0]),
                        pa.array(10.0 ** (-sums[0] / sizes)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

        rows = self.texts.unionByName(self._answers())
        rows = rows.withColumn("to", F.pmod(F.xxhash64("source"), F.lit(self.shards)).cast("int")).repartitionById(self.shards, "to")
        return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of one table, of two, and of any."""
    for row in _rows(batches):
        n = row["x3"]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in ((n == 1).sum(), (n == 2).sum(), (n > 0).sum())], ["n1", "n2", "v"])


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return LanguageModel(docs, crc_mod("doc_id", 5) == 1).score()
