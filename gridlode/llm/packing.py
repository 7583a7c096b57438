"""Best-fit packing by linear grouping.

1. Each text is tokenized once; documents over the capacity are cut into
   capacity-sized pieces. The pieces (no text, no ids) are written out.
2. Lengths are counted. There are at most `capacity` different ones, so the
   counts fit the driver at any corpus size, and the whole packing is planned
   on counts: large lengths are dealt into groups of equal cardinality and
   rounded up to the group's largest; the few sizes that are left are combined
   into configurations by subset-sum optimisation; actual lengths replace the
   rounded ones; what room is left takes the small lengths by best fit, from
   the largest down.
3. The plan says, for each length, which run of its pieces (by rank) goes to
   which run of sequences at which offset. Ranks come from counts by (length,
   salt), so no length gathers in one task, and pieces meet their run by a join
   on the length.

Defined cases: a null or empty text is the end token alone; repeated rows are
packed as often as they occur; pieces of equal length are interchangeable, so a tie
is broken by the row's place in the table; a very long text is tokenized whole, at
some 100 bytes of a worker's memory a word; an empty table gives no rows; other
columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlode.llm.common import kept, small_batches, written

CAPACITY = 2048
GROUPS = 64
SMALL = 4  # lengths up to capacity / SMALL are small
CHUNKS, PARTS = 450_000, 400_000  # what a worker remembers: chunks with their marks, and the words and marks they are made of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# A letter is never joined to one of these marks by the tokenizer's pattern, and
# lower-casing letters before U+0250 is what its normalizer does itself.
_SPLIT = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([.,;:!?#$%&*|)]*)\Z")


class TokenCache(dict):
    """White-space-free chunk -> its token ids as little-endian 32-bit bytes.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its chunks in turn. A word with marks after it is looked up as the
    lower-case word and the marks.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {"": b""}

    def _part(self, s: str) -> bytes:
        got = self.parts.get(s)
        if got is None:
            got = np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
            self.parts[s] = got
        return got

    def __missing__(self, s: str) -> bytes:
        m = _SPLIT.match(s)
        got = self[s] = self._part(m[1].lower()) + self._part(m[2]) if m else self._part(s)
        return got

    def ids(self, text: str) -> bytes:
        got = b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))
        if len(self) > CHUNKS:
            self.clear()  # made again from parts, which costs less than tokenizing
        if len(self.parts) > PARTS:
            self.parts = {"": b""}
        return got


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, step = kept(f"tokens {path}", lambda: TokenCache(path)), 4 * capacity
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = cache.ids(text.as_py() or "") + b"\0\0\0\0"
                for at in range(0, len(data), step):
                    part = data[at : at + step]
                    out.append((doc, at // step, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, PIECES)


class _Run:
    """`n` sequences that hold the same lengths; items are (length, first rank)."""

    __slots__ = ("items", "n", "room")

    def __init__(self, n: int, room: int, items: list[tuple[int, int]]) -> None:
        self.n, self.room, self.items = n, room, items

    def split(self, n: int) -> _Run:
        """Take n sequences off the front."""
        front = _Run(n, self.room, list(self.items))
        self.n -= n
        self.items = [(length, rank + n) for length, rank in self.items]
        return front


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Fill sequences with few sizes: (indexes of sizes, how many sequences), largest size first.

    Each round opens with the largest size left and finds the fullest
    completion by subset sums; it is repeated as long as the counts allow, so
    every round uses up a size or leaves a remainder smaller than a multiplicity.
    """
    out, left = [], list(counts)
    while any(left):
        top = max((i for i in range(len(sizes)) if left[i]), key=lambda i: sizes[i])
        room, best = capacity - sizes[top], {0: ()}
        smallest = min(s for s, c in zip(sizes, left) if c)
        for _ in range(room // smallest):
            more = {}
            for total, used in best.items():
                for i in range(used[-1] if used else 0, len(sizes)):
                    t = total + sizes[i]
                    if t <= room and t not in best and t not in more and left[i] > used.count(i) + (i == top):
                        more[t] = (*used, i)
            if not more:
                break
            best |= more
        config = [top, *best[max(best)]]
        times = min(left[i] // config.count(i) for i in set(config))
        for i in config:
            left[i] -= times
        out.append((config, times))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): a run of pieces and where it goes."""
    runs: list[_Run] = []
    large = sorted((n for n in histogram if capacity // SMALL < n < capacity), reverse=True)
    if histogram.get(capacity):
        runs.append(_Run(histogram[capacity], 0, [(capacity, 0)]))
    # Linear grouping: cut the sorted large pieces into groups of equal cardinality.
    total = sum(histogram[n] for n in large)
    each = max(1, -(-total // groups))
    members: list[list[list[int]]] = []  # of each group: [length, first rank, how many]
    fill = each
    for n in large:
        rank = 0
        while rank < histogram[n]:
            if fill == each:
                members.append([])
                fill = 0
            take = min(each - fill, histogram[n] - rank)
            members[-1].append([n, rank, take])
            rank, fill = rank + take, fill + take
    sizes = [g[0][0] for g in members]
    # Substitution: a configuration's slots take the group's actual lengths in order.
    for config, times in _configurations(sizes, [sum(m[2] for m in g) for g in members], capacity):
        while times:
            slots, need = [], {}
            for i in config:
                need[i] = need.get(i, 0) + 1
            n = times
            for i, k in need.items():
                head = members[i][0]
                n = min(n, max(1, head[2] // k))
            for i in config:
                head = members[i][0]
                if head[2] < n:  # fewer left of this length than the slots ask for: one sequence, mixed lengths
                    n = 1
            for i in config:
                head = members[i][0]
                slots.append((head[0], head[1]))
                head[1], head[2] = head[1] + n, head[2] - n
                if not head[2]:
                    members[i].pop(0)
            runs.append(_Run(n, capacity - sum(s[0] for s in slots), slots))
            times -= n
    # Best fit for the small ones, from the largest down.
    by_room: dict[int, list[_Run]] = {}
    for r in runs:
        by_room.setdefault(r.room, []).append(r)
    for length in sorted((n for n in histogram if n <= capacity // SMALL), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = min((x for x in by_room if x >= length and by_room[x]), default=None)
            if room is None:
                fresh = _Run(max(1, left // (capacity // length)), capacity, [])
                by_room.setdefault(capacity, []).append(fresh)
                continue
            r = by_room[room].pop()
            fit = min(left, r.n)
            if fit < r.n:
                front = r.split(fit)
                by_room[room].append(r)
                r = front
            r.items.append((length, rank))
            r.room -= length
            by_room.setdefault(r.room, []).append(r)
            rank, left = rank + fit, left - fit
    done = [r for rs in by_room.values() for r in rs if r.items]
    out, sequence = [], 0
    for r in done:
        offset = 0
        for length, rank in r.items:
            out.append((length, rank, rank + r.n - 1, sequence, offset))
            offset += length
        sequence += r.n
    return out


def ranked(found: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Add rank, from 0 within each length. The pieces of a length are in some root of their number of parts, and each part has as many."""
    salts = found.sparkSession.createDataFrame([(n, isqrt(c) + 1) for n, c in counts.items()] or [(0, 1)], "length long, salts long")
    salted = found.join(F.broadcast(salts), "length")  # a row for each length, at most `capacity`
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("nr"), "salts")).drop("salts")  # equal rows part too
    parts = salted.groupBy("length", "salt").count()
    parts = parts.withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("nr")) - 1
    return salted.withColumn("within", within).join(parts.drop("count"), ["length", "salt"]).withColumn("rank", F.col("within") + F.col("before")).drop("salt", "within", "before", "nr")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with the sequence it goes to and its offset there."""
    found = written(pieces(docs, path, capacity).withColumn("nr", F.monotonically_increasing_id()))
    counts = {r[0]: r[1] for r in found.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = docs.sparkSession.createDataFrame(
        plan(counts, capacity) or [(0, 0, 0, 0, 0)], "length long, first long, last long, sequence long, offset long"
    )
    placed = _place(ranked(found, counts), runs)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def _place(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """The run of each row: the last one of its length that begins at or before its rank."""
    by_length = runs.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "sequence", "offset"))).alias("runs"))
    at = F.broadcast(by_length)  # a row for each length, at most `capacity`
    found = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    return rows.join(at, "length").withColumn("run", found).select("*", "run.first", "run.sequence", "run.offset")


def query(spark, sf_dir):
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
