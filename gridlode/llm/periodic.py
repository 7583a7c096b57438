"""Periodic runs of words: stretches that repeat a period at least LEAST_REPEATS times.

A run is a stretch of consecutive words in which words `period` apart are equal,
for the smallest such period, which no neighbouring word extends, of
max(LEAST_WORDS, LEAST_REPEATS * period) words or more.

Heavy/light lag counting says which lags can hold a run at all. A run of period
q has length - q pairs of equal words at distance q, so a lag needs that many
equal pairs in the whole text. They are counted exactly for every lag up to a
third of the text: pairs of the same rare word by their differences, those of
frequent words by the autocorrelation of each word's indicator, whose spectra
are added before one inverse FFT (sums below 2^40 round to the exact integer). A
word is frequent above sqrt(n log2 n) occurrences, which balances the two. A
word with fewer than LEAST_REPEATS occurrences is in no run and is not counted.

Only lags with enough pairs get an island scan, from the smallest up. The pairs
that a found run of period d has at multiples of d are taken off first: a
primitive run of period q shares fewer than q words with it, and so no pair at
distance q. That keeps one long run from opening all its multiples; a scan that
yields a known stretch again is dropped, as its period isn't the smallest.

Defined cases: a null or empty text, or one of white space, has no words, no run
and an empty collapsed text; a null doc_id stays null; repeated rows give a row
each; an empty table gives no rows; ties between runs go to the smallest start,
then the smallest period; a very long text is held whole, at some 200 bytes of a
worker's memory a word, and counted in about n^1.5 steps; other columns play no
part. Nothing is shuffled, so no key, copy or word can be hot.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import crc_mod, small_batches

LEAST_WORDS, LEAST_REPEATS = 24, 3
BLOCK_WORDS = 1 << 18  # texts are counted together up to this many words; a longer one alone
DIFFERENCES_AT_ONCE = 1 << 21
SPACE = r"[\x20\x09-\x0D]+"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def least_pairs(lag):
    """Equal pairs at that distance in the shortest run of that period."""
    return np.maximum(LEAST_WORDS, LEAST_REPEATS * lag) - lag


def heavy_limit(n: int) -> float:
    return max(64.0, (n * np.log2(max(2, n))) ** 0.5)


def _rare_differences(at: np.ndarray, group: np.ndarray, most: np.ndarray) -> Iterator[np.ndarray]:
    """(index, distance) of all pairs in a group, up to the index's `most`; at ascends in each group."""
    left, k = np.arange(len(at)), 1
    while len(left):
        left = left[left + k < len(at)]
        far = at[left + k] - at[left]
        near = (group[left + k] == group[left]) & (far <= most[left])  # farther ones only go on failing
        left, far = left[near], far[near]
        yield left, far
        k += 1


def lag_counts(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal pairs by lag for several texts in a row: (counts, where each text's lag 0 is).

    A text of n words has the lags 0 to n // LEAST_REPEATS; lag 0 is left at 0.
    """
    room = sizes // LEAST_REPEATS + 1
    base = np.cumsum(room) - room
    counts = np.zeros(int(room.sum()), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    key = owner * (int(ids.max(initial=0)) + 1) + ids
    at = np.argsort(key, kind="stable")
    key = key[at]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    often = np.diff(edges)
    often = np.repeat(often, often)
    limits = np.array([heavy_limit(int(n)) for n in sizes])[owner[at]]
    rare = (often >= LEAST_REPEATS) & (often <= limits)
    kept, waiting = [], 0
    where, text = at[rare], owner[at[rare]]
    for left, far in _rare_differences(where, key[rare], sizes[text] // LEAST_REPEATS):
        kept.append(base[text[left]] + far)
        waiting += len(far)
        if waiting > DIFFERENCES_AT_ONCE:
            counts += np.bincount(np.concatenate(kept), minlength=len(counts))
            kept, waiting = [], 0
    if kept:
        counts += np.bincount(np.concatenate(kept), minlength=len(counts))
    heavy = often > limits
    for d in np.unique(owner[at[heavy]]):
        n, lags = int(sizes[d]), int(room[d])
        size = 1 << int(n + lags).bit_length()
        mine = np.flatnonzero(heavy & (owner[at] == d))
        power = np.zeros(size // 2 + 1)
        for places in np.split(at[mine] - begin[d], np.flatnonzero(np.diff(key[mine])) + 1):  # of a word each
            indicator = np.zeros(size)
            indicator[places] = 1
            power += np.abs(np.fft.rfft(indicator)) ** 2
        counts[base[d] + 1 : base[d] + lags] += np.rint(np.fft.irfft(power, size)[1:lags]).astype(np.int64)
    return counts, base


def islands(words: np.ndarray, lag: int) -> list[tuple[int, int]]:
    """(start, length) of the stretches of that period that are long enough and end where it does."""
    breaks = np.flatnonzero(words[:-lag] != words[lag:])
    edges = np.concatenate([[-1], breaks, [len(words) - lag]])
    pairs = np.diff(edges) - 1
    long = pairs >= least_pairs(lag)
    return list(zip((edges[:-1][long] + 1).tolist(), (pairs[long] + lag).tolist()))


def text_runs(words: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period. counts: equal pairs by lag, as lag_counts has them."""
    found: dict[tuple[int, int], int] = {}
    known = defaultdict(list)  # lengths of runs by period
    lags = np.arange(len(counts))
    for lag in np.flatnonzero((counts >= least_pairs(lags)) & (lags > 0)).tolist():
        theirs = sum(n - lag for d, all_ in known.items() if lag % d == 0 for n in all_ if n > lag)
        if counts[lag] - theirs < least_pairs(lag):
            continue
        for stretch in islands(words, lag):
            if stretch not in found:
                found[stretch] = lag
                known[lag].append(stretch[1])
    return sorted((start, length, period) for (start, length), period in found.items())


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def block_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    counts, base = lag_counts(ids, sizes)
    ends, stops = np.cumsum(sizes), np.append(base[1:], len(counts))
    return [text_runs(ids[ends[d] - sizes[d] : ends[d]], counts[base[d] : stops[d]]) for d in range(len(texts))]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[list[bytes]]]]:
    """(ids, words of each text) in blocks of BLOCK_WORDS words, or one longer text."""
    docs, texts, total = [], [], 0
    for doc, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
        words = (text.as_py() or b"").split()  # white space of ASCII alone, as bytes
        if texts and total + len(words) > BLOCK_WORDS:
            yield docs, texts
            docs, texts, total = [], [], 0
        docs.append(doc.as_py())
        texts.append(words)
        total += len(words)
    if texts:
        yield docs, texts


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed: the text's words without the repeats, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _blocks(batch):
                found = block_runs(texts)
                kept = [[w for w, out in zip(t, dropped(len(t), r)) if not out] if r else t for t, r in zip(texts, found)]
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in found], pa.list_(_RUN)),
                    pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)


def strongest(found: Column) -> Column:
    """The run of the greatest exact length / period; of equals the first start, then the smallest period."""

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(x != y, F.when(x > y, -1).otherwise(1)).otherwise(F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(F.signum(a["period"] - b["period"]).cast("int")))

    return F.get(F.array_sort(found, order), F.lit(0))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; of a tenth of the texts, chosen by their id, the tail repeats its first words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = (crc_mod("doc_id", 10) == 0) & F.col("text").isNotNull()
    g = F.floor(h / 10).cast("long")
    split = docs.select("doc_id", "text", g.alias("g"), F.when(chosen, F.filter(F.split("text", SPACE), lambda w: w != "")).alias("words"))
    n = F.size("words").cast("long")
    a = F.col("g") % n
    period = 1 + F.floor((n - a) / (3 + F.col("g") % 8)).cast("long")
    sized = split.select("doc_id", "text", "words", F.when(n > 0, a).alias("a"), F.when(n > 0, period).alias("p"))
    place = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    tail = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get(F.col("words"), place(i))))
    return sized.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir):
    found = runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = found.select("*", strongest(F.col("runs")).alias("best"))
    line = lambda r: F.concat(F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
