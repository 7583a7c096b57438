"""Conversations as training windows of a token budget.

A turn is rendered as `### role: text</turn>` and a line feed. Inside texts a
backslash is doubled and a control string gets one after its first character, so
neither `###` nor `</turn>` stands in any text and what was there comes back.

Windows: each rendered turn is tokenized on its own, and prefix sums of the
counts choose spans of whole turns by binary search. A window has the
conversation's first turn, if its role is `system`, then repeated history (at
most HISTORY_TURNS turns and HISTORY_TOKENS tokens, and no more than leaves room
for the next turn), then as many new turns as fit. So each turn is new in one
window only; the loss mask holds the texts of the new assistant turns, and a
target that is repeated as history is masked out. A turn for which the budget has
no room even so is a window of its own with fits = false: turns are never cut.

Conversations are cut where turn numbers pass a multiple of SEGMENT_TURNS; a
segment is given the history before it and the system turn, and tasks read
segments row by row, so neither a conversation nor a segment is held in memory.

Defined cases: a null text or role is empty; rows without conv_id are one
conversation; rows without turn come first; rows that share a turn number are
turns of their own, by role, then text, and so are repeated rows; a system turn
other than the first is a turn like any other; an empty table gives no windows;
a very long text is held whole, one at a time; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import kept, small_batches
from gridlode.llm.packing import TokenCache

BUDGET = 2048
HISTORY_TURNS, HISTORY_TOKENS = 4, 512
SEGMENT_TURNS = 4096
FLUSH_BUDGETS = 32  # spans are chosen when so many budgets of turns have been read, or the segment ends

OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
SYSTEM, TARGET = "system", "assistant"
_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_CONTROL_IN_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:(?= )")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

WINDOWS = "conv_id long, segment long, window long, repeated int, tokens long, fits boolean, text string, loss array<struct<start:int,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def _marked(m: re.Match) -> str:
    return m[0] + "\\"


def escaped(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(_marked, text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def rendered(role: str, text: str) -> tuple[str, int]:
    """The turn, and where its text begins in it."""
    head = OPEN + escaped(role, _CONTROL_IN_ROLE) + BETWEEN
    return head + escaped(text) + CLOSE, len(head)


def parsed(window: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn of a window's text."""
    at = 0
    while at < len(window):
        end = window.index(CLOSE, at)
        start = window.index(BETWEEN, at, end) + len(BETWEEN)
        yield unescaped(window[at + len(OPEN) : start - len(BETWEEN)]), unescaped(window[start:end]), start, end
        at = end + len(CLOSE)


def spans(tokens: list[int], first: int, low: int, system: int, budget: int, turns: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(first repeated, first new, end) of each window over the turns from `first` on; history reaches back to `low` at most.

    system: tokens of the system turn that opens each window, but for one that begins below `low`, as that is the turn itself.
    """
    sums = np.concatenate([[0], np.cumsum(np.array(tokens, np.int64))])
    while first < len(tokens):
        left = budget - (system if first >= low else 0)
        back = int(np.searchsorted(sums, sums[first] - max(0, min(left - tokens[first], most)), "left"))
        back = min(first, max(back, first - turns, low))
        end = int(np.searchsorted(sums, sums[back] + left, "right")) - 1
        yield back, first, max(first + 1, end)
        first = max(first + 1, end)


class _Segment:
    """The turns of a segment that are still needed, as (role, rendered, where the text begins, tokens)."""

    def __init__(self, key: tuple, budget: int, turns: int, most: int) -> None:
        self.key, self.budget, self.turns, self.most = key, budget, turns, most
        self.rows, self.lead, self.made, self.waiting = [], 0, 0, 0  # lead: rows of history alone
        self.system, self.opening, self.heads = None, True, False  # heads: the first row is the system turn itself

    def add(self, kind: int, row: tuple) -> None:
        """kind: 0 the conversation's first turn, if it's in another segment; 1 history; 2 a turn of the segment's own."""
        if kind == 0:
            self.system, self.opening = row if row[0] == SYSTEM else None, False
            return
        if kind == 2 and self.opening and row[0] == SYSTEM:
            self.system, self.heads = row, True
        self.opening &= kind != 2
        self.rows.append(row)
        self.lead += kind == 1
        self.waiting += row[3] * (kind == 2)

    def windows(self, last: bool) -> Iterator[tuple]:
        """Windows that further turns can't change, or all."""
        if not last and self.waiting < FLUSH_BUDGETS * self.budget:
            return
        chosen = list(spans([r[3] for r in self.rows], self.lead, int(self.heads), self.system[3] if self.system else 0, self.budget, self.turns, self.most))
        for back, first, end in chosen if last else chosen[:-1]:
            yield self._window(back, first, end)
        if not last:
            first = chosen[-1][1]
            gone = max(0, first - self.turns)
            self.rows, self.lead, self.heads = self.rows[gone:], first - gone, self.heads and not gone
            self.waiting = sum(r[3] for r in self.rows[self.lead :])

    def _window(self, back: int, first: int, end: int) -> tuple:
        repeats = self.rows[back:first]
        if self.system and first >= int(self.heads):
            repeats = [self.system, *repeats]
        parts, loss, at, tokens = [], [], 0, 0
        for n, (role, turn, begins, size) in enumerate([*repeats, *self.rows[first:end]]):
            if n >= len(repeats) and role == TARGET:
                loss.append({"start": at + begins, "end": at + len(turn) - len(CLOSE)})
            parts.append(turn)
            at, tokens = at + len(turn), tokens + size
        self.made += 1
        return (*self.key, self.made - 1, len(repeats), tokens, tokens <= self.budget, "".join(parts), loss)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Record batches of some 4 million characters."""
    out, total = [], 0
    for row in rows:
        out.append(row)
        total += 64 + size(row)
        if total > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out, total = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


_WINDOWS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("window", pa.int64()), ("repeated", pa.int32()), ("tokens", pa.int64()), ("fits", pa.bool_()), ("text", pa.string()), ("loss", pa.list_(_SPAN))])
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def segmented(conversations: DataFrame, history: int = HISTORY_TURNS) -> DataFrame:
    """Turns with their segment and kind: own ones (2), the last `history` turn numbers before the segment (1), and the conversation's first turn (0)."""
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    number = F.coalesce(F.floor(F.col("turn") / SEGMENT_TURNS).cast("long"), F.lit(-(1 << 62)))  # none: before all
    own = F.struct(number.alias("segment"), F.lit(2).alias("kind"))
    next_ = F.struct((number + 1).alias("segment"), F.lit(1).alias("kind"))
    near = F.pmod("turn", F.lit(SEGMENT_TURNS)) >= SEGMENT_TURNS - history
    dealt = rows.select("*", F.explode(F.when(near, F.array(own, next_)).otherwise(F.array(own))).alias("at")).select("conv_id", "at.segment", "at.kind", "turn", "role", "text")

    # conversations of several segments are few and their segments a 4096th of their turns
    own_segments = rows.select("conv_id", number.alias("segment")).distinct()
    long = own_segments.groupBy("conv_id").agg(F.min("segment").alias("low"), F.max("segment").alias("high")).where("low < high")
    long = long.select(F.col("conv_id").alias("id"), "low")
    firsts = dealt.where("kind = 2").join(long, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("segment") == F.col("low")))
    firsts = firsts.groupBy("id", "low").agg(F.min(F.struct("turn", "role", "text")).alias("r"))
    heads = own_segments.join(firsts, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("segment") > F.col("low")))
    return dealt.unionByName(heads.select("conv_id", "segment", F.lit(0).alias("kind"), "r.turn", "r.role", "r.text"))


def windows(conversations: DataFrame, path: str, budget: int = BUDGET, turns: int = HISTORY_TURNS, most: int = HISTORY_TOKENS) -> DataFrame:
    """Training windows: conv_id, segment, window (from 0 in a segment), repeated (its leading turns that stood in
    earlier windows), tokens, fits, text, loss (code points of the texts to be learned)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept(f"tokens {path}", lambda: TokenCache(path))

        def found() -> Iterator[tuple]:
            now = None
            for conv_id, segment, kind, role, text in _rows(batches):
                if now is None or now.key != (conv_id, segment):
                    if now:
                        yield from now.windows(True)
                    now = _Segment((conv_id, segment), budget, turns, most)
                turn, begins = rendered(role, text)
                now.add(kind, (role, turn, begins, len(cache.ids(turn)) // 4))
                yield from now.windows(False)
            if now:
                yield from now.windows(True)

        yield from _batches(found(), _WINDOWS, lambda r: len(r[6]))

    dealt = segmented(small_batches(conversations), turns).repartition("conv_id", "segment")
    ordered = dealt.sortWithinPartitions("conv_id", "segment", "kind", "turn", "role", "text")
    return ordered.select("conv_id", "segment", "kind", "role", "text").mapInArrow(run, WINDOWS)


def digests(found: DataFrame) -> DataFrame:
    """What windows say, read back: each turn once and what is learned, hashed in order, conversation by conversation.

    A hash is taken in order, so the windows of a conversation pass through one task, a window at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple]:
            key, now = None, None
            for conv_id, repeated, text, loss in _rows(batches):
                if now is None or key != conv_id:
                    if now:
                        yield (key, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4], now[5])
                    key, now = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for n, (role, said, _, _) in enumerate(parsed(text)):
                    if n >= repeated:
                        now[0] += 1
                        now[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    learned = unescaped(text[span["start"] : span["end"]])
                    now[2] += len(learned)
                    now[3].update(learned.encode())
                now[4] += len(text)
                now[5] += 1
            if now:
                yield (key, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4], now[5])

        yield from _batches(read(), _DIGESTS, lambda r: 0)

    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return ordered.select("conv_id", "repeated", "text", "loss").mapInArrow(run, DIGESTS)


#: Texts that look like the templates that other formats use.
PROBE = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"


def query(spark, sf_dir):
    import public_tokenizers

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return digests(windows(rows.unionByName(probe), public_tokenizers.path("word_bpe_49k.json")))
