"""Personal data: exact patterns, and a linear-chain CRF over word shapes.

Base spans come from four patterns, leftmost and non-overlapping for each kind.
A CRF, trained on a small labelled table, tags the words of every line with a
kind or OUT by Viterbi and adds what the patterns don't cover: numbers without
a country code, spelled-out addresses, keys and tokens, national numbers (id).
An added span that touches a base span is dropped; base spans always stay.

Lines in which no word can win against OUT, whatever its neighbours, are all
OUT without a search: a word's best lead over OUT plus the best two transitions
is not positive. The other lines are decoded in numpy, many at a time.

Defined cases: a null text is empty; an empty text has no spans; where two labels
score alike the first of the list goes, OUT before all; repeated rows give a row
each; an empty table gives no rows; a very long text is read whole, in time that
grows with its length, at some 200 bytes of a worker's memory a word; other
columns play no part and, in redact(), pass through.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import kept, shared, small_batches

KINDS = ("email", "ip", "card", "phone", "secret", "id")
OUT = 0  # label of other words; kind k has label k + 1

# The patterns that the contract fixes, in forms that never rescan a run: an
# address is found at its @ and grown to the left, and numbers start where no
# digit stands before.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out, last = [], 0
    if "@" in text:
        for m in _AT.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((0, start, m.end()))
                last = m.end()
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def written_out(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_CUES = frozenset(
    "[at] [dot] (at) (dot) mail email e-mail tel tel. phone call mobile fax key token secret password passwd api_key bearer ssn = : is my".split()
)
_RUN = re.compile(r"([a-z])[a-z]*|([A-Z])[A-Z]*|([0-9])[0-9]*|(\w)\w*|(.)\5*", re.S)
_HEX = re.compile(r"[\"'(]*[0-9a-fA-F]{20,}[\"').,;!?#$%&*]*\Z")


_ENDING = re.compile(r"[^\W\d_]+[0-9]+\Z")  # a word with a number behind it
_GROUPS = re.compile(r"\(?[0-9]{1,6}(?:[-.()]+[0-9]{1,6}){0,4}")


def _shape(word: str) -> str:
    """Runs of letters, capitals, digits and marks, one character each, six at most."""
    marks = ("x", "X", "9", "w")
    return "".join(next((c for c, g in zip(marks, m.groups()) if g), m[5] or "") for m, _ in zip(_RUN.finditer(word), range(6)))


def features(word: str) -> tuple[str, ...]:
    """What the CRF sees of a word."""
    low = word.lower()
    if low in _CUES:
        return ("cue " + low, "plain")
    if word.isalpha():
        return ("plain",)
    digits = sum(c.isdigit() for c in word)
    bucket = next((n for n in (0, 1, 2, 3, 4, 8, 12, 19) if digits <= n), 99)
    out = ["shape " + _shape(word), f"digits {bucket}", "ends " + ("d" if word[-1:].isdigit() else "a" if word[-1:].isalpha() else "m")]
    if _HEX.match(word):
        out.append("hex")
    core = word.strip(".,;:!?\"'#$%&*|()[]")
    if not core or core.isalpha():
        out.append("marked")
    if digits and all(c in "0123456789.-()" for c in core):
        out.append("number")
        if 13 <= digits <= 19:
            out.append("checked number" if luhn("".join(c for c in word if c in "0123456789")) else "long number")
    if core[:1] in "([" or word[:1] in "([":
        out.append("opens")
    if "@" in core:
        out.append("at sign")
    elif "=" not in core and 0 < digits < len(core) and (digits > 1 or len(core) > 15):
        letters = sum(c.isalpha() for c in core)
        if letters > 3 and not _ENDING.match(core):
            out.append(f"mixed {min(len(core) // 8, 4)}")
    groups = _GROUPS.fullmatch(core)
    if groups:
        out.append("groups " + " ".join(str(len(g)) for g in re.split(r"[-.()]+", core) if g))
    return tuple(out)


def labelled_table(rows: int = 900, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """The training table: sentences of filler with an item of one kind, or with numbers that are none."""
    rng = random.Random(seed)
    syllables = "the an ing re ion den er que ment le os ado ver ge sch pa ou th en ich".split()
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def filler() -> str:
        word = "".join(rng.choice(syllables) for _ in range(rng.choice((1, 1, 2, 3))))
        word = rng.choice((word, word, word, word.capitalize(), word.upper()))
        return word + rng.choice(("", "", "", "", ",", ".", "!!", "###", "%%%", " |")).strip(" ")

    def secret() -> str:
        mixed = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
        small, digit = "abcdefghijklmnopqrstuvwxyz", "0123456789"
        large = small.upper()
        return rng.choice((
            '"' + mixed(rng.choice((32, 40, 64)), digit + "abcdef") + '"',
            mixed(rng.choice((24, 32, 40, 64)), digit + "abcdef"),
            rng.choice((small[:3], "sk", "pk", "key")) + "_" + rng.choice(("live", "test", "prod")) + "_" + mixed(rng.randrange(16, 33), small + large + digit),
            rng.choice(("AK", "AS", "AG")) + mixed(2, large) + mixed(16, large * rng.choice((1, 3)) + digit),
            rng.choice(("ghp", "glpat", "xoxb")) + rng.choice("_-") + mixed(rng.randrange(20, 37), small + large + digit),
            mixed(rng.randrange(20, 45), small + large + digit * 2 + "+/"),
        ))

    def item() -> tuple[list[str], int]:
        kind = rng.randrange(12)
        name, host = rng.choice(syllables) + rng.choice(syllables), rng.choice(syllables) + rng.choice((".com", ".org", ".net"))
        if kind == 0:
            return [rng.choice(("", "", name + ".")) + name + digits(rng.randrange(3)) + "@" + host], 1
        if kind == 1:
            at, dot = rng.choice((("[at]", "[dot]"), ("(at)", "(dot)")))
            return [name, at, host.split(".")[0], dot, host.split(".")[1]], 1
        if kind == 2:
            return [".".join(str(rng.randrange(1, 256)) for _ in range(4))], 2
        if kind == 3:
            number = digits(15)
            number = next(number + c for c in "0123456789" if luhn(number + c))
            fours = [number[i : i + 4] for i in range(0, 16, 4)]
            return rng.choice(([number], fours, ["-".join(fours)], [".".join(fours)])), 3
        if kind == 4:
            return [f"+{digits(rng.choice((1, 2)))}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], 4
        if kind == 5:
            return [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], 4
        if kind == 6:
            return [f"{digits(3)}-{digits(3)}-{digits(4)}"], 4
        if kind == 7:
            return rng.choice(([digits(3), digits(3), digits(4)], [f"{digits(3)}.{digits(3)}.{digits(4)}"], [f"({digits(3)}){digits(3)}-{digits(4)}"], ["0" + digits(2), digits(4), digits(4)])), 4
        if kind == 8:
            return [f"{digits(3)}-{digits(2)}-{digits(4)}"], 6
        return [secret()], 5

    def other() -> list[str]:
        """Numbers that are nobody's."""
        return rng.choice(
            ([digits(rng.randrange(1, 6))], [f"{digits(1)}.{digits(1)}"], [f"{digits(1)}.{digits(1)}."], ["version", f"{digits(1)}."], [f"{digits(4)}-{digits(2)}-{digits(2)}"], [f"{digits(2)}:{digits(2)}"], ["$" + digits(3)], [f"({digits(4)})"], [filler() + digits(1)], [filler().strip(".,!#%| ") + digits(rng.randrange(2, 5))], ["BY-NC", "4.0."], [digits(15) + "0"], [digits(14) + "17"], ["at", filler(), "dot"], [digits(3), filler(), digits(4)], [digits(4), digits(2)], [f"{digits(2)}/{digits(2)}/{digits(4)}"], [f"{digits(1)}.{digits(2)}.{digits(1)}"], ["token", "=", filler()])
        )

    out = []
    for _ in range(rows):
        words: list[str] = []
        labels: list[int] = []
        for _ in range(rng.randrange(1, 4)):
            words += (f := [filler() for _ in range(rng.randrange(1, 7))])
            labels += [OUT] * len(f)
            if rng.random() < 0.55:
                found, label = item()
                if label == 5:
                    cue = rng.choice((["token", "="], ["key", "="], ["password:"], ["secret", ":"], ["api_key", "="], ["bearer"], [], []))
                    words += cue
                    labels += [OUT] * len(cue)
                elif rng.random() < 0.3:
                    words.append(rng.choice(("phone", "mail", "call", "is")))
                    labels.append(OUT)
                mark = rng.choice(("", "", "", "", ".", ",", "!!", "###"))
                words += [*found[:-1], found[-1] + mark]
                labels += [label] * len(found)
            else:
                words += (found := other())
                labels += [OUT] * len(found)
        out.append((words, labels))
    return out


class Crf:
    """Weights for each feature of the word before, the word itself and the word after, and transitions."""

    def __init__(self, table: list[tuple[list[str], list[int]]], epochs: int = 14, rate: float = 0.08, decay: float = 1e-4) -> None:
        self.names = {f: n for n, f in enumerate(dict.fromkeys(f for words, _ in table for w in words for f in features(w)))}
        self.stamp = hashlib.sha256(repr((table, epochs, rate, decay)).encode()).hexdigest()[:16]
        n, k = len(self.names), len(KINDS) + 1
        self.emit, self.move = np.zeros((3, n + 1, k)), np.zeros((k, k))  # feature n: beyond the line's ends
        rows = [([[n], *([self.names[f] for f in features(w)] for w in words), [n]], np.array(labels)) for words, labels in table]
        squares = [np.full_like(self.emit, 1e-8), np.full_like(self.move, 1e-8)]
        rng = np.random.default_rng(1)
        for _ in range(epochs):
            for pick in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 30)):
                grads = [-decay * len(pick) * self.emit, -decay * len(pick) * self.move]
                for i in pick:
                    self._gradient(*rows[i], grads)
                for value, grad, square in zip((self.emit, self.move), grads, squares):
                    square += grad**2
                    value += rate * grad / np.sqrt(square)

    def _scores(self, ids: list[list[int]]) -> np.ndarray:
        each = [np.stack([e[i].sum(axis=0) for i in ids]) for e in self.emit]
        return each[0][:-2] + each[1][1:-1] + each[2][2:]

    def _gradient(self, ids: list[list[int]], labels: np.ndarray, grads: list[np.ndarray]) -> None:
        """Observed less expected counts, by forward and backward sums."""
        score = self._scores(ids)
        t, k = score.shape
        ahead, back = np.zeros((t, k)), np.zeros((t, k))
        total = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
        ahead[0] = score[0]
        for i in range(1, t):
            ahead[i] = score[i] + total(ahead[i - 1][:, None] + self.move, 0)
        for i in range(t - 2, -1, -1):
            back[i] = total(self.move + score[i + 1] + back[i + 1], 1)
        norm = total(ahead[-1], 0)
        node = -np.exp(ahead + back - norm)
        node[np.arange(t), labels] += 1
        for i in range(t):
            for where, near in enumerate((ids[i], ids[i + 1], ids[i + 2])):
                grads[0][where][near] += node[i]
        for i in range(1, t):
            grads[1] -= np.exp(ahead[i - 1][:, None] + self.move + score[i] + back[i] - norm)
            grads[1][labels[i - 1], labels[i]] += 1

    def types(self) -> WordTypes:
        return WordTypes(self)


class WordTypes(dict):
    """word -> number of its feature set; the scores of each set are summed up once."""

    LIMIT = 200_000

    def __init__(self, crf: Crf) -> None:
        self.crf = crf
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.known = {(): 0}
        self.rows = [self.crf.emit[:, len(self.crf.names)]]  # 0: beyond the line's ends
        self._table = np.zeros((0, 3, self.crf.move.shape[0]))

    def __missing__(self, word: str) -> int:
        key = features(word)
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = len(self.rows)
            self.rows.append(sum((self.crf.emit[:, self.crf.names[f]] for f in key if f in self.crf.names), np.zeros((3, self.crf.move.shape[0]))))
        self[word] = got
        return got

    def table(self) -> np.ndarray:
        if len(self._table) < len(self.rows):
            self._table = np.concatenate([self._table, np.stack(self.rows[len(self._table) :])])
        return self._table


def viterbi(score: np.ndarray, move: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Best labels of many lines, given all words' scores in a row and where the lines begin."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    best, back = score[starts].copy(), np.zeros(score.shape, np.int8)
    last = best.copy()
    for t in range(1, int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -t))  # lines that are longer than t
        step = last[:n, :, None] + move
        back[starts[:n] + t] = step.argmax(axis=1)
        last[:n] = step.max(axis=1) + score[starts[:n] + t]
    out = np.zeros(len(score), np.int8)
    now = last.argmax(axis=1)
    for t in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
        n = int(np.searchsorted(-sizes, -t))
        at = starts[:n] + t
        out[at] = now[:n]
        now[:n] = np.take_along_axis(back[at], now[:n, None], 1)[:, 0]
    return out


_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}\Z")


def is_quad(text: str) -> bool:
    """Four parts of at most 255: an added address of the net is nothing else, whatever looks like one."""
    return bool(_QUAD.match(text)) and all(int(p) <= 255 for p in text.split("."))


_WORD = re.compile(r"\S+")
_TRIM = ".,;:!?\"'#$%&*|"


def added_spans(texts: list[str], types: WordTypes) -> list[list[tuple[int, int, int]]]:
    """Spans that the CRF sees in each text."""
    if len(types) > types.LIMIT:
        types.forget()
    lines = [t.split("\n") for t in texts]
    words = [line.split() for text in lines for line in text]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    gap = np.zeros(int(sizes.sum()) + len(words) + 1, np.int64)  # lines stand apart by type 0
    starts = np.cumsum(sizes + 1) - sizes
    inside = np.ones(len(gap), bool)
    inside[0] = False
    inside[starts + sizes] = False
    gap[inside] = np.fromiter(map(types.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    table, move = types.table(), types.crf.move
    lead = [table[:, w] - table[:, w, :1] for w in range(3)]
    score = np.zeros((len(gap), move.shape[0]))
    score[1:-1] = lead[0][gap[:-2]] + lead[1][gap[1:-1]] + lead[2][gap[2:]]
    risky = score[:, 1:].max(axis=1) + 2 * max(0.0, float(move.max() - move[OUT, OUT])) > 0
    risky &= inside
    risen = np.concatenate([[0], np.cumsum(risky)])
    open_lines = np.flatnonzero(risen[starts + sizes] > risen[starts])
    labels = np.zeros(len(gap), np.int8)
    if len(open_lines):
        labels = viterbi(score, move, starts[open_lines], sizes[open_lines])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    first_line = np.cumsum([0, *map(len, lines)])
    ends = np.cumsum([0, *(len(x) + 1 for own in lines for x in own)])  # of all lines in a row
    for n in open_lines.tolist():
        tags = labels[starts[n] : starts[n] + sizes[n]]
        if not tags.any():
            continue
        text = int(np.searchsorted(first_line, n, side="right")) - 1
        own = lines[text]
        begin = int(ends[n] - ends[first_line[text]])
        places = [m.span() for m in _WORD.finditer(own[n - first_line[text]])]
        i = 0
        while i < len(tags):
            j = i + 1
            while j < len(tags) and tags[j] == tags[i]:
                j += 1
            if tags[i]:
                a, b = begin + places[i][0], begin + places[j - 1][1]
                while a < b and texts[text][a] in _TRIM:
                    a += 1
                while b > a and texts[text][b - 1] in _TRIM:
                    b -= 1
                if a < b and (KINDS[tags[i] - 1] != "ip" or is_quad(texts[text][a:b])):
                    out[text].append((int(tags[i]) - 1, a, b))
            i = j
    return out


def all_spans(texts: list[str], types: WordTypes) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, base and added spans) of each text, by kind, then start."""
    out = []
    for text, more in zip(texts, added_spans(texts, types)):
        base = base_spans(text)
        out.append((base, sorted(base + _apart(more, base))))
    return out


def _apart(more: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of `more` that touch no base span. Base spans of different kinds can overlap, so each start knows the furthest end so far."""
    starts, ends, far = [], [], 0
    for _, a, b in sorted(base, key=lambda s: s[1]):
        far = max(far, b)
        starts.append(a)
        ends.append(far)
    return [s for s in more if not (n := bisect_left(starts, s[2])) or ends[n - 1] <= s[1]]


CHARS_AT_ONCE = 1 << 20


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) for some CHARS_AT_ONCE characters at a time."""
    begin, texts, size = 0, [], 0
    for n, text in enumerate(batch.column(column)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHARS_AT_ONCE:
            yield begin, texts
            begin, texts, size = n + 1, [], 0
    if texts:
        yield begin, texts


def find(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, numbers of base spans by kind, base_sha256 and spans; then the numbers of all spans, in all and by kind."""
    crf_of, stamp = shared(docs.sparkSession, crf), crf.stamp

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = kept(f"types {stamp}", lambda: crf_of().types())
        for batch in batches:
            for begin, texts in chunks(batch, 1):
                got = all_spans(texts, types)
                counts = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in got], pa.int64()) for kind in range(4)]
                more = [pa.array([len(a) for _, a in got], pa.int64()), *(pa.array([sum(k == kind for k, _, _ in a) for _, a in got], pa.int64()) for kind in range(len(KINDS)))]
                digest = [hashlib.sha256(written_out(b).encode()).hexdigest() for b, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), *counts, pa.array(digest, pa.string()), pa.array([written_out(a) for _, a in got], pa.string()), *more],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans", *(f"n_all_{k}" for k in KINDS)],
                )

    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return texts.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, " + ", ".join(f"n_all_{k} long" for k in KINDS))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, last = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= last:
            out += [text[last:a], f"<{KINDS[k].upper()}>"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, crf: Crf) -> DataFrame:
    """docs with personal data replaced in text, n_chars following, all other columns as they are."""
    crf_of, stamp = shared(docs.sparkSession, crf), crf.stamp
    at = docs.columns.index("text")
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = kept(f"types {stamp}", lambda: crf_of().types())
        for batch in batches:
            for begin, texts in chunks(batch, at):
                part = batch.slice(begin, len(texts))
                new = [redacted(t, s) for t, (_, s) in zip(texts, all_spans(texts, types))]
                new = [n if old.is_valid else None for n, old in zip(new, part.column(at))]
                columns = list(part.columns)
                columns[at] = pa.array(new, part.schema.field(at).type)
                if length is not None:
                    columns[length] = pa.array([None if n is None else len(n) for n in new], part.schema.field(length).type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return small_batches(docs).mapInArrow(run, docs.schema)


def trained() -> Crf:
    return Crf(labelled_table())


def query(spark, sf_dir):
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), trained())
