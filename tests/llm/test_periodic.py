"""Periodic runs against a plain search over every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from gridlode.llm import periodic


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at < len(words) - q:
            end = at
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            n = end - at + q
            if end > at and n >= max(24, 3 * q) and not any(all(words[k] == words[k + d] for k in range(at, at + n - d)) for d in range(1, q)):
                found.append((at, n, q))
            at = max(end, at + 1)
    return sorted(found)


def plain_row(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    out = {i for s, m, q in found for i in range(s + q, s + m)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in out)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest("".join(f"{s},{m},{q}\n" for s, m, q in found)), digest(kept))


def sample(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        kinds, size = rng.choice([1, 2, 3, 5, 50]), rng.choice([0, 1, 5, 30, 80, 200])
        words = [f"w{rng.randrange(kinds)}" for _ in range(size)]
        for _ in range(rng.randrange(4)):
            unit = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 20))] * rng.randrange(1, 6)
            at = rng.randrange(len(words) + 1)
            words[at:at] = unit[: rng.randrange(1, len(unit) + 1)]
        yield words


@pytest.mark.parametrize("limit", [periodic.heavy_limit, lambda n: 3.0])
def test_runs_equal_a_plain_search(monkeypatch, limit):
    """With frequent words counted by FFT where they are many, or all of them."""
    monkeypatch.setattr(periodic, "heavy_limit", limit)
    texts = list(sample(1, 150))
    assert periodic.block_runs(texts) == [plain_runs(t) for t in texts]


def test_lag_counts_are_exact(monkeypatch):
    monkeypatch.setattr(periodic, "DIFFERENCES_AT_ONCE", 1_000)
    rng = np.random.default_rng(2)
    texts = [np.minimum(rng.zipf(1.3, n), 400) for n in (3_000, 7, 900)]
    counts, base = periodic.lag_counts(np.concatenate(texts), np.array([len(t) for t in texts]))
    for t, b in zip(texts, base):
        often = np.isin(t, [w for w in np.unique(t) if (t == w).sum() >= 3])
        assert counts[b + 1 : b + len(t) // 3 + 1].tolist() == [int(((t[:-q] == t[q:]) & often[:-q]).sum()) for q in range(1, len(t) // 3 + 1)]


def test_one_long_run_opens_one_lag(monkeypatch):
    scans = []
    plain = periodic.islands
    monkeypatch.setattr(periodic, "islands", lambda w, lag: scans.append(lag) or plain(w, lag))
    assert periodic.block_runs([[b"a", b"b", b"c"] * 20_000]) == [[(0, 60_000, 3)]] and scans == [3]


def test_query_equals_a_plain_version(spark, tmp_path):
    rows = [(n, " ".join(t)) for n, t in enumerate(sample(3, 120))]
    rows += [(500, None), (501, ""), (502, " \t\n\v\f\r "), (None, "x y " * 30), (None, None), (503, "é b c\x1cd " * 30), (7, "a b " * 20), (7, "a b " * 20), (30, "k\n" * 23), (31, "k\t" * 24), (600, " ".join(f"w{k % 700}" for k in range(20_000)))]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, n_words int, runs string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic.query(spark, str(tmp_path)).collect()]
    want = [plain_row(i, t, True) for i, t in rows if i != 600]
    assert sorted((r for r in got if r[0] != 600), key=repr) == sorted(want, key=repr)
    assert [r[2:6] for r in got if r[0] == 600][0][0] is not None and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    assert periodic.runs(docs.limit(0)).count() == 0


def test_collapsed_text_keeps_one_period(spark):
    docs = spark.createDataFrame([(1, "start " + "a b c " * 20 + "end")], "doc_id long, text string")
    row = periodic.runs(docs).first()
    assert row["collapsed"] == "start a b c end" and [tuple(r) for r in row["runs"]] == [(1, 60, 3)] and row["n_words"] == 62
