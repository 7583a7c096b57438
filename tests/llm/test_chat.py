"""Windows of conversations: the templates' round trip, budgets, history and masks against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridlode.llm import chat

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")

ODD = ["", "\\", "\\\\", "###", "####", "#", "##", "\\###", "### assistant: ", "</turn>", "</turn>\n", "<\\/turn>", "</turn", "<", "a: b", ":", ": ", "\\### Assistant: </turn> ok", "x\n### user: y</turn>\n", "é😀\x00\x1c", "#\\##", "\n"]


def test_template_is_reversible():
    for role in ODD:
        for text in ODD:
            turn, begins = chat.rendered(role, text)
            assert "###" not in turn[3:] and turn.count(chat.CLOSE.strip()) == 1
            two = turn + chat.rendered(text, role)[0]
            assert [x[:2] for x in chat.parsed(two)] == [(role, text), (text, role)]
            assert chat.unescaped(turn[begins : -len(chat.CLOSE)]) == text


def plain_spans(tokens, first, low, system, budget, turns, most):
    while first < len(tokens):
        room = budget - (system if first >= low else 0)
        back = first
        while back > max(low, first - turns, 0) and sum(tokens[back - 1 : first]) <= min(most, room - tokens[first]):
            back -= 1
        end = first + 1
        while end < len(tokens) and sum(tokens[back : end + 1]) <= room:
            end += 1
        yield back, first, end
        first = end


def test_spans_equal_a_plain_search():
    rng = random.Random(4)
    for _ in range(400):
        tokens = [rng.choice([1, 3, 10, 40, 90]) for _ in range(rng.randrange(0, 30))]
        first = rng.randrange(0, min(4, len(tokens)) + 1)
        args = (tokens, first, rng.randrange(2) if first == 0 else 0, rng.choice([0, 5, 60]), rng.choice([20, 60, 100]), rng.randrange(4), rng.choice([0, 15, 50]))
        assert list(chat.spans(*args)) == list(plain_spans(*args))


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int, kind string, loss int")


def conversations(rng, n):
    for c in range(n):
        turns = rng.choice([1, 2, 6, 30])
        for t in range(turns):
            role = "system" if t == 0 and c % 3 else "system" if rng.random() < 0.02 else ("user", "assistant")[t % 2]
            yield (c, t, role, rng.choice(ODD) + " word" * rng.randrange(0, 60), 1, "k", 2)


def plain_digest(rows):
    """{conv_id: (turns, their hash, learned characters, their hash)} from the table's rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(x[3] for x in own if x[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in own).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment,flush", [(4096, 32), (8, 32), (8, 1)])
def test_windows_hold_each_turn_once(spark, monkeypatch, segment, flush):
    monkeypatch.setattr(chat, "SEGMENT_TURNS", segment)
    monkeypatch.setattr(chat, "FLUSH_BUDGETS", flush)
    rows = list(conversations(random.Random(5), 30))
    rows += [(None, None, None, None, 1, "k", 2), (None, 3, "assistant", "tie", 1, "k", 2), (None, 3, "assistant", "tie", 1, "k", 2), (50, -3, "assistant", "neg", 1, "k", 2), (50, 1 << 40, "user", "far", 1, "k", 2), (51, 0, "assistant", "long " * 3_000, 1, "k", 2), (51, 1, "assistant", "after", 1, "k", 2)]
    found = chat.windows(frame(spark, rows), PATH, budget=100, turns=3, most=40)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(found).collect()}
    assert got == plain_digest(rows)
    kept = found.collect()
    assert all(r["fits"] == (r["tokens"] <= 100) for r in kept)
    first = {c: min((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0)) for c in {r[0] for r in rows}}
    for r in kept:
        turns = list(chat.parsed(r["text"]))
        new = turns[r["repeated"] :]
        assert new and (r["fits"] or len(new) == 1)  # over the budget only where one turn leaves no room
        assert [(s["start"], s["end"]) for s in r["loss"]] == [t[2:] for t in new if t[0] == "assistant"]  # repeated targets are masked
        if first[r["conv_id"]][2] == "system":
            assert turns[0][:2] == ("system", first[r["conv_id"]][3])  # in every window
        assert r["repeated"] <= 3 + 1
    assert any(r["repeated"] > 1 for r in kept) and sum(not r["fits"] for r in kept) >= 1


def test_flushing_changes_nothing(spark, monkeypatch):
    rows = list(conversations(random.Random(6), 20))
    whole = [tuple(r) for r in chat.windows(frame(spark, rows), PATH, budget=80).orderBy("conv_id", "window").collect()]
    monkeypatch.setattr(chat, "FLUSH_BUDGETS", 1)
    assert whole == [tuple(r) for r in chat.windows(frame(spark, rows), PATH, budget=80).orderBy("conv_id", "window").collect()]
    assert chat.windows(frame(spark, rows).limit(0), PATH).count() == 0


def test_query_equals_a_plain_version(spark, tmp_path):
    rows = list(conversations(random.Random(7), 25))
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    probe = [(-7, 0, "user", chat.PROBE_TEXT, 0, "", 0), (-7, 1, "assistant", "\\### Assistant: </turn> ok", 0, "", 0)]
    got = chat.query(spark, str(tmp_path)).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == plain_digest(rows + probe)
    one = {r["conv_id"]: r["formatted_chars"] for r in got if r["n_windows"] == 1}
    want = {c: sum(len(chat.rendered(r[2], r[3])[0]) for r in rows + probe if r[0] == c) for c in one}
    assert one == want and -7 in one
