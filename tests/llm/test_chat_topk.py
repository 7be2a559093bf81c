"""Chat logs and exact top-k against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterweave.llm import chat, topk

ODD = ["", "a", "\\", "</s>", "\\</s>", "\\\\<s>", "<<SYS>>x", "[INST] ok [/INST]", "<<s>", "[[INST]\n", "é</s>", "\\" * 5 + "[ROLE]"]
EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


@pytest.mark.parametrize("text", ODD)
def test_escaping_is_undone_and_hides_every_control_string(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not chat._MARK.search(chat.escaped(text))


def test_rendered_turns_are_parsed_back():
    roles = ["system", "user", "assistant", "tool", "", "</s>"]
    for said in itertools.product(roles, repeat=2):
        for texts in itertools.product(ODD, repeat=2):
            turns = list(zip(said, texts))
            pieces = [chat.rendered(*t) for t in turns]
            assert chat.parsed("".join(p for p, _, _ in pieces)) == turns
            for (role, text), (piece, begin, end) in zip(turns, pieces):
                assert chat.unescaped(piece[begin:end]) == (text if role == "assistant" else "")


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "start", "user", None), (1, 0, 1, "delta", None, "he"), (1, 0, 2, "delta", None, "llo"),
        (1, 1, 0, "start", "assistant", "bad"), (1, 1, 1, "delta", None, " more"),
        (1, 1, 2, "regenerate", None, None), (1, 1, 3, "delta", None, "good"),
        (1, 2, 0, "start", "user", "x"), (1, 2, 1, "edit", None, "y"), (1, 2, 2, "delta", None, "z"),
        (1, 2, 3, "unknown", None, "w"), (2, 0, 5, "delta", None, "late"), (2, 0, 1, "start", "tool", "first "),
        (None, 0, 0, "start", None, None),
    ]
    events = spark.createDataFrame([(*r, 0) for r in rows], EVENTS + ", piece int").orderBy(F.rand(1))
    got = sorted(chat.messages(events).collect(), key=lambda r: (r.conv_id or 0, r.place))
    turns = [(r.conv_id, r.place, *chat.parsed(r.piece)[0]) for r in got]
    assert turns == [(None, 0, "", ""), (1, 0, "user", "hello"), (1, 1, "assistant", "good"),
                     (1, 2, "user", "yz"), (2, 0, "tool", "first late")]


def test_read_back_digests(spark):
    rnd = random.Random(0)
    turns = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice([*ODD, None, "é" * 3000]))
             for c in (5, 6, 7) for t in range(300 if c == 5 else 4)]
    turns += [turns[0], (8, 0, "user", "only")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.messages(chat.events_of_turns(df.repartition(4)))).collect()}
    for conv in (5, 6, 7, 8):
        own = sorted(((t, r or "", x or "") for c, t, r, x in turns if c == conv),
                     key=lambda m: (m[0], m[1], m[2].encode()))
        want = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(own), len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.rendered(role, x)[0]) for _, role, x in own)


def test_no_conversations(spark):
    assert chat.read_back(chat.messages(spark.createDataFrame([], EVENTS))).count() == 0


def brute_top(rows, k, asked):
    usable = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in usable:
        if q % asked == 0:
            found = sorted((-int(v @ w), i) for i, w in usable if i != q and len(w) == len(v))
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_top_k_equals_brute_force(spark, stage, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "_CHUNK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(90)]
    rows += [(100 + i, [0.5] * 6) for i in range(40)]
    rows += [(200, None), (205, [None] * 6), (210, [float("nan")] * 6), (215, [float("inf")] + [0.0] * 5),
             (220, [1.0, 2.0]), (221, [0.5, 0.25]), (None, [1.0] * 6), (225, []), (230, [0.0] * 6)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in topk.top_k(df.repartition(5), F.col("vec_id") % 5 == 0, stage, k=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_top(rows, 7, 5)
    assert {q: sorted(v) for q, v in got.items()} == {q: v for q, v in want.items() if v}


def test_top_k_of_nothing(spark, stage):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0, stage).count() == 0


def test_large_components_stay_exact(spark, stage):
    df = spark.createDataFrame([(0, [2.0**25, 1.0]), (1, [2.0**25, 1.0])], "vec_id long, embedding array<double>")
    row = topk.top_k(df, F.col("vec_id") == 0, stage).first()
    assert row.score == 2**62 + 64 * 64
