"""Alignment of two tokenizers against sets of overlapping byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rosterweave.llm import alignment

SCHEMA = "doc_id long, text string"
ODD = [
    None, "", " ", "  ", "a", "a  b", "\n\n a \t", "it's <s> a </s><|endoftext|> b", "日本語テキスト 👩‍👩‍👧 é é",
    "▁x", "a▁", "\x00b", "ﬁ ① Ⅷ", "x" * 3000, " " * 700 + "y", "internationalization of tokenizers!",
    "﻿ bom", "­​", "9" * 999,
]


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out, b"".join(d for _, d in tokens)


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def brute(tokenizers, text):
    """A spans, B spans, links, groups; slow, from the definitions alone."""
    from tokenizers import decoders  # noqa: F401  (byte-level alphabet below is rebuilt by hand)

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown}
    of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    none = [], [], [], []
    if not text:
        return none
    a, b = tokenizers
    made_a = a.encode(" " + text, add_special_tokens=False)
    ta = [(i, bytes(of[c] for c in t)) for i, t in zip(made_a.ids, made_a.tokens)]
    tb = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        tb.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    (sa, whole_a), (sb, whole_b) = spans(ta), spans(tb)
    if not whole_a == whole_b == (" " + text).encode():
        return none
    links = [(x, y) for x, (_, s, e) in enumerate(sa) for y, (_, t, f) in enumerate(sb) if s < f and t < e]
    cuts = sorted({e for *_, e in sa} & {f for *_, f in sb})
    groups, low = [], 0
    for c in cuts:
        groups.append(([i for i, s, _ in sa if low <= s < c], [i for i, s, _ in sb if low <= s < c]))
        low = c
    return sa, sb, links, groups


def spelled(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def expected(tokenizers, rows):
    made = [(doc_id, *brute(tokenizers, text)) for doc_id, text in rows]
    count = Counter((sa[x][0], sb[y][0]) for _, sa, sb, links, _ in made for x, y in links)
    high = {}
    for (_, b), n in count.items():
        high[b] = max(high.get(b, 0), n)
    out = []
    for doc_id, sa, sb, links, groups in made:
        pairs = [(sa[x][0], sb[y][0]) for x, y in links]
        text = spelled(groups)
        out.append((
            str(doc_id), len(sa), len(sb), len(groups), len(links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
            sum(count[p] == high[p[1]] for p in pairs), sum(count[p] for p in pairs),
        ))
    return sorted(out)


def made_texts(n=60, seed=3):
    rnd = random.Random(seed)
    words = ["the", "encyclopaedia", "naïve", "x9y", "  ", "Straße", "日本", "it's", "don’t", "\n", "12,345.6", "_a_b_"]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))) for _ in range(n)]


def test_digests_equal_brute_force(spark, stage, tokenizers):
    rows = list(enumerate(ODD + made_texts()))
    rows += [(None, "the naïve"), (None, "the naïve"), (7, "the"), (7, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "pairs": F.lit("x")})
    want = expected(tokenizers, rows)
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    for frequent in (10**6, 1, 40):  # all pairs in the broadcast, or most of them by the join
        part = type(stage)(spark, stage.folder)
        got = alignment.link_counts(docs.repartition(3), part, frequent=frequent).select(*order).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_links_and_cuts_are_returned(spark, tokenizers):
    rows = list(enumerate(ODD + made_texts(20, 5)))
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("link_a", F.col("doc_id") * 2)
    for r in alignment.aligned(docs, ["doc_id", "link_a"]).collect():
        sa, sb, links, groups = brute(tokenizers, rows[r[0]][1])
        assert r[1] == 2 * r[0]
        assert (r[2], r[3]) == ([x[0] for x in sa], [x[0] for x in sb])
        assert list(zip(r[4], r[5])) == links
        sizes = [(len(x), len(y)) for x, y in groups]
        assert list(zip(r[6], r[7])) == [tuple(map(sum, zip(*sizes[: i + 1]))) for i in range(len(sizes))]


def test_long_texts_are_cut_into_lanes(tokenizers):
    sides = alignment.sides_of(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    text = " ".join(made_texts(400, 8))
    found = alignment.align(sides, ["short", text, None, text])
    whole = alignment.lockstep(
        np.cumsum(sides.size_a[found.ids_a]), np.cumsum(sides.size_b[found.ids_b]),
        np.array([0]), np.array([len(found.ids_a)]),
    )
    assert len(found.ids_a) > 20 * alignment.LANE
    assert set(zip(whole[0], whole[1])) == set(zip(found.link_a, found.link_b))
    assert len(whole[0]) == len(found.link_a)
    assert sorted(zip(whole[2], whole[3])) == sorted(zip(found.cut_a, found.cut_b))
    groups = alignment.spelled_groups(sides, found)
    assert groups[1] == groups[3] and groups[2] == ""


def test_lanes_merge_in_lockstep(monkeypatch):
    """Steps are those of the longest lane, not the sum over texts."""
    rnd = np.random.default_rng(1)
    starts, stops, ends_a, ends_b, base = [], [], [], [], 0
    for _ in range(300):
        size = int(rnd.integers(1, 60))
        for ends in (ends_a, ends_b):
            inner = np.unique(rnd.integers(1, size + 1, size // 2))
            ends.append(base + np.union1d(inner, [size]))
        starts.append(sum(map(len, ends_a[:-1])))
        stops.append(sum(map(len, ends_a)))
        base += size
    steps = []
    real = np.concatenate
    monkeypatch.setattr(np, "concatenate", lambda x: steps.append(len(x)) or real(x))
    link_a, link_b, cut_a, cut_b = alignment.lockstep(
        real(ends_a), real(ends_b), np.array(starts), np.array(stops)
    )
    assert len(link_a) == len(real(ends_a)) + len(real(ends_b)) - len(cut_a)
    assert max(steps) - 1 <= max(len(a) + len(b) for a, b in zip(ends_a, ends_b))


def test_no_rows(spark, stage):
    docs = spark.createDataFrame([], SCHEMA)
    assert alignment.link_counts(docs, stage).collect() == []
    assert alignment.aligned(docs, ["doc_id"]).collect() == []
