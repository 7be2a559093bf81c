"""SimHash groups and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rosterweave.llm import simhash, substrings
from rosterweave.llm.common import parts

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    root = {i: i for i in range(len(prints))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def near_copies(seed, n=60):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(120)) for _ in range(9)]
    texts = []
    for _ in range(n):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = rnd.choice(["x", "Yy", "É"])
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("text", [None, "", " \t", "A b", "one", "É é ÀB c d e", "a\x1cb c\x85d e f"])
def test_fingerprint_of_odd_texts(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_components_equal_brute_force(spark, stage):
    texts = near_copies(1) + ["", None, "  ", "one word", "one word", "x" * 5000]
    got = simhash.near_duplicates(frame(spark, list(enumerate(texts))), stage).collect()
    prints = [brute_fingerprint(t) for t in texts]
    want = brute_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{p:016x}", want[i]) for i, p in enumerate(prints)
    }


def test_null_ids_repeated_rows_and_other_columns(spark, stage):
    rows = [(3, "a b c d", 1), (3, "a b c d", 1), (None, "a b c d", 2), (None, "q r s t u", 3)]
    docs = frame(spark, rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(docs, stage).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 3), (3, 3), (3, 3)]


def test_one_of_each_keeps_the_smallest(spark, stage):
    rows = [(5, "a b c d", 1), (3, "a b c d", 2), (3, "a b c d", 2), (3, "q r s t", 4), (None, "q r s t", 5)]
    docs = frame(spark, rows, "doc_id long, text string, mark int")
    got = simhash.one_of_each(docs, stage)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(3, "a b c d", 2), (3, "q r s t", 4)]


def test_empty_tables(spark, stage):
    docs = frame(spark, [])
    assert simhash.near_duplicates(docs, stage).count() == 0


def test_forest_spans_the_components_of_a_full_cell():
    rnd = np.random.default_rng(0)
    centres = rnd.integers(0, 1 << 63, 5, dtype=np.uint64)
    points = np.unique(
        np.array(
            [c ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b))
             for c in centres for a in range(64) for b in range(0, 64, 7)], np.uint64,
        )
    )
    root = {int(p): int(p) for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    links = simhash.forest(points)
    for a, b in links:
        assert (a ^ b).bit_count() <= 3 and find(a) != find(b)
        root[find(a)] = find(b)
    want = brute_components([int(p) for p in points])
    assert len(links) == len(points) - len(set(want))


def brute_cut(texts, width):
    words = [WORD.findall(t or "") for t in texts]
    seen = {}
    for ws in words:
        for i in range(len(ws) - width + 1):
            key = tuple(ws[i : i + width])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for ws in words:
        gone = set()
        for i in range(len(ws) - width + 1):
            if seen[tuple(ws[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def passages(seed):
    rnd = random.Random(seed)
    shared = [" ".join(rnd.choice("abcdef") + str(rnd.randint(0, 40)) for _ in range(70)) for _ in range(3)]
    texts = []
    for _ in range(40):
        own = [rnd.choice("ghij") + str(rnd.randint(0, 400)) for _ in range(rnd.randint(0, 150))]
        if rnd.random() < 0.5:
            own.insert(rnd.randint(0, len(own)), rnd.choice(shared))
        texts.append(" ".join(own))
    return texts + texts[:3] + ["z " * 500, "p q " * 40, None, "", "é\x85f " * 34, shared[0]]


@pytest.mark.parametrize("width", [5, 35])
def test_cut_equals_brute_force(spark, stage, width):
    texts = passages(width)
    docs = frame(spark, [(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    got = substrings.without_repeats(docs.repartition(5), ["doc_id"], stage, width).collect()
    want = brute_cut(texts, width)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == dict(enumerate(want))


def test_repeated_rows_and_null_ids_are_repeats(spark, stage):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (None, text + " end"), (None, "short"), (1, "short")]
    got = substrings.without_repeats(frame(spark, rows), ["doc_id", "text"], stage).collect()
    assert sorted((r.n_words, r.n_removed, r.kept) for r in got) == [
        (1, 0, "short"), (1, 0, "short"), (40, 40, ""), (40, 40, ""), (41, 40, "end"),
    ]


def test_no_rows(spark, stage):
    assert substrings.without_repeats(frame(spark, []), ["doc_id"], stage).count() == 0


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "_mixed", lambda x: x & np.uint64(0))
    strings = [b"a b c", b"d a b", b"a b x"]
    flags = substrings.repeated_windows(strings, np.ones(3), 2)
    assert [f.tolist() for f in flags] == [[True, False], [False, True], [True, False]]


def test_digest_is_that_of_the_kept_words(spark, stage):
    row = substrings.without_repeats(frame(spark, [(1, "a  b\nc")]), ["doc_id"], stage).first()
    assert hashlib.sha256(row.kept.encode()).hexdigest() == hashlib.sha256(b"a b c").hexdigest()


def test_what_a_task_holds_is_handed_over_in_bounded_batches():
    n = substrings._SENT * 2 + 5
    runs = [{"bucket": i, "begin": i, "end": i + 2} for i in range(n)]
    batch = pa.RecordBatch.from_pydict(
        {
            "text": [" ".join(map(str, range(n + 2))), "7 8"],
            "runs": [runs, [{"bucket": 7, "begin": 0, "end": 2}]],
            "key_id": [1, 2],
            "key_text": [1, 2],
        }
    )
    sent = list(substrings._packing([batch]))
    assert max(map(len, sent)) <= substrings._SENT
    packed = [p for b in sent for p in b["packed"].to_pylist()]
    assert packed == [f"{i} {i + 1}".encode() for i in range(n)] + [None]
    repeated = [r for b in sent for r in b["repeated"].to_pylist()]
    assert [i for i, r in enumerate(repeated) if r] == [7, n]


def test_texts_are_taken_in_slices():
    batch = pa.RecordBatch.from_pydict({"text": [str(i) for i in range(2_500)]})
    slices = list(parts([batch, batch.slice(0, 0)]))
    assert [len(s) for s in slices] == [1_000, 1_000, 500]
    assert pa.Table.from_batches(slices).to_pydict() == batch.to_pydict()
