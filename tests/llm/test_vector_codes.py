"""Codes of vectors against training by computing every distance."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterweave.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, entries=256, rounds=4):
    """Codes, errors and final entries by their definition, in Python integers."""
    kept = [
        (i, [math.floor(1024 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(kept[0][1]) // 4
    cut = [[v[p * n : p * n + n] for p in range(4)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(4)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for c in cut:
                members[nearest(p, c[p])[1]].append(c[p])
            for e, xs in members.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [[nearest(p, c[p]) for p in range(4)] for c in cut]
    by_label = defaultdict(int)
    for (_, _, label), f in zip(kept, found):
        by_label[label] += sum(d for d, _ in f)
    spelled = ",".join(str(y) for book in books for c in book for y in c)
    digest = hashlib.sha256(spelled.encode()).hexdigest()
    return sorted(
        (str(i), "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), by_label[label], digest)
        for (i, _, label), f in zip(kept, found)
    )


def got(spark, stage, rows, **extra):
    df = spark.createDataFrame(rows, SCHEMA)
    for name, value in extra.items():
        df = df.withColumn(name, value)
    made = vector_codes.code_table(df.repartition(3), stage)
    assert made.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in made.collect())


def vectors(n, size, seed, spread=1.0):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    return [
        (i * 3 - 50, [x + rnd.gauss(0, spread) for x in rnd.choice(centres)], rnd.choice([None, 1, 2]))
        for i in range(n)
    ]


def test_codes_equal_brute_force_with_odd_rows(spark, stage):
    rows = vectors(420, 8, 1, 0.2)
    rows += [(9001, None, 1), (9002, [0.1] * 7 + [None], 1), (9003, [math.nan] * 8, 2)]
    rows += [(9004, [math.inf] + [0.0] * 7, 2), (None, [0.5] * 8, None), (None, [0.25] * 8, 2)]
    rows += [rows[5]] * 40 + [(7, [0.5] * 8, 2), (7, [-0.5] * 8, 2), (-60, [-1e-9] * 8, None)]
    assert got(spark, stage, rows, codes=F.lit(1), low=F.lit("x")) == brute(rows)


def test_fewer_vectors_than_entries_and_ties(spark, stage):
    rows = [(i, [float(i % 3)] * 4, None) for i in range(20)]
    assert got(spark, stage, rows) == brute(rows)


def test_one_vector_and_copies_of_it(spark, stage):
    rows = [(4, [0.1, -0.2, 0.3, 1e5], 3)] * 300
    assert got(spark, stage, rows) == brute(rows)


def test_other_sizes(spark, stage):
    # The first size counts; zeros fill up a size that is no multiple of four.
    rows = [(1, [0.5, 1.0, 2.0], 1), (2, [0.0, 0.0, 0.25], 1), (0, [1.0, 1.0, 1.0], 1)]
    full = [(i, [*v, 0.0], label) for i, v, label in rows]
    assert got(spark, stage, rows + [(3, [1.0], 1), (4, [], 2)]) == brute(full)
    assert got(spark, type(stage)(spark, stage.folder), [(1, [], None), (2, [], 5)]) == [
        (str(i), "00000000", 0, 0, hashlib.sha256(b"").hexdigest()) for i in (1, 2)
    ]


def test_components_beyond_the_limit_count_as_the_limit(spark, stage):
    rows = [(0, [1e300, 0.0, 0.0, -1e300], 1), (1, [0.0] * 4, 1)]
    most = vector_codes.limit(4) / 1024
    assert got(spark, stage, rows) == brute([(0, [most, 0.0, 0.0, -most], 1), (1, [0.0] * 4, 1)])


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_no_vectors(spark, stage, rows):
    assert got(spark, stage, rows) == []


def test_bounds_save_distances_and_lose_nothing():
    rnd = np.random.default_rng(3)
    x = (rnd.normal(size=(20, 6))[rnd.integers(0, 20, 3000)] * 4000 + rnd.normal(size=(3000, 6)) * 300).astype(np.int64)
    history, groups = [x[:128].copy()], vector_codes.grouped(x[:128])
    assert sorted(np.concatenate(groups).tolist()) == list(range(128))
    code, computed = None, []
    low = np.zeros((len(x), len(groups)), np.float32)
    stamp = np.zeros((len(x), len(groups)), np.uint8)
    for turn in range(12):
        book = vector_codes.Codebook(history, groups)
        code, near, n = book.assign(x, code, low, stamp)
        computed.append(n)
        exact = vector_codes.squared_distances(x, history[-1])
        assert code.tolist() == exact.argmin(1).tolist()
        assert near.tolist() == exact.min(1).tolist()
        # Each bound, brought to this round, is below all distances of its group but the own one.
        exact[np.arange(len(x)), code] = np.iinfo(np.int64).max
        for g, members in enumerate(groups):
            bound = low[:, g] - book.moved[stamp[:, g], g]
            assert (bound <= np.sqrt(exact[:, members].min(1))).all()
        new = history[-1].copy()
        for e in set(code.tolist()):
            new[e] = x[code == e].sum(0) // (code == e).sum()
        history.append(new)
    assert len(set(stamp.ravel().tolist())) > 2  # bounds of several rounds are in use
    assert computed[0] == 3000 * 128
    assert sum(computed[1:]) < 0.5 * 11 * 3000 * 128


def test_net_displacement_is_tighter_than_added_moves():
    start = np.array([[0, 0], [100, 0]])
    back = [start, start + [[30, 0], [0, 0]], start + [[2, 0], [0, 0]]]
    book = vector_codes.Codebook(back, [np.array([0, 1])])
    assert 2 <= book.moved[0, 0] < 2.001  # the sum of the moves is 58
    assert 28 <= book.moved[1, 0] < 28.001


def test_large_numbers_are_exact():
    rnd = np.random.default_rng(5)
    most = vector_codes.limit(16)
    x, c = (rnd.integers(-most, most + 1, (5, 16)) for _ in range(2))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)) for s in c] for r in x]
    assert vector_codes.squared_distances(x, c).tolist() == want
