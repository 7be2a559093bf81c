"""Vectors as codes of small codebooks, trained exactly with norm-of-sum bounds.

A vector is cut into equal parts, and every part is replaced by the number of the nearest entry of
the codebook for its position. Codebooks are the result of a fixed number of rounds of assignment
and averaging over all vectors. Everything is in integers, so results do not depend on the order
of rows or on rounding.

Most distances are never computed. Entries of a codebook form groups; a part of a vector keeps, for
each group, a lower bound of its distance to every entry there but its own, and the round in which
that bound was taken (its stamp). All earlier codebooks are kept. In a later round an entry has
moved by the net displacement between the stamped codebook and the present one (the norm of the
sum of its moves, never more than the sum of their norms), so the bound falls by the greatest net
displacement of its group. Groups whose bound stays above the distance to the present entry are
out; the others are scanned again exactly, and get a new bound and stamp.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow
from rosterweave.plans.staging import Stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUPS = 16
_SMALL = 100_000  # labels that are broadcast at most
_EXACT = float(1 << 53)
_SLACK = 1e-12


def limit(size: int) -> int:
    """Greatest integer component of vectors of ``size``: squared distances stay below 2**63."""
    return int((2.0**62 / max(size, 1)) ** 0.5 / 2)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer arrays."""
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4.0 * float(most) ** 2 * max(x.shape[1], 1) < _EXACT:
        x, c = x.astype(float), c.astype(float)  # whole numbers that floats hold
    found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
    return found.astype(np.int64)


def grouped(entries: np.ndarray, groups: int = GROUPS) -> list[np.ndarray]:
    """Ascending numbers of the entries of each group; entries of a group lie near each other."""
    count = min(groups, len(entries))
    if not count:
        return []
    centres = entries[:: max(1, len(entries) // count)][:count].astype(float)
    for _ in range(5):
        nearest = ((entries[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        for g in set(nearest.tolist()):
            centres[g] = entries[nearest == g].mean(0)
    return [np.flatnonzero(nearest == g) for g in sorted(set(nearest.tolist()))]


@dataclass
class Codebook:
    """The entries of one part position: every round's, and the groups they form."""

    history: list[np.ndarray]
    groups: list[np.ndarray]
    group_of: np.ndarray = field(init=False)
    #: For each earlier round and each group the greatest net displacement up to now.
    moved: np.ndarray = field(init=False)

    def __post_init__(self):
        self.group_of = np.zeros(len(self.history[0]), np.int64)
        for g, members in enumerate(self.groups):
            self.group_of[members] = g
        now = self.history[-1].astype(float)
        net = [np.sqrt(((now - old) ** 2).sum(1)) for old in self.history]
        made = [[n[members].max(initial=0.0) for members in self.groups] for n in net]
        self.moved = np.array(made).reshape(len(net), len(self.groups)) * (1 + 1e-9) + 1e-9

    def assign(
        self, x: np.ndarray, code: np.ndarray | None, low: np.ndarray, stamp: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entries, squared distances to them, and how many distances were computed.

        ``low`` and ``stamp``, a column per group, are brought up to date. Without a ``code`` from
        an earlier round everything is scanned.
        """
        entries, rows = self.history[-1], np.arange(len(x))
        if code is None:
            scan = np.ones(low.shape, bool)
            best, near = np.full(len(x), len(entries)), np.full(len(x), np.iinfo(np.int64).max)
            computed = 0
        else:
            best = code.astype(np.int64)
            own = x - entries[best]
            near = (own * own).sum(1)
            kept = low * (1 - _SLACK) - self.moved[stamp, np.arange(len(self.groups))]
            scan = kept <= np.sqrt(near.astype(float))[:, None] * (1 + _SLACK)
            computed = len(x)
        start = best.copy()
        seen = []
        for g, members in enumerate(self.groups):
            at = rows[scan[:, g]]
            first, least, second = self._scan(x[at], members)
            computed += len(at) * len(members)
            seen.append((g, at, first, least, second))
            closer = (least < near[at]) | ((least == near[at]) & (first < best[at]))
            near[at[closer]], best[at[closer]] = least[closer], first[closer]
        if code is not None:
            # A part that leaves an entry needs a bound that covers it.
            left = self.group_of[start]
            gone = (best != start) & ~scan[rows, left]
            for g in set(left[gone].tolist()):
                at = rows[gone & (left == g)]
                seen.append((g, at, *self._scan(x[at], self.groups[g])))
                computed += len(at) * len(self.groups[g])
        for g, at, first, least, second in seen:
            other = np.sqrt(np.where(first == best[at], second, least.astype(float)))
            # Stored in 32 bits, towards zero: never above the true distance.
            low[at, g] = np.nextafter(other.astype(np.float32), np.float32(0))
            stamp[at, g] = len(self.history) - 1
        return best, near, computed

    def _scan(self, x: np.ndarray, members: np.ndarray):
        """Nearest member (the first of equals), its squared distance, and that of the next one."""
        found = squared_distances(x, self.history[-1][members])
        first = found.argmin(1) if len(x) else np.zeros(0, np.int64)
        at = np.arange(len(x))
        least = found[at, first]
        others = found.astype(float)
        others[at, first] = np.inf
        second = others.min(1, initial=np.inf)
        return members[first], least, second


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as bytes."""
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    made = np.frombuffer(b"".join(column.to_pylist()), kind)
    return made.reshape(len(column), width).copy()


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch["vector"].flatten().to_numpy().astype(np.int64).reshape(len(batch), width)


def _flooring(size: int):
    """Whole vectors of ``size`` as integers, filled up with zeros to equal parts."""
    width = -(-size // PARTS) * PARTS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["embedding"].flatten().to_numpy().reshape(len(batch), size)
            made = np.clip(np.floor(SCALE * flat), -limit(size), limit(size))
            full = np.zeros((len(batch), width), np.int32)
            full[:, :size] = made
            ends = np.arange(len(batch) + 1, dtype=np.int32) * width
            vector = pa.ListArray.from_arrays(ends, full.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], vector], ["vec_id", "label", "vector"]
            )

    return run


def _assigning(shared, width: int, last: bool):
    """One round over the rows; the last one returns errors instead of bounds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: list[Codebook] = shared.value
        for batch in batches:
            x = _vectors(batch, width).reshape(len(batch), PARTS, width // PARTS)
            counts = [len(b.groups) for b in books]
            ends = np.cumsum([0, *counts])
            old = "codes" in batch.schema.names
            if old:
                codes = _matrix(batch["codes"], "u1", PARTS)
                low = _matrix(batch["low"], "<f4", ends[-1])
                stamp = _matrix(batch["stamp"], "u1", ends[-1])
            else:
                codes = np.zeros((len(batch), PARTS), np.uint8)
                low = np.zeros((len(batch), ends[-1]), np.float32)
                stamp = np.zeros((len(batch), ends[-1]), np.uint8)
            error = np.zeros(len(batch), np.int64)
            for p, book in enumerate(books):
                own = slice(ends[p], ends[p + 1])
                code = codes[:, p] if old else None
                best, near, _ = book.assign(x[:, p], code, low[:, own], stamp[:, own])
                codes[:, p] = best
                error += near
            columns = {"vec_id": batch["vec_id"], "label": batch["label"], "codes": _binary(codes)}
            if last:
                columns["error"] = pa.array(error)
            else:
                columns |= {"vector": batch["vector"], "low": _binary(low), "stamp": _binary(stamp)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _summing(entries: int, width: int):
    """What a task's vectors add to every entry: ``place`` -1 counts them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width // PARTS
        total = np.zeros((PARTS, entries, size), np.int64)
        count = np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            x = _vectors(batch, width).reshape(len(batch), PARTS, size)
            codes = _matrix(batch["codes"], "u1", PARTS)
            for p in range(PARTS):
                np.add.at(total[p], codes[:, p], x[:, p])
                count[p] += np.bincount(codes[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        values = np.concatenate([count[part, entry][:, None], total[part, entry]], 1)
        n = size + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, n)), pa.array(np.repeat(entry, n)),
                pa.array(np.tile(np.arange(-1, size), len(part))), pa.array(values.ravel()),
            ],
            ["part", "entry", "place", "value"],
        )

    return run


def _averaged(state: DataFrame, old: np.ndarray, width: int) -> np.ndarray:
    """The next entries, ``[part, entry, place]``: floors of means; unused ones stay."""
    kinds = "part long, entry long, place long, value long"
    sums = map_arrow(state.select("vector", "codes"), _summing(old.shape[1], width), kinds)
    sums = sums.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    found = sums.toArrow()  # at most ENTRIES rows for each component and PARTS for the counts
    part, entry, place, value = (found[c].to_numpy() for c in ("part", "entry", "place", "value"))
    new, count = old.copy(), np.ones(old.shape[:2], np.int64)
    head = place < 0
    count[part[head], entry[head]] = value[head]
    part, entry, place, value = (c[~head] for c in (part, entry, place, value))
    new[part, entry, place] = value // count[part, entry]
    return new


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of vectors without nulls and with finite components only."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where(F.col("embedding").isNotNull()).where(~odd)


def compressed(
    vectors: DataFrame, stage: Stage, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes, error`` per vector, and the codebooks ``[part, entry, place]``.

    ``codes`` are the bytes of the numbers of the nearest entries, in part order; ``error`` is the
    squared distance to them. Components are ``floor(1024 x)``. A codebook starts as the parts of
    the vectors with the smallest ids, ascending (null ids come last, equal ids in the order of
    their vectors); with fewer vectors than entries it has as many entries as there are vectors.

    Vectors that are null or hold null or non-finite components are dropped. The first vector in
    the order of ids gives the size; vectors of another size cannot be compared with it and are
    dropped too. A size that is no multiple of ``PARTS`` is filled up with zeros. Integer components
    beyond ``limit(size)`` (2**27 for 64 of them) count as that limit. Repeated rows each count.
    No rows give no rows and empty codebooks.

    A round reads and writes the rows once: codes, bounds and stamps travel with their vector, so
    nothing is joined. Sums per entry are combined in each task before the shuffle. The driver and
    every task hold the codebooks of all rounds: ``(rounds + 1) * entries`` vectors.
    """
    kept = kept_vectors(vectors)
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    head = kept.orderBy(*order).select(F.size("embedding").alias("n")).first()
    size = head.n if head else 0
    kept = kept.where(F.size("embedding") == size)
    label = f"vec_id long, label {kept.schema['label'].dataType.simpleString()}"
    state = stage(map_arrow(kept, _flooring(size), f"{label}, vector array<int>"), "integers")
    width = -(-size // PARTS) * PARTS
    first = state.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries)
    taken = [r.vector for r in first.collect()]
    start = np.array(taken, np.int64).reshape(len(taken), PARTS, width // PARTS)
    history = [start.transpose(1, 0, 2)]
    groups = [grouped(part) for part in history[0]]
    context = vectors.sparkSession.sparkContext
    for turn in range(rounds + 1):
        books = [Codebook([h[p] for h in history], groups[p]) for p in range(PARTS)]
        last = turn == rounds
        kinds = f"{label}, codes binary" + (
            ", error long" if last else ", vector array<int>, low binary, stamp binary"
        )
        step = _assigning(context.broadcast(books), width, last)
        state = stage(map_arrow(state, step, kinds), f"round_{turn}")
        if not last:
            history.append(_averaged(state, history[-1], width))
    return state, history[-1]


def spelled(codebooks: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, with commas between."""
    return ",".join(map(str, codebooks.ravel().tolist()))


def code_table(vectors: DataFrame, stage: Stage) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per vector that ``compressed`` keeps.

    ``code`` is two hex digits per part. ``label_error`` adds the errors of equal labels, null ones
    together (at most 2**63 - 1). Errors are added up before the shuffle, and the sums are broadcast
    if there are few.
    """
    coded, codebooks = compressed(vectors, stage)
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = coded.groupBy(F.col("label").alias("label_")).agg(
        F.least(total, most).cast("long").alias("label_error")
    )
    sums = stage(sums, "label_errors")
    if sums.count() <= _SMALL:
        sums = F.broadcast(sums)
    made = coded.join(sums, F.col("label").eqNullSafe(F.col("label_")), "left")
    return made.select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(spelled(codebooks).encode()).hexdigest()).alias("codebooks_sha256"),
    )
