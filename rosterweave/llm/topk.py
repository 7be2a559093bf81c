"""Exact highest inner products by a uniform threshold in three phases.

Components are split in ``PARTS`` blocks, so a score is a sum of partial scores, one list of them
per block. For a bounded block of queries at a time:

1. Each task keeps the best entries of each of its lists, and their full scores. The k-th best of
   those over all tasks is a score that the k-th answer cannot be below: the cutoff.
2. The cutoffs are broadcast. A vector of which every partial score is below cutoff / ``PARTS``
   cannot reach the cutoff, so only vectors with an entry that is not are collected.
3. Their remaining partial scores are added, and what reaches the cutoff is ranked.

Scores are integers, so nothing depends on the order of additions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow
from rosterweave.plans.staging import Stage

K = 20
SCALE = 64
PARTS = 2
BLOCK = 4096  # queries that are broadcast together
_CHUNK = 1024  # vectors scored at once
_EXACT = float(1 << 53)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` without nulls and components that are null or not finite."""
    odd = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id is not null and embedding is not null").where(~odd)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of one length, up to ``_CHUNK`` of them."""
    column = batch["embedding"]
    ends = column.offsets.to_numpy()
    flat = np.floor(SCALE * column.values.to_numpy().astype(float))
    ids = batch["vec_id"].to_numpy()
    sizes = np.diff(ends)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for i in range(0, len(rows), _CHUNK):
            at = rows[i : i + _CHUNK]
            spots = ends[at][:, None] + np.arange(size)
            yield ids[at], flat[spots] if size else np.zeros((len(at), 0))


def _partial_scores(queries: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
    """Per block of components the scores of all queries and vectors, exact."""
    most = [float(np.abs(x).max(initial=0)) for x in (queries, vectors)]
    if most[0] * most[1] * max(queries.shape[1], 1) >= _EXACT:
        queries, vectors = queries.astype(np.int64), vectors.astype(np.int64)
    blocks = np.array_split(np.arange(queries.shape[1]), PARTS)
    return [queries[:, b] @ vectors[:, b].T for b in blocks]


class _Block:
    """Queries by vector length: their positions in the block, ids and integer vectors."""

    def __init__(self, rows: list[tuple[int, list[float]]]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.array([len(r[1]) for r in rows])
        for size in set(sizes.tolist()):
            at = np.flatnonzero(sizes == size)
            made = np.array([rows[i][1] for i in at], float).reshape(len(at), size)
            self.by_size[size] = at, np.floor(SCALE * made)

    def scores(self, ids: np.ndarray, vectors: np.ndarray):
        """Positions of the comparable queries, partial scores, and which pairs count."""
        at, made = self.by_size.get(vectors.shape[1], (np.zeros(0, int), None))
        if not len(at):
            return at, [], None
        return at, _partial_scores(made, vectors), self.ids[at][:, None] != ids[None, :]


def _gathering(block: _Block, k: int):
    """Phase 1: the full scores of the best entries of a task's lists."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(block.ids), k), -np.inf)
        for batch in batches:
            for ids, vectors in _chunks(batch):
                at, parts, counts = block.scores(ids, vectors)
                if not len(at):
                    continue
                listed = np.zeros(counts.shape, bool)
                for part in parts:
                    part = np.where(counts, part, -np.inf)
                    top = np.argpartition(part, -min(k, len(ids)), 1)[:, -min(k, len(ids)) :]
                    np.put_along_axis(listed, top, True, 1)
                total = np.where(listed & counts, sum(parts), -np.inf)
                both = np.concatenate([best[at], total], 1)
                best[at] = np.partition(both, -k, 1)[:, -k:]
        query, spot = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int64)), pa.array(best[query, spot])], ["query", "score"]
        )

    return run


def _collecting(block: _Block, cutoffs: np.ndarray, k: int):
    """Phases 2 and 3: entries above the uniform threshold, resolved; the best of each task."""

    def pruned(parts):
        query, ids, score = map(np.concatenate, zip(*parts))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = query[1:] != query[:-1]
        first = np.flatnonzero(new)
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        keep = place < k
        return query[keep], ids[keep], score[keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        size = 0
        for batch in batches:
            for ids, vectors in _chunks(batch):
                at, parts, counts = block.scores(ids, vectors)
                if not len(at):
                    continue
                cutoff = cutoffs[at][:, None]
                passed = counts & np.logical_or.reduce([p >= cutoff / PARTS for p in parts])
                query, spot = np.nonzero(passed)
                score = sum(p[query, spot] for p in parts)
                keep = score >= cutoffs[at][query]
                held.append(
                    (at[query[keep]], ids[spot[keep]], score[keep].astype(np.int64))
                )
                size += int(keep.sum())
                if size > 4 * k * len(block.ids) + _CHUNK:
                    held = [pruned(held)]
                    size = len(held[0][0])
        query, ids, score = pruned(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids[query]), pa.array(ids), pa.array(score)],
            ["query_id", "vec_id", "score"],
        )

    return run


def top_k(vectors: DataFrame, asked: Column, stage: Stage, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row where ``asked``.

    ``vectors`` has ``vec_id, embedding``. A score is the inner product of ``floor(64 x)`` of the
    components; ties go to the smaller id. Rows with a null id, a null vector or a component that
    is null or not finite take no part. Vectors are compared with those of their own length. Rows
    with one id are one query, by the least of their vectors, and never answer it; otherwise each
    row is a candidate. Beyond 64-bit integers scores wrap around.
    """
    rows = usable(vectors)
    queries = rows.where(asked).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    answers, last = None, None
    while True:
        rest = queries if last is None else queries.where(F.col("vec_id") > last)
        taken = [tuple(r) for r in rest.orderBy("vec_id").limit(BLOCK).collect()]
        if not taken and answers is not None:
            break
        block = _Block(taken)
        gathered = map_arrow(rows, _gathering(block, k), "query long, score double")
        ranked = Window.partitionBy("query").orderBy(F.desc("score"))
        kth = gathered.withColumn("place", F.row_number().over(ranked)).where(f"place = {k}")
        cutoffs = np.full(len(taken), -np.inf)
        for query, score in kth.select("query", "score").collect():
            cutoffs[query] = score
        kinds = "query_id long, vec_id long, score long"
        found = map_arrow(rows, _collecting(block, cutoffs, k), kinds)
        found = stage(found, f"block_{last}")
        answers = found if answers is None else answers.union(found)
        if len(taken) < BLOCK:
            break
        last = taken[-1][0]
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
