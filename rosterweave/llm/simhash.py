"""Near duplicates by SimHash, joined on a grid of per-segment bit counts.

A fingerprint is cut into 32 segments of two bits. The number of ones per segment embeds it in a
space where the Manhattan distance never exceeds the Hamming distance. The embedding is cut in two
halves: of two fingerprints at Hamming distance 3 or less, one half is at Manhattan distance 0 or
1. So each fingerprint is put into its own cell of either half, and into the cells one count
higher; those that meet in a cell are compared bit by bit.

Cells never hand out all their pairs: a cell yields the links of a spanning forest, so a group of
n near copies costs n links. Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow, rows_of, text_mark
from rosterweave.llm.components import components
from rosterweave.plans.staging import Stage

SHINGLE = 3
SEED = 42
DISTANCE = 3
_CHUNK = 1 << 16  # shingles whose bits are held at once
_SMALL = 24  # cells up to this size are compared shift by shift, all cells at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of the whole text: A-Z lower-cased, words split at ASCII white space.

    Null and texts without words have 0. Fewer words than a shingle: the whole sequence counts.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    width = min(shingle, len(words))
    cuts = map(slice, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    digests = map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED))
    hashes = np.fromiter(digests, np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, fp`` per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(made.view(np.int64))],
                ["doc_id", "mark", "fp"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark(), "text")
    return map_arrow(texts, run, "doc_id long, mark long, fp long")


def _cells(nodes: DataFrame) -> DataFrame:
    """``cell, own, fp``: each fingerprint in its own cells and in those one count higher."""

    def half(number: int) -> Column:
        bits = F.shiftrightunsigned("fp", 32 * number).bitwiseAND(F.lit(0xFFFFFFFF))
        # A count of 0, 1 or 2 in each two bits.
        own = bits - F.shiftright(bits, 1).bitwiseAND(F.lit(0x55555555))
        mark = F.lit(number << 33).cast("long")
        higher = [
            F.when(
                F.shiftright(own, 2 * s).bitwiseAND(F.lit(3)) < 2,
                F.struct((own + (1 << 2 * s) + mark).alias("cell"), F.lit(False).alias("own")),
            )
            for s in range(16)
        ]
        return F.array(F.struct((own + mark).alias("cell"), F.lit(True).alias("own")), *higher)

    placed = F.explode(F.concat(half(0), half(1))).alias("at")
    return nodes.select("fp", placed).where("at is not null").select("at.cell", "at.own", "fp")


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= DISTANCE


def forest(points: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all points at Hamming distance 3 or less, as a forest.

    A link between two parts has an end outside the largest part, so only points outside it are
    compared with all others: around one centre that is about one comparison per point.
    """
    part = np.arange(len(points))
    sizes = np.ones(len(points), np.int64)
    done = np.zeros(len(points), bool)
    links = []
    while True:
        largest = int(sizes.argmax())
        todo = np.flatnonzero(~done & (part != largest))
        if not len(todo):
            return links
        at = int(todo[0])
        done[at] = True
        near = np.flatnonzero(_near(points, points[at]) & (part != part[at]))
        others, first = np.unique(part[near], return_index=True)
        for other, where in zip(others.tolist(), near[first].tolist()):
            links.append((int(points[at]), int(points[where])))
            small, big = sorted((other, int(part[at])), key=lambda p: sizes[p])
            part[part == small] = big
            sizes[big] += sizes[small]
            sizes[small] = 0


def _links_of(cell: np.ndarray, own: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the points of each cell; rows come sorted by cell."""
    edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[edge, len(cell)])
    useful = (size > 1) & (np.add.reduceat(own.astype(np.int64), edge) > 0)
    keep = np.repeat(useful & (size <= _SMALL), size)
    c, o, p = cell[keep], own[keep], fp[keep]
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for d in range(1, min(_SMALL, len(c))):
        meet = (c[d:] == c[:-d]) & (o[d:] | o[:-d]) & _near(p[d:], p[:-d])
        left.append(p[:-d][meet])
        right.append(p[d:][meet])
    for i in np.flatnonzero(useful & (size > _SMALL)).tolist():
        links = forest(np.unique(fp[edge[i] : edge[i] + size[i]]))
        left.append(np.array([x[0] for x in links], np.uint64))
        right.append(np.array([x[1] for x in links], np.uint64))
    return np.concatenate(left), np.concatenate(right)


def _cell_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells are cut at batch ends, so the last cell of a batch waits for the next one."""
    held = [np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.uint64)]

    def out(parts):
        a, b = _links_of(*parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
        )

    for batch in batches:
        cell = batch["cell"].to_numpy()
        own = batch["own"].to_numpy(zero_copy_only=False).astype(bool)
        fp = batch["fp"].to_numpy().view(np.uint64)
        held = [np.concatenate(x) for x in zip(held, (cell, own, fp))]
        if held[0][0] == held[0][-1]:
            continue
        cut = int(np.searchsorted(held[0], held[0][-1]))
        yield out([x[:cut] for x in held])
        held = [x[cut:] for x in held]
    if len(held[0]):
        yield out(held)


def links(nodes: DataFrame) -> DataFrame:
    """``a, b``: links that connect all ``fp`` of ``nodes`` at Hamming distance 3 or less."""
    cells = _cells(nodes).repartition("cell").sortWithinPartitions("cell")
    return map_arrow(cells, _cell_links, "a long, b long")


def _grouped(docs: DataFrame, stage: Stage, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``doc_id, mark, fp`` per row, and ``fp, root, component_id`` per fingerprint."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp")), stage)
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints, stage(joined, "components")


def near_duplicates(docs: DataFrame, stage: Stage, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs (doc_id, text, ...)``.

    Links are transitive; a component is named by its smallest doc_id. Null text has no words and
    the fingerprint 0, which is linked like any other. A null doc_id gets its row; a component of
    such rows only is named null. Repeated rows stay repeated. No rows give no rows.
    """
    prints, named = _grouped(docs, stage, shingle)
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, stage: Stage, shingle: int = SHINGLE) -> DataFrame:
    """Rows of ``docs``, all columns: of each component the row with the smallest doc_id stays.

    A null doc_id counts as the largest; equal ids with different texts are told apart by a hash
    of the text. Repeated rows leave one.
    """
    prints, named = _grouped(docs, stage, shingle)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    first = prints.join(named, "fp").groupBy("root").agg(F.min(key).alias("kept"))
    return rows_of(docs, first.select("kept.doc_id", "kept.mark"), "left_semi", distinct=True)
