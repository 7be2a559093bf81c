"""Text quality by gradient-boosted trees over document statistics.

Trees are grown on histograms of a bounded labelled sample and kept as arrays, which numpy walks
for a whole batch of documents at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow, parts
from rosterweave.llm.samples import labelled_sample, remainder
from rosterweave.plans.staging import Stage

FOLDS = 5  # documents of remainder 0 are held out
CUT = 0.3
#: Rows per label to learn from at most.
SAMPLE = {0: 6_000, 1: 14_000}
ROUNDS, DEPTH, BINS, RATE, SMOOTH, LEAST = 80, 3, 64, 0.15, 1.0, 5.0

_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "space": (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)),
    "beyond ascii": _BYTES >= 128,
    "stops": np.isin(_BYTES, list(b".,;:")),
    "marks": np.isin(_BYTES, list(b"!?")),
    "signs": np.isin(_BYTES, list(b"#$%&*+=<>@^_|~\\/{}[]")),
}
STATISTICS = [
    "bytes", "words", "bytes per word", *_CLASSES, "distinct words", "share of the first word",
    "distinct lines", "words per line", "repeated neighbours", "words ending in a letter",
    "compressed", "byte entropy",
]


def statistics(text: str | None, compressor: zstandard.ZstdCompressor) -> list[float]:
    """The numbers of ``STATISTICS`` for the whole text; null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line]
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = max(len(data), 1), max(len(words), 1)
    share = counts[counts > 0] / size
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        len(data) / n,
        *(counts[mask].sum() / size for mask in _CLASSES.values()),
        len(set(words)) / n,
        max(Counter(words).values(), default=0) / n,
        len(set(lines)) / max(len(lines), 1),
        len(words) / max(len(lines), 1),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        sum(w[-1] > 127 or w[-1:].isalpha() for w in words) / n,
        len(compressor.compress(data)) / size,
        float(-(share * np.log2(share)).sum()),
    ]


@dataclass(frozen=True)
class Forest:
    """Trees of one depth: inner nodes and leaves of each tree in a row of an array."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Forest:
    """Boost the log loss. With one label only, or none, the score is the smoothed share of ones.

    ``weight`` is how many rows of the whole table a row stands for; its mean does not count.
    """
    weight = np.ones(len(y)) if weight is None else weight * (len(y) / max(weight.sum(), 1e-9))
    share = ((weight * y).sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if len(np.unique(y)) < 2:
        return Forest(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)])
    total = np.full(len(y), start)
    trees = []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        slope, bend = weight * (p - y), weight * p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-9)
            chosen = np.full(width, -1)
            where = np.zeros(width, int)
            for f, bins in enumerate(binned):
                at = local * BINS + bins
                g = np.bincount(at, slope, width * BINS).reshape(width, BINS)
                h = np.bincount(at, bend, width * BINS).reshape(width, BINS)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1)[:, None], h.sum(1)[:, None]
                gain = gl**2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH)
                gain -= gt**2 / (ht + SMOOTH)
                gain[(hl < LEAST / 4) | (ht - hl < LEAST / 4)] = 0
                gain = gain[:, : len(edges[f])]
                if not gain.shape[1]:
                    continue
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                better = value > best
                best[better], chosen[better], where[better] = value[better], f, top[better]
            for i in np.flatnonzero(chosen >= 0):
                feature[first + i] = chosen[i]
                threshold[first + i] = edges[chosen[i]][where[i]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = -np.bincount(at, slope, leaves) / (np.bincount(at, bend, leaves) + SMOOTH) * RATE
        total += leaf[at]
        trees.append((feature, threshold, leaf))
    return Forest(*(np.stack(part) for part in zip(*trees)), start)


def _table(texts: list[str | None]) -> np.ndarray:
    compressor = zstandard.ZstdCompressor(level=1, write_content_size=False)
    made = [statistics(t, compressor) for t in texts]
    return np.array(made, float).reshape(len(made), len(STATISTICS))


def _measuring(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        x = _table(batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), pa.list_(pa.float64())), batch["label"], batch["weight"]],
            ["x", "label", "weight"],
        )


def train(docs: DataFrame, labels: DataFrame, stage: Stage) -> Forest:
    """Forest for ``labels (doc_id, label)``, from documents that are not held out.

    The driver gets the statistics of the sampled rows only, ``SAMPLE`` of them at most.
    """
    learn = remainder("doc_id", FOLDS) != 0
    sample = labelled_sample(docs, labels, learn, SAMPLE, stage)
    measured = map_arrow(
        sample.select("text", F.col("label").cast("int").alias("label"), "weight"),
        _measuring, "x array<double>, label int, weight double",
    ).toPandas()
    if not len(measured):
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    y, weight = (measured[c].to_numpy(float) for c in ("label", "weight"))
    return fit(np.stack(measured["x"].to_list()), y, weight)


def scored(docs: DataFrame, forest: Forest, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``score`` per row; every text, null and empty too, has one.

    Columns may have any names, ``score`` apart; only ``text`` is looked at. It travels once, also if
    it is one of the columns.
    """
    names = [f"c{i}" for i in range(len(columns))]
    own = f"c{columns.index('text')}" if "text" in columns else "own_text"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            score = forest.score(_table(batch[own].to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(score)], [*names, "score"]
            )

    given = zip([*columns, "text"], names if own in names else [*names, own])
    carried = docs.select(*[F.col(c).alias(n) for c, n in given])
    fields = carried.schema.fields[: len(names)]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in fields]
    made = map_arrow(carried, run, ", ".join([*kinds, "score double"]))
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "score")
