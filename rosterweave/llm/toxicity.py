"""Toxic text by compression distance.

A text is cut in windows of a few words, in two widths. Each window is compressed with two zstandard
dictionaries: one of ordinary text, and one that has toxic text besides. How many bytes the toxic
one saves is the distance of the window; how large the distances of a text are, and how many pass
thresholds, is turned into a score by a fit on labelled texts.

Widths, sizes and ``TELLING`` were chosen by two-fold cross-validation on learnable rows alone.

Words enter lower-cased with their first letters as capitals, so that the beginning of a word only
matches the beginning of a word in a dictionary.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow
from rosterweave.llm.samples import labelled_sample, remainder
from rosterweave.plans.staging import Stage

FOLDS = 3  # documents of remainder 1 are held out
CUT = 0.7
#: Rows per label to learn from at most.
SAMPLE = {0: 6_000, 1: 3_000}
#: Characters of the sampled texts at most; beyond it the sample takes no further rows.
SAMPLE_CHARS = 1 << 26
WIDTHS = (6, 30)
LEVEL = 12
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 8_192
#: So many times more often a word beginning stands in toxic texts that count as telling.
TELLING = 16
_CAPITALS = 5
_SHORTEST, _LONGEST = 4, 10  # letters of the word beginnings whose documents are counted
_SAMPLES = 40_000
THRESHOLDS = (2, 3, 4, 6)


def words(text: str | None) -> list[str]:
    return [w[:_CAPITALS].upper() + w[_CAPITALS:] for w in (text or "").lower().split()]


def windows(split: list[str], width: int) -> list[bytes]:
    return [
        " ".join(split[i : i + width]).encode("utf-8", "replace")
        for i in range(0, len(split), width)
    ]


def _beginnings(split: list[str]) -> set[str]:
    return {
        w[:n] for w in set(split) for n in range(_SHORTEST, min(len(w), _LONGEST) + 1)
    }


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on ``samples``; too few to train on are its content."""
    try:
        trained = zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        trained = b" ".join(samples)
    return trained[-size:]


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def distances(self, texts: list[str | None]) -> Iterator[list[np.ndarray]]:
        """Per text and width the bytes saved by the toxic dictionary, window by window."""
        sizes = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            data = zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(LEVEL)
            sizes.append(
                zstandard.ZstdCompressor(
                    LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
                    write_dict_id=False,
                ).compress
            )
        ordinary, toxic = sizes
        for text in texts:
            split = words(text)
            yield [
                np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(split, width)], float)
                for width in WIDTHS
            ]

    def features(self, texts: list[str | None]) -> list[list[float]]:
        return [[x for d in found for x in features(d)] for found in self.distances(texts)]


def train_dictionaries(texts: list[str], labels: list[int]) -> Dictionaries:
    """One dictionary from windows of ordinary texts, one from what sets toxic texts apart.

    Toxic texts are mostly made of ordinary words. The toxic dictionary is trained on those words
    of them whose beginnings stand in far more toxic than ordinary texts.
    """
    split = [words(t) for t in texts]
    toxic_in, ordinary_in = Counter(), Counter()
    for s, label in zip(split, labels):
        (toxic_in if label else ordinary_in).update(_beginnings(s))
    n_toxic = sum(labels)
    n_ordinary = len(labels) - n_toxic
    telling = {
        b
        for b, n in toxic_in.items()
        if n >= max(4, 0.012 * n_toxic)
        and n / max(n_toxic, 1) > TELLING * (ordinary_in[b] + 1) / max(n_ordinary, 1)
    }
    hot = [
        w
        for s, label in zip(split, labels)
        if label
        for w in s
        if any(w[:n] in telling for n in range(_SHORTEST, len(w) + 1))
    ]
    joined = [" ".join(s).encode("utf-8", "replace") for s, l in zip(split, labels) if not l]
    cut = [x[i : i + 256] for x in joined for i in range(0, len(x), 256)]
    random.Random(0).shuffle(cut)
    grouped = [" ".join(hot[i : i + 8]).encode("utf-8", "replace") for i in range(0, len(hot), 8)]
    return Dictionaries(
        _dictionary(cut[:_SAMPLES], ORDINARY_BYTES), _dictionary(grouped[:_SAMPLES], TOXIC_BYTES)
    )


def features(distances: np.ndarray) -> list[float]:
    d = np.sort(distances)[::-1] if len(distances) else np.zeros(1)
    passed = [np.log1p((d >= k).sum()) for k in THRESHOLDS]
    return [d[0], d[:3].mean(), 10 * d.clip(0).mean(), 10 * d.mean(), *passed, np.log1p(len(d))]


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    shift: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        found = self.dictionaries.features(texts)
        return self.calibrated(np.array(found, float).reshape(len(texts), -1))

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), -4.0)
        return np.c_[(x - self.middle) / self.spread, np.ones(len(x))] @ self.weights

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) + self.shift, -30, 30)))


def fit(
    dictionaries: Dictionaries, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None
) -> Model:
    """Logistic fit; the score ``CUT`` stands where the F1 measure on ``x`` is best.

    With one label only, or none, every text has the same low score. ``weight`` is how many rows
    of the whole table a row stands for; its mean does not count.
    """
    none = np.zeros(0)
    if len(np.unique(y)) < 2:
        return Model(dictionaries, none, none, none, 0.0)
    weight = np.ones(len(y)) if weight is None else weight * (len(y) / weight.sum())
    middle = np.average(x, 0, weight)
    spread = np.sqrt(np.average((x - middle) ** 2, 0, weight)) + 1e-9
    z = np.c_[(x - middle) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * (len(w) - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        w = w - np.linalg.solve(hessian, z.T @ (weight * (p - y)) + ridge @ w)
    raw = z @ w
    order = np.argsort(-raw, kind="stable")
    hits = np.cumsum((weight * y)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * y).sum())
    best = int(f1.argmax())
    cut = raw[order[best]]
    if best + 1 < len(y):
        cut = (cut + raw[order[best + 1]]) / 2
    return Model(dictionaries, middle, spread, w, float(np.log(CUT / (1 - CUT)) - cut))


def train(docs: DataFrame, labels: DataFrame, stage: Stage) -> Model:
    """Model for ``labels (doc_id, label)``, from documents that are not held out.

    The driver gets the sampled texts: ``SAMPLE`` of them at most, and of these in the order of a
    hash as many as have ``SAMPLE_CHARS`` characters together. Distances to fit on come from
    dictionaries trained on the other half of the sample, and are measured on executors.
    """
    learn = remainder("doc_id", FOLDS) != 1
    sample = labelled_sample(docs, labels, learn, SAMPLE, stage)
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    upto = F.sum(F.length(F.coalesce("text", F.lit("")))).over(order)
    halved = sample.withColumns({"half": F.row_number().over(order) % 2, "upto": upto})
    taken = stage(halved.where(F.col("upto") <= SAMPLE_CHARS).drop("upto"), "taken")
    rows = taken.orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    texts, y = rows["text"].tolist(), rows["label"].astype(int).tolist()
    if len(set(y)) < 2:
        return fit(train_dictionaries(texts, y), np.zeros((len(y), 1)), np.array(y, float))
    # What the rows of a label stand for goes to those of them that are left.
    whole = dict(sample.groupBy("label").agg(F.sum("weight")).collect())
    weights = {v: whole[v] / y.count(v) for v in set(y)}
    found = []
    for half in (0, 1):
        other = rows[rows["half"] != half]
        trained = train_dictionaries(other["text"].tolist(), other["label"].astype(int).tolist())
        own = taken.where(F.col("half") == half).select("text", F.col("label").cast("int"))
        found.append(map_arrow(own, _measuring(trained), "x array<double>, label int").toPandas())
    x = np.concatenate([np.stack(f["x"].to_list()) for f in found if len(f)])
    measured = np.concatenate([f["label"].to_numpy(float) for f in found])
    return fit(train_dictionaries(texts, y), x, measured, np.array([weights[int(v)] for v in measured]))


def _measuring(dictionaries: Dictionaries):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = dictionaries.features(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch["label"]], ["x", "label"]
            )

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` per row of ``docs (doc_id, text, ...)``.

    Whole texts are scored; null and empty ones have no windows and the score of that. Repeated
    rows stay repeated; a null id is kept. A text is held with its words and one distance per window,
    about 20 bytes a byte of it; each window is compressed by itself, so long texts cost in proportion.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")
