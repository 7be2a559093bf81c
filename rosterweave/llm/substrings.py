"""Passages that occur more than once, found by super-k-mers.

A window is ``width`` consecutive words. Its minimiser is the least hash of the word triples in it.
Consecutive windows with one minimiser travel as one packed string, a super-k-mer, to the bucket of
that minimiser, so equal windows meet in one bucket and each word travels about three times instead
of ``width`` times. In a bucket the windows are sorted, and equal ones counted exactly.

Only super-k-mers travel whose minimiser stands elsewhere too, which a count of the minimisers
tells. A string that a task meets twice is settled in that task and travels once, so a passage with very
many copies reaches its bucket at most once per task.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow, parts
from rosterweave.plans.staging import Stage

WIDTH = 35
GRAM = 3
_RUN = 256  # windows in a super-k-mer at most, so that strings stay short
_HELD = 32 << 20  # bytes of strings that a task keeps to find repeats before they travel
_WORDS = 1 << 17  # hashes of words that a task keeps
_TOGETHER = 10_000  # strings whose windows are sorted together
_SENT = 10_000  # rows that a task hands over at once
_KEY = ["key_id", "key_text"]
_TRAVEL = "bucket long, packed binary, key_id long, key_text long, begin int, end int, repeated boolean"
_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
_NAMES = [part.split()[0] for part in _TRAVEL.split(", ")]
_MINIMISER = "bucket long, key_id long, key_text long, begin int, end int, times long"
_MINIMISER_NAMES = [part.split()[0] for part in _MINIMISER.split(", ")]
_RANGE = "key_id long, key_text long, begin int, end int"
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD], np.uint64
)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, from minima of runs of doubling length."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def super_kmers(words: list[bytes], width: int, hashes: dict) -> tuple[np.ndarray, ...]:
    """``minimiser, begin, end, times`` of each run of windows with one minimiser.

    ``times`` is how often the minimiser stands in the words of the run.
    """
    gram = min(GRAM, width)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    grams = h[: len(h) - gram + 1] * _ODD[0]
    for j in range(1, gram):
        grams = grams * _ODD[1] + h[j : len(h) - gram + 1 + j] * _ODD[j % 3]
    grams = _mixed(grams)
    least = _sliding_min(grams, width - gram + 1)
    new = np.r_[True, least[1:] != least[:-1]]
    begin = np.flatnonzero(new)
    last = np.r_[begin[1:], len(least)]
    if len(least) > _RUN and (last - begin).max() > _RUN:
        since = np.arange(len(least)) - np.repeat(begin, last - begin)
        begin = np.flatnonzero(since % _RUN == 0)
        last = np.r_[begin[1:], len(least)]
    # Grams equal to the minimiser: none in the run is less, so a count of minima will do.
    span = last - begin + width - gram
    owner = np.repeat(np.arange(len(begin)), span)
    spot = np.arange(len(owner)) - np.repeat(np.cumsum(span) - span, span) + begin[owner]
    times = np.bincount(owner, weights=grams[spot] == least[begin][owner], minlength=len(begin))
    return least[begin], begin, last + width - 1, times.astype(np.int64)


def _minimisers(width: int):
    """Per text the minimisers of its super-k-mers and where these stand."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in parts(batches):
            found, counts = [[], [], [], []], []
            for text in batch["text"].to_pylist():
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                counts.append(0)
                if len(words) >= width:
                    for kept, column in zip(found, super_kmers(words, width, hashes)):
                        kept.append(column)
                    counts[-1] = len(found[0][-1])
            if not found[0]:
                continue
            mins, begin, end, times = map(np.concatenate, found)
            keys = [np.repeat(batch[k].to_numpy(), counts) for k in _KEY]
            columns = [mins.view(np.int64), *keys, begin.astype(np.int32), end.astype(np.int32), times]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _MINIMISER_NAMES)

    return run


def _packing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their runs to packed strings.

    A string met again in the task is an answer: it travels as a row without a string.
    """
    held, size, answers = {}, 0, []

    def flush():
        strings = ((b, packed, *where, again) for packed, (b, where, again) in held.items())
        rows = chain(strings, answers)
        while part := list(islice(rows, _SENT)):
            arrays = [pa.array(c, t) for c, t in zip(zip(*part), _TYPES)]
            yield pa.RecordBatch.from_arrays(arrays, _NAMES)

    for batch in parts(batches):
        columns = (batch[c].to_pylist() for c in ("text", "runs", *_KEY))
        for text, runs, key_id, key_text in zip(*columns):
            words = text.encode("utf-8", "surrogatepass").split()
            for run in runs:
                a, b = run["begin"], run["end"]
                packed = b" ".join(words[a:b])
                first = held.get(packed)
                if first is None:
                    held[packed] = [run["bucket"], (key_id, key_text, a, b), False]
                    size += len(packed) + 300
                else:
                    first[2] = True
                    # Copies have one text: their answers are dealt by id and place.
                    spread = (key_id * 1_000_003 + a) % (1 << 62)
                    answers.append((spread, None, key_id, key_text, a, b, True))
                    size += 300
            if size > _HELD:
                yield from flush()
                held, size, answers = {}, 0, []
    yield from flush()


def repeated_windows(strings: list[bytes], weights: np.ndarray, width: int) -> list[np.ndarray]:
    """Per string, whether each of its windows occurs twice or more in all the strings.

    Windows are sorted by a hash; those next to one another with one hash are compared word by
    word, so a hash that two windows share by chance decides nothing.
    """
    ids, spelt = _Ids(), array("q")
    lengths = np.empty(len(strings), np.int64)
    for i, string in enumerate(strings):  # the words of one string at a time
        before = len(spelt)
        spelt.extend(map(ids.__getitem__, string.split()))
        lengths[i] = len(spelt) - before
    words = np.frombuffer(spelt, np.int64)
    ends = np.cumsum(lengths)
    counts = lengths - width + 1
    # A window's hash is a difference of prefix sums of word hash times power of an odd number.
    odd = int(_ODD[1])
    n = len(words)
    power = np.full(n + 1, _ODD[1], np.uint64)
    inverse = np.full(n + 1, pow(odd, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_mixed((words.astype(np.uint64) + np.uint64(1)) * _ODD[0]) * power[:n], out=sums[1:])
    owner = np.repeat(np.arange(len(strings)), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at += np.repeat(ends - lengths, counts)
    hashed = (sums[at + width] - sums[at]) * inverse[at]
    order = np.argsort(hashed, kind="stable")
    sorted_hash, sorted_at = hashed[order], at[order]
    same = sorted_hash[1:] == sorted_hash[:-1]
    pairs = np.flatnonzero(same)
    equal = np.ones(len(pairs), bool)
    for j in range(width):
        equal &= words[sorted_at[pairs] + j] == words[sorted_at[pairs + 1] + j]
    group = np.cumsum(np.r_[True, ~same]) - 1
    total = np.bincount(group, weights=weights[owner[order]])
    repeated = np.empty(len(owner), bool)
    repeated[order] = total[group] > 1
    if not equal.all():  # windows that share a hash by chance are counted by their words
        for g in np.unique(group[pairs[~equal]]).tolist():
            members = order[group == g]
            spelled = [words[at[m] : at[m] + width].tobytes() for m in members.tolist()]
            seen: dict[bytes, int] = {}
            for m, w in zip(members.tolist(), spelled):
                seen[w] = seen.get(w, 0) + int(weights[owner[m]])
            repeated[members] = [seen[w] > 1 for w in spelled]
    return np.split(repeated, np.cumsum(counts)[:-1])


def _ranges(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Word ranges that the flagged windows cover, first word and end."""
    hit = np.flatnonzero(flags)
    if not len(hit):
        return []
    gap = np.flatnonzero(np.diff(hit) > width)
    firsts, lasts = hit[np.r_[0, gap + 1]], hit[np.r_[gap, len(hit) - 1]]
    return list(zip(firsts.tolist(), (lasts + width).tolist()))


def _counting(width: int):
    """Buckets, sorted, to ranges of repeated words; a bucket is never cut."""

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = {name: [] for name in _NAMES}
        for batch in held:
            for name in _NAMES[1:]:
                columns[name] += batch[name].to_pylist()
        rows = list(zip(*(columns[name] for name in _NAMES[1:])))
        out = [(r[1], r[2], r[3], r[4]) for r in rows if r[0] is None]
        rows = [r for r in rows if r[0] is not None]
        ids: dict[bytes, int] = {}
        which = [ids.setdefault(r[0], len(ids)) for r in rows]
        if ids:
            weights = np.bincount(which, weights=[1 + r[5] for r in rows])
            flags = repeated_windows(list(ids), weights, width)
            covered = [_ranges(f, width) for f in flags]
            for i, (_, key_id, key_text, begin, *_) in zip(which, rows):
                out += [(key_id, key_text, begin + a, begin + b) for a, b in covered[i]]
        if out:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), _TYPES[2:6])]
            yield pa.RecordBatch.from_arrays(arrays, _NAMES[2:6])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch["bucket"].to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1]))
            if cut or (held and held[-1]["bucket"][-1].as_py() != bucket[0]):
                held.append(batch.slice(0, cut))
                if sum(map(len, held)) >= _TOGETHER:
                    yield from settle(held)
                    held = []
                held = [x for x in held if len(x)]
            held.append(batch.slice(cut))
        yield from settle(held)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with equal doc_id and text share a key: whatever is removed from one is from all."""
    return docs.withColumns(
        {
            _KEY[0]: F.coalesce("doc_id", F.lit(0)).cast("long"),
            _KEY[1]: F.xxhash64(F.col("doc_id").isNull(), "text"),
        }
    )


def repeated_ranges(keyed: DataFrame, stage: Stage, width: int = WIDTH) -> DataFrame:
    """``key_id, key_text, ranges``: word ranges inside repeated windows, for texts that have any."""
    found = map_arrow(keyed.select("text", *_KEY), _minimisers(width), _MINIMISER)
    found = stage(found, "minimisers")
    # Equal windows have equal minimisers: one that stands once in all texts needs no bucket.
    met = found.groupBy("bucket").agg(F.sum("times").alias("n")).where("n > 1").select("bucket")
    runs = found.join(met, "bucket").select("bucket", *_KEY, "begin", "end")
    runs = runs.groupBy(*_KEY).agg(F.collect_set(F.struct("bucket", "begin", "end")).alias("runs"))
    # All columns stay, so that the join with the ranges can reuse this shuffle of the texts.
    suspects = keyed.join(runs, _KEY)
    packed = map_arrow(suspects, _packing, _TRAVEL)
    sorted_buckets = packed.repartition("bucket").sortWithinPartitions("bucket")
    ranges = map_arrow(sorted_buckets, _counting(width), _RANGE)
    return ranges.groupBy(*_KEY).agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))


def _cutting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        words_of, removed, kept = [], [], []
        for text, ranges in zip(batch["text"].to_pylist(), batch["ranges"].to_pylist()):
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            words_of.append(len(words))
            if ranges:
                gone = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    gone[r["begin"]] += 1
                    gone[r["end"]] -= 1
                stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                words = [words[i] for i in stay]
            removed.append(words_of[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in batch.schema.names if c != "ranges"),
                pa.array(words_of, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept),
            ],
            [*(c for c in batch.schema.names if c != "ranges"), "n_words", "n_removed", "kept"],
        )


def without_repeats(
    docs: DataFrame, columns: list[str], stage: Stage, width: int = WIDTH
) -> DataFrame:
    """``columns`` of ``docs`` with ``n_words, n_removed, kept`` per row.

    Words are separated by ASCII white space. Each word goes that lies in a window of ``width``
    words whose words also stand in this order anywhere else, in the same text included; ``kept``
    joins the others with one space. Null and empty texts have no words; texts shorter than a
    window keep all. Repeated rows are repeats of each other. Columns may have any names: only
    ``doc_id`` and ``text`` are looked at, and ``columns`` are what comes back.
    """
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    keyed = _keyed(docs.select(*carried, "doc_id", "text")).drop("doc_id")
    joined = keyed.join(repeated_ranges(keyed, stage, width), _KEY, "left").drop(*_KEY)
    kinds = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in joined.drop("ranges").schema.fields
    )
    cut = map_arrow(joined, _cutting, f"{kinds}, n_words long, n_removed long, kept string")
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    return cut.select(*back, "n_words", "n_removed", "kept")
