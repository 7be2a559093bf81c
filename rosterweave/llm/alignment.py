"""Alignment of the tokens of two tokenizers over the same text, in lockstep.

Tokens of both sides are byte ranges of one text. Two of them are linked if their ranges overlap,
and an offset where tokens of both sides end cuts the text into groups. Both fall out of one merge
of the two lists of ends: emit the pair in hand, step on the side that ends first, or on both, and
cut, if they end together.

The merge of a whole batch of documents runs at once. A state vector holds a pair of pointers for
each lane; a lane is a document or, for a long one, a stretch of its A tokens. All pointers advance
in each step, every step emits one link per lane, and finished lanes are compacted away. No step
looks at a single document, and a long text costs no more steps than a short one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.llm import token_files
from rosterweave.llm.bpe import byte_names
from rosterweave.llm.common import kept, map_arrow
from rosterweave.plans.staging import Stage

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
LANE = 512  # A tokens of a lane; longer texts are several lanes
TOGETHER = 1 << 20  # characters aligned in one go, unless a single text is longer
FREQUENT = 500_000  # pairs of ids that are looked up in a broadcast (17 bytes each)
_ID_BITS = 16  # ids of both vocabularies are below 2**16


class Sides:
    """Both tokenizers with the bytes and the printed form of every token."""

    def __init__(self, path_a: str, path_b: str):
        self.library = token_files.Library(path_a, special_as_text=True)
        self.a = self.library.tokenizer
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_names()
        self.bytes_a = [
            bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()
            for t in (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        ]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
            else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _ID_BITS:
            raise ValueError("a vocabulary has too many ids")
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # The token with what stands behind it: another of its side, or the next side.
        self.shown = [
            *(f"{i}," for i in range(len(self.bytes_a))), *(f"{i}|" for i in range(len(self.bytes_a))),
            *(f"{i}," for i in range(len(self.bytes_b))), *(f"{i};" for i in range(len(self.bytes_b))),
        ]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where the tokens of a side do not spell space + text."""
        given = [t for t in texts if t]
        made_a = self.library.encode([f" {t}" for t in given])
        made_b = self.b.encode(given, num_threads=1) if given else []
        sides, none = iter(zip(given, made_a, made_b)), np.zeros(0, np.int64)
        out = []
        for text in texts:
            if not text:
                out.append((none, none))
                continue
            _, a, b = next(sides)
            spelled = f" {text}".encode()
            same = (
                b"".join(map(self.bytes_a.__getitem__, a.tolist())) == spelled
                and b"".join(map(self.bytes_b.__getitem__, b)) == spelled
            )
            out.append((a.astype(np.int64), np.array(b, np.int64)) if same else (none, none))
        return out


@kept
def sides_of(vocabulary_a: str, vocabulary_b: str) -> Sides:
    return Sides(public_tokenizers.path(vocabulary_a), public_tokenizers.path(vocabulary_b))


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of linked tokens and of the tokens before a cut: ``link_a, link_b, cut_a, cut_b``.

    ``ends`` are ascending byte offsets of all tokens; no token is empty. A lane runs over the A
    tokens from ``starts`` up to ``stops``; it begins at the B token that covers its first byte.
    """
    first = np.where(starts > 0, ends_a[starts - 1], 0) if len(starts) else starts
    at_a, at_b, stop = starts.copy(), np.searchsorted(ends_b, first, "right"), stops
    links, cuts = [], []
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        links.append((at_a, at_b))
        both = end_a == end_b
        cuts.append((at_a[both], at_b[both]))
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        going = at_a < stop
        if not going.all():
            at_a, at_b, stop = at_a[going], at_b[going], stop[going]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(x[i] for x in found)]) for found in (links, cuts) for i in (0, 1))


@dataclass
class Aligned:
    """A batch of texts: flat tokens of both sides, where each text's begin, links and cuts."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray

    def text_of(self, tokens_a: np.ndarray) -> np.ndarray:
        """The text that holds each A token."""
        return np.searchsorted(self.first_a, tokens_a, "right") - 1


def align(sides: Sides, texts: list[str | None]) -> Aligned:
    """Texts follow each other in one space of offsets, so every end of a text is a cut."""
    made = sides.encode(texts)
    first_a = np.cumsum([0, *(len(a) for a, _ in made)])
    first_b = np.cumsum([0, *(len(b) for _, b in made)])
    none = np.zeros(0, np.int64)
    ids_a, ids_b = (np.concatenate([none, *(ids[side] for ids in made)]) for side in (0, 1))
    lanes = [np.arange(i, j, LANE) for i, j in zip(first_a, first_a[1:])]
    starts = np.concatenate([np.zeros(0, np.int64), *lanes])
    stops = np.minimum(starts + LANE, first_a[np.searchsorted(first_a, starts, "right")])
    ends_a, ends_b = np.cumsum(sides.size_a[ids_a]), np.cumsum(sides.size_b[ids_b])
    return Aligned(ids_a, ids_b, first_a, first_b, *lockstep(ends_a, ends_b, starts, stops))


def spelled_groups(sides: Sides, found: Aligned) -> list[str]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    n_a, n_b = len(found.ids_a), len(found.ids_b)
    last_a, last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    last_a[found.cut_a], last_b[found.cut_b] = 1, 1
    # Tokens of A in a group come behind those of B in the groups before, and the reverse.
    ends = np.sort(found.cut_a), np.sort(found.cut_b)
    b_until = np.concatenate([[0], ends[1] + 1])
    a_until = np.concatenate([ends[0] + 1, [n_a]])
    place_a = np.arange(n_a) + b_until[np.cumsum(last_a) - last_a]
    place_b = np.arange(n_b) + a_until[np.cumsum(last_b) - last_b]
    shown = np.empty(n_a + n_b, np.int64)
    vocabulary_a, vocabulary_b = len(sides.bytes_a), len(sides.bytes_b)
    shown[place_a] = found.ids_a + vocabulary_a * last_a
    shown[place_b] = found.ids_b + 2 * vocabulary_a + vocabulary_b * last_b
    parts = list(map(sides.shown.__getitem__, shown.tolist()))
    cut = (found.first_a + found.first_b).tolist()
    return ["".join(parts[i:j])[:-1] for i, j in zip(cut, cut[1:])]


def _together(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    """Rows of a batch in runs of up to ``TOGETHER`` characters, with the place of the first."""
    texts, first, size = batch["text"].to_pylist(), 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > TOGETHER:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text or "")
    if first < len(texts):
        yield first, texts[first:]


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(ends.astype(np.int32), values.astype(np.int32))


def _aligning(vocabularies: tuple[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(*vocabularies)
        for batch in batches:
            for first, texts in _together(batch):
                found = align(sides, texts)
                owner = found.text_of(found.link_a)
                order = np.lexsort((found.link_b, found.link_a))
                base_a, base_b = found.first_a[owner[order]], found.first_b[owner[order]]
                links = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                cut = np.argsort(found.cut_a)
                holder = found.text_of(found.cut_a[cut])
                cuts = np.searchsorted(holder, np.arange(len(texts) + 1))
                own = batch.slice(first, len(texts))
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own[n] for n in names),
                        _lists(found.ids_a, found.first_a), _lists(found.ids_b, found.first_b),
                        _lists(found.link_a[order] - base_a, links),
                        _lists(found.link_b[order] - base_b, links),
                        _lists(found.cut_a[cut] + 1 - found.first_a[holder], cuts),
                        _lists(found.cut_b[cut] + 1 - found.first_b[holder], cuts),
                    ],
                    [*names, *_OUTPUTS],
                )

    return run


_OUTPUTS = ["a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b"]


def aligned(
    docs: DataFrame, columns: list[str], vocabularies: tuple[str, str] = (VOCABULARY_A, VOCABULARY_B)
) -> DataFrame:
    """``columns`` of ``docs``, then per row ``a_ids, b_ids, link_a, link_b, cut_a, cut_b``.

    Tokens are those of space + text, special strings as plain text. A link is a pair of places in
    the two lists of ids, from 0; ``cut_a, cut_b`` are the numbers of tokens of both sides before
    each cut, so the last pair is their lengths. Null and empty texts, and those whose tokens on a
    side do not spell space + text, give empty lists. ``columns`` may have the names of the outputs.
    """
    carried = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in carried.schema.fields[:-1]]
    kinds += [f"{c} array<int>" for c in _OUTPUTS]
    made = map_arrow(carried, _aligning(vocabularies), ", ".join(kinds))
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], *_OUTPUTS)


def _digesting(vocabularies: tuple[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(*vocabularies)
        for batch in batches:
            for first, texts in _together(batch):
                found = align(sides, texts)
                n, owner = len(texts), found.text_of(found.link_a)
                groups = np.bincount(found.text_of(found.cut_a), minlength=n)
                pair = found.ids_a[found.link_a] << _ID_BITS | found.ids_b[found.link_b]
                keys, times = np.unique(owner << 2 * _ID_BITS | pair, return_counts=True)
                ends = np.searchsorted(keys >> 2 * _ID_BITS, np.arange(n + 1)).astype(np.int32)
                spelled = spelled_groups(sides, found)
                hashed = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled]
                own = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        own["row"], own["doc_id"], pa.array(np.diff(found.first_a)),
                        pa.array(np.diff(found.first_b)), pa.array(groups),
                        pa.array(np.bincount(owner, minlength=n)), pa.array(hashed, pa.string()),
                        pa.ListArray.from_arrays(ends, keys & (1 << 2 * _ID_BITS) - 1),
                        pa.ListArray.from_arrays(ends, times.astype(np.int32)),
                    ],
                    _DIGEST,
                )

    return run


_DIGEST = [
    "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times",
]
_DIGEST_KINDS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>"
)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, how often each occurs, and the row that holds it."""
    pairs, times = batch["pairs"], batch["times"]
    owner = np.repeat(np.arange(len(batch)), np.diff(pairs.offsets.to_numpy()))
    return pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64), owner


def _counting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs, times, _ = _flat(batch)
        pairs, at = np.unique(pairs, return_inverse=True)
        count = np.bincount(at, times, len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(count)], ["pair", "count"])


def pair_counts(digests: DataFrame) -> DataFrame:
    """``pair, count, best`` over the whole corpus; ``best``: no pair with its B id has more.

    Counts are summed per batch before the shuffle. A B id has at most one row per A id here, and
    the highest is found by an aggregate, so no id gathers its rows.
    """
    counts = map_arrow(digests.select("pairs", "times"), _counting, "pair long, count long")
    counts = counts.groupBy("pair").agg(F.sum("count").alias("count"))
    b_id = (F.col("pair") % (1 << _ID_BITS)).alias("b_id")
    counts = counts.select("pair", "count", b_id)
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    # One row per id of the vocabulary: below 2**16.
    joined = counts.join(F.broadcast(highest), "b_id")
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _looking_up(frequent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = frequent.value
        for batch in batches:
            pairs, times, owner = _flat(batch)
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            at, mine = at[found], owner[found]
            n = len(batch)
            # Added as integers: weights of bincount would be floats.
            totals = np.zeros(n, np.int64)
            np.add.at(totals, mine, count[at] * times[found])
            links = np.zeros(n, np.int64)
            np.add.at(links, mine, best[at] * times[found])
            rest = ~found
            ends = np.searchsorted(owner[rest], np.arange(n + 1)).astype(np.int32)
            names = _DIGEST[:-2]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in names), pa.array(links), pa.array(totals),
                    pa.ListArray.from_arrays(ends, pairs[rest]),
                    pa.ListArray.from_arrays(ends, times[rest].astype(np.int32)),
                ],
                [*names, "n_best", "count_sum", "pairs", "times"],
            )

    return run


def link_counts(
    docs: DataFrame,
    stage: Stage,
    vocabularies: tuple[str, str] = (VOCABULARY_A, VOCABULARY_B),
    frequent: int = FREQUENT,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` per row of ``docs``.

    A pair of ids counts how many links hold it in all texts; ``count_sum`` adds the counts up over
    the links of a text, ``n_best`` counts links whose pair has the highest count among the pairs
    with its B id, ties included. Repeated rows count as often as they stand. Rows without tokens
    (see ``aligned``) have zeros and an empty hash. A text is held whole with its tokens and links,
    about 100 bytes a byte of it, in one task at a time.

    Texts are read once. The ``frequent`` most frequent pairs are looked up where the documents
    are; only the others, which are rare by definition, are joined with their counts, so no frequent
    pair is a hot key and no bound on vocabularies is needed.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    digests = stage(map_arrow(texts, _digesting(vocabularies), _DIGEST_KINDS), "digests")
    counts = stage(pair_counts(digests), "counts")
    top = counts.orderBy(F.desc("count"), "pair").limit(frequent).toArrow().sort_by("pair")
    known = tuple(top[c].to_numpy() for c in ("pair", "count", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kinds = _DIGEST_KINDS.replace(" pairs", " n_best long, count_sum long, pairs")
    looked = map_arrow(digests, _looking_up(shared), kinds)
    if top.num_rows < frequent:
        return looked.drop("row", "pairs", "times")
    looked = stage(looked, "looked_up")
    rest = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rest = rest.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    more = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("count") * F.col("times")).alias("more_sum"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    new = {
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }
    return looked.drop("pairs", "times").join(more, "row", "left").withColumns(new).drop(
        "row", "more_best", "more_sum"
    )
