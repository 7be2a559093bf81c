"""Token ids as ORC files in ascending document order.

ORC stores the id lists run-length encoded in stripes, each with row indexes and a Bloom filter on
``doc_id``, so readers split files by stripe and skip what a lookup cannot need.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rosterweave.llm.bpe import VOCABULARY, byte_names, pieces
from rosterweave.llm.common import map_arrow
from rosterweave.plans.staging import Stage

END = 0
_CACHED = 300_000  # pieces in a generation of those whose ids a task keeps
_MARKS = frozenset(".,;:!?")
_LINES = 4_096  # unseen pieces in one call
_TOGETHER = 256  # texts whose unseen pieces are encoded together
_STORED = "doc_id long, place long, ids array<int>"


class Library:
    """Ids as the tokenizers library gives them; pieces of texts are encoded once.

    A piece of letters is one pre-token and goes straight to the library's merge model. Other
    unseen pieces go to the tokenizer as one text, a line each; the line feeds between them are
    tokens of their own there, at which the ids are cut. Two generations of pieces are kept: when
    the younger is full, it becomes the older, and what is met again moves on.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if special_as_text else [t.content for t in added]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.names = {b: c for c, b in byte_names().items()}
        self.model = self.tokenizer.model
        (self.line_feed,) = self._ids("\n").tolist()

    def _ids(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4")

    def _learn(self, unseen: set[str]) -> None:
        again = unseen & self.older.keys()
        self.known.update((p, self.older[p]) for p in again)
        others, marked = [], []
        tokenize, blank = self.model.tokenize, self.names[32]
        for p in unseen - again:
            if not (p[1:] if p[:1] == " " else p).isalpha():
                # A mark behind a letter is a token of its own: the word without it will do.
                (marked if p[-1:] in _MARKS and p[-2:-1].isalpha() else others).append(p)
                continue
            if p.isascii():
                named = p.replace(" ", blank)
            else:
                named = p.encode("utf-8").decode("latin-1").translate(self.names)
            self.known[p] = array("I", [t.id for t in tokenize(named)]).tobytes()
        if marked:
            self._learn({q for p in marked for q in (p[:-1], p[-1])}.difference(self.known))
            self.known.update((p, self.known[p[:-1]] + self.known[p[-1]]) for p in marked)
        odd = [p for p in others if "\n" in p or p.isspace() or not p]
        self.known.update((p, self._ids(p).tobytes()) for p in odd)
        lines = sorted(set(others).difference(odd))
        for first in range(0, len(lines), _LINES):
            part = lines[first : first + _LINES]
            ids = self._ids("\n".join(part))
            cut = np.flatnonzero(ids == self.line_feed).tolist()
            assert len(cut) == len(part) - 1
            data = ids.tobytes()
            starts, ends = [0, *(4 * c + 4 for c in cut)], [*(4 * c for c in cut), len(data)]
            self.known.update(zip(part, map(data.__getitem__, map(slice, starts, ends))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Special strings act beyond their piece, so texts that hold one are encoded whole."""
        whole = [any(s in t for s in self.special) for t in texts]
        split = [[] if w else pieces(t) for t, w in zip(texts, whole)]
        if len(self.known) > _CACHED:
            self.known, self.older = {}, self.known
        self._learn(set().union(*split).difference(self.known))
        joined = [b"".join(map(self.known.__getitem__, ps)) for ps in split]
        return [
            self._ids(t) if w else np.frombuffer(j, "<u4") for t, w, j in zip(texts, whole, joined)
        ]


@cache
def _library_at(path: str) -> Library:
    """The tokenizer and the pieces that the tasks of a Python worker share, one after the other."""
    return Library(path)


def _encoding(vocabulary: str, end: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, place = _library_at(public_tokenizers.path(vocabulary)), 0
        for batch in batches:
            for first in range(0, len(batch), _TOGETHER):
                part = batch.slice(first, _TOGETHER)
                made = library.encode([t or "" for t in part["text"].to_pylist()])
                ends = np.cumsum([0, *(len(x) + 1 for x in made)], dtype=np.int32)
                flat = np.concatenate([y for x in made for y in (x, [end])]).astype(np.int32)
                places = np.arange(place, place + len(part))
                place += len(part)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(places), pa.ListArray.from_arrays(ends, flat)],
                    ["doc_id", "place", "ids"],
                )

    return run


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END
) -> None:
    """Write ``doc_id, place, ids`` for the whole texts of ``docs (doc_id, text)``.

    Files follow each other by name in ascending ``doc_id``, and so do the rows in a file;
    ``place`` numbers them. Null ids come first, equal ids in the order of a hash of their texts; a
    repeated id is dealt over files by that hash, and repeated rows by a row number. Null and empty
    texts consist of the ``end`` id, which every document gets. No rows: no file with rows. A text
    is held whole with its ids, about 15 bytes a byte of it.
    """
    spread = [F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row")]
    order = ["doc_id", "_hash", "_row"]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *spread)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    made = map_arrow(ordered, _encoding(vocabulary, end), _STORED)
    made.write.option("orc.bloom.filter.columns", "doc_id").option(
        "orc.row.index.stride", 10_000
    ).option("orc.compress", "ZSTD").orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their ``file``: its number, which its name begins with."""
    stored = spark.read.schema(_STORED).orc(path)
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).cast("long")
    return stored.select("*", number.alias("file"))


def tokens_of(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored rows of a few documents; files, stripes and row groups without them are skipped.

    Files are in order of the ids, so their statistics leave few of them; within a file the Bloom
    filters and the row indexes do the rest. Readers split a file at its stripes.
    """
    stored = spark.read.schema(_STORED).orc(path)
    return stored.where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def _summing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        ends = ids.offsets.to_numpy()
        flat = ids.values.to_numpy().astype("<u4")
        crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch["file"], batch["place"], batch["doc_id"],
                pa.array(np.diff(ends).astype(np.int64)), pa.array(crcs, pa.int64()),
            ],
            ["file", "place", "doc_id", "n_tokens", "ids_crc32"],
        )


def summary(spark: SparkSession, path: str, stage: Stage) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per stored document, read back from the files.

    ``start`` counts the ids of all documents before it: those of earlier files, of which there
    is one total each, and those of earlier rows of its file.
    """
    kinds = "file long, place long, doc_id long, n_tokens long, ids_crc32 long"
    rows = stage(map_arrow(read_token_files(spark, path), _summing, kinds), "token_counts")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("file")) - F.col("total")
    offsets = totals.select("file", before.alias("before"))
    in_file = Window.partitionBy("file").orderBy("place")
    within = F.sum("n_tokens").over(in_file) - F.col("n_tokens")
    return (
        rows.withColumn("within", within)
        .join(offsets, "file")
        .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
    )
