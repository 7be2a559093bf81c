"""Byte pair encoding as a streaming transducer, and decoding byte by byte.

``Encoder`` takes a text in parts of any size and hands out ids as soon as no later part can change
them; what it keeps is bounded, however long the text or a single word in it is. Two bounds do it:

* Pre-tokens never cross from a visible character to white space, so all before the last such
  place is settled.
* A pre-token without end is merged in a window. ``lookahead`` is computed from the merge list:
  tokens that end that many bytes before the end of what is known stay as they are.

``Decoder`` takes ids and hands out text; bytes of an unfinished character wait for the next id.
"""

from __future__ import annotations

import codecs
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.llm.common import kept, map_arrow, parts

VOCABULARY = "byte_bpe_50k.json"
PART = 1 << 16  # characters fed at once
_LONG = 1 << 12  # characters without a settled place from which a pre-token is merged in parts
_BEHIND = 4  # characters a pre-token's end may depend on
_CACHED = 1 << 17  # pieces in a generation of those whose ids a worker keeps, with its later tasks
_MARKS = frozenset(".,;:!?")
_SHIFT = 20  # ids are below 2**20
_MASK = (1 << _SHIFT) - 1
#: Code points with the property White_Space.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
_PIECE = regex.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_SETTLED = regex.compile(rf"(?r)(?<=[^{SPACE}])[{SPACE}]")
_RUNS = {
    kind: regex.compile(f"[{kind}]*")
    for kind in (r"\p{L}", r"\p{N}", rf"^{SPACE}\p{{L}}\p{{N}}", SPACE)
}


def pieces(text: str) -> list[str]:
    """Parts of ``text`` whose ids do not depend on what stands around them."""
    visible = text.replace(" ", "").replace("\n", "")
    doubled = any(pair in text for pair in ("  ", " \n", "\n ", "\n\n"))
    if doubled or text[-1:] in (" ", "\n") or "\0" in text or visible.split(None, 1) != [visible]:
        return _PIECE.findall(text)
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes before the end of the known text in which tokens may still change.

    Merges apply in list order. Where two continuations of a text differ, a merge of ``left`` and
    ``right`` there moves the place where their tokens part to the start of ``left``. A later
    merge can move it on only if its right half begins with that ``left``. The longest chain of
    such merges is the bound.
    """
    best: dict[bytes, int] = {}
    most = 0
    for left, right in reversed(merges):
        reach = len(left) + best.get(left, 0)
        most = max(most, reach)
        for end in range(1, len(right) + 1):
            start = right[:end]
            if best.get(start, 0) < reach:
                best[start] = reach
    return most


class _Spelling(dict):
    """Bytes by id; an id that the vocabulary lacks stands for nothing."""

    def __missing__(self, _: int) -> bytes:
        return b""


class Merges:
    """A byte-level vocabulary file: ids, merge ranks, special strings, lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = byte_names()
        ids = content["model"]["vocab"]
        self.bytes_of = _Spelling({i: bytes(byte_of[c] for c in token) for token, i in ids.items()})
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes_of.update((i, s.encode()) for s, i in self.special.items())
        self.byte_ids = [0] * 256
        for token, i in ids.items():
            if len(token) == 1:
                self.byte_ids[byte_of[token]] = i
        self.ranked: dict[int, int] = {}
        spelled = []
        for rank, pair in enumerate(content["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranked[ids[left] << _SHIFT | ids[right]] = rank << _SHIFT | ids[left + right]
            spelled.append((self.bytes_of[ids[left]], self.bytes_of[ids[right]]))
        self.lookahead = lookahead(spelled)

    def merged(self, text: bytes) -> list[int]:
        """Ids of one pre-token: the earliest merge of the list first, from left to right."""
        ids = [self.byte_ids[b] for b in text]
        get, none = self.ranked.get, 1 << 60
        found = [get(a << _SHIFT | b, none) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != none:
            at = found.index(best)
            new = ids[at] = best & _MASK
            del ids[at + 1], found[at]
            if at < len(found):
                found[at] = get(new << _SHIFT | ids[at + 1], none)
            if at:
                found[at - 1] = get(ids[at - 1] << _SHIFT | new, none)
        return ids


class Pieces(dict):
    """Ids of pieces as bytes of unsigned 32-bit integers, in two generations of bounded size.

    When the younger one is full it becomes the older, and what is met again moves on.
    """

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        value = self.older.get(piece)
        if value is None:
            value = self._ids(piece)
        if len(self) >= _CACHED:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value

    def _ids(self, piece: str) -> bytes:
        if piece[-1:] in _MARKS and piece[-2:-1].isalpha():
            # A mark behind a letter is a pre-token of its own: the word without it will do.
            return self[piece[:-1]] + self[piece[-1]]
        ids: list[int] = []
        whole = piece[piece[:1] == " " :].isalpha()
        for token in (piece,) if whole else _PRE_TOKEN.findall(piece):
            ids += self.merges.merged(token.encode("utf-8", "surrogatepass"))
        return array("I", ids).tobytes()


class _Run:
    """One pre-token that arrives in parts."""

    def __init__(self, merges: Merges):
        self.merges, self.held = merges, b""

    def feed(self, part: str) -> bytes:
        self.held += part.encode("utf-8", "surrogatepass")
        out = []
        window = 4 * self.merges.lookahead + 256
        while len(self.held) >= window:
            ids, end, stable = self.merges.merged(self.held[:window]), 0, []
            for i in ids:
                if end + len(self.merges.bytes_of[i]) > window - self.merges.lookahead:
                    break
                end += len(self.merges.bytes_of[i])
                stable.append(i)
            out += stable
            self.held = self.held[end:]
        return np.array(out, "<u4").tobytes()

    def finish(self) -> bytes:
        return np.array(self.merges.merged(self.held), "<u4").tobytes()


class Encoder:
    """Text in parts to ids, as bytes of unsigned 32-bit integers."""

    def __init__(self, merges: Merges, cached: Pieces):
        self.merges, self.cached = merges, cached
        self.text = ""
        self.run: _Run | None = None
        self.kind = ""

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.cached.__getitem__, pieces(text)))

    def feed(self, part: str) -> bytes:
        self.text += part
        out = []
        while True:
            found = [(at, s) for s in self.merges.special if (at := self.text.find(s)) >= 0]
            if not found:
                break
            at, special = min(found)
            rest, self.text = self.text[at + len(special) :], self.text[:at]
            out.append(self.finish())
            out.append(np.array([self.merges.special[special]], "<u4").tobytes())
            self.text = rest
        out.append(self._advance(self._free()))
        return b"".join(out)

    def _free(self) -> int:
        """Characters in hand that cannot be the beginning of a special string."""
        for special in self.merges.special:
            for n in range(min(len(special) - 1, len(self.text)), 0, -1):
                if self.text.endswith(special[:n]):
                    return len(self.text) - n
        return len(self.text)

    def _advance(self, free: int) -> bytes:
        out = []
        if self.run:
            out.append(self._continue(free))
            if self.run:
                return b"".join(out)
            free = self._free()
        settled = _SETTLED.search(self.text, 0, free)
        if settled and settled.start():
            out.append(self._plain(self.text[: settled.start()]))
            self.text = self.text[settled.start() :]
        while not self.run and (free := self._free()) > _LONG:
            token = _PRE_TOKEN.match(self.text)
            if token.end() <= free - _BEHIND:
                out.append(self.cached[token[0]])
                self.text = self.text[token.end() :]
                continue
            self.run = _Run(self.merges)
            self.kind = next(k for k, r in _RUNS.items() if r.match(token[0][-1]).end())
            out.append(self._continue(free))
        return b"".join(out)

    def _continue(self, free: int) -> bytes:
        """Feed the pre-token in progress; its last characters wait."""
        skip = 1 if self.text[:1] == " " and not self.run.held and self.kind != SPACE else 0
        end = skip + _RUNS[self.kind].match(self.text[skip:free]).end()
        if end > free - _BEHIND:
            end = max(0, free - _BEHIND)
            out = self.run.feed(self.text[:end])
        else:
            end -= self.kind == SPACE
            out = self.run.feed(self.text[:end]) + self.run.finish()
            self.run = None
        self.text = self.text[end:]
        return out

    def finish(self) -> bytes:
        """Ids of all that waited; the encoder is then as new."""
        out = []
        if self.run:
            end = _RUNS[self.kind].match(self.text).end()
            if self.kind == SPACE and end < len(self.text):
                end -= 1
            out += [self.run.feed(self.text[:end]), self.run.finish()]
            self.text = self.text[end:]
        out.append(self._plain(self.text))
        self.text, self.run = "", None
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        parts = [self.feed(text[i : i + PART]) for i in range(0, len(text), PART)]
        return np.frombuffer(b"".join([*parts, self.finish()]), "<u4")


class Decoder:
    """Ids to text; the state is the bytes of one unfinished character."""

    def __init__(self, merges: Merges):
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text

    def decode(self, ids: np.ndarray) -> str:
        parts = [self.feed(ids[i : i + PART].tolist()) for i in range(0, len(ids), PART)]
        return "".join([*parts, self.finish()])


@kept
def merges_at(path: str) -> Merges:
    return Merges(path)


@kept
def pieces_at(path: str) -> Pieces:
    """Pieces that the tasks of a Python worker share, one after the other."""
    return Pieces(merges_at(path))


def _with_ids(vocabulary: str, decode: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = public_tokenizers.path(vocabulary)
        merges = merges_at(path)
        encoder, decoder = Encoder(merges, pieces_at(path)), Decoder(merges)
        for batch in parts(batches):
            made = [encoder.encode(t) for t in batch["text"].to_pylist()]
            names = [n for n in batch.schema.names if n != "text"]
            ends = np.cumsum([0, *map(len, made)], dtype=np.int32)
            flat = np.concatenate([*made, np.empty(0, "<u4")]).astype(np.int32)
            columns = [*(batch[n] for n in names), pa.ListArray.from_arrays(ends, flat)]
            names.append("ids")
            if decode:
                columns.append(pa.array([decoder.decode(x) for x in made], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encoded(
    docs: DataFrame, columns: list[str], vocabulary: str = VOCABULARY, decode: bool = False
) -> DataFrame:
    """``columns`` of ``docs``, then ``ids`` (and, with ``decode``, their ``decoded`` text) per row.

    Ids are those of the tokenizers library for the whole text: special strings of the vocabulary
    are one id, nothing is added. Null and empty texts have no ids and decode to the empty text.
    Columns may have any names, ``ids`` and ``decoded`` apart; rows are independent of each other.
    """
    carried = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in carried.schema.fields[:-1]]
    kinds += ["ids array<int>"] + ["decoded string"] * decode
    made = map_arrow(carried, _with_ids(vocabulary, decode), ", ".join(kinds))
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    return made.select(*back, *made.columns[len(columns) :])
