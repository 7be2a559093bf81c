"""Token counts under a unigram vocabulary, scored once per shared prefix.

A text is split in pre-tokens; the cheapest way to write each in pieces of the vocabulary is found
by dynamic programming over its prefixes. The best score of a prefix does not depend on what
follows, so the distinct pre-tokens of a batch form a trie whose nodes hold one score each. It is
walked depth first, which is the order of the sorted pre-tokens: a stack holds the scores along
the path, and a pre-token only adds those behind the prefix it shares with the last one. Counts at
the terminal nodes are stored, and documents add theirs up.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache
from os.path import commonprefix

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from rosterweave.llm.common import map_arrow

VOCABULARY = "piece_bpe_32k.model"
START = "▁"
_UNIT = 1_000_000
_PENALTY = 10 * _UNIT  # what a character outside the vocabulary costs beyond the dearest piece
_CACHED = 400_000  # pre-tokens in each of two generations whose counts a task keeps
_TOGETHER = 256  # texts whose pre-tokens share a trie


class Vocabulary:
    """Pieces with whole-numbered costs: -log of a probability that falls with the rank.

    The file gives an order of its pieces, the most useful first, and no probabilities; that of
    rank r is taken as proportional to 1 / (r + 1). Whole numbers leave no rounding to compare.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.cost = {
            model.id_to_piece(i): round(_UNIT * math.log(rank + 1)) for rank, i in enumerate(plain)
        }
        self.longest = max(map(len, self.cost))
        self.unknown = max(self.cost.values()) + _PENALTY

    def counts(self, pre_tokens: Iterable[str]) -> Iterator[tuple[str, int]]:
        """Pre-tokens in order, each with the number of pieces of its cheapest segmentation.

        Of equally cheap ones the shortest counts. A character that no piece covers is written as
        its bytes.
        """
        cost_of, longest = self.cost.get, self.longest
        last, path = "", [(0, 0)]
        for token in sorted(pre_tokens):
            shared = len(commonprefix((last, token)))
            del path[shared + 1 :]
            for end in range(shared + 1, len(token) + 1):
                cost, count = path[end - 1]
                cost += self.unknown
                count += len(token[end - 1].encode("utf-8", "surrogatepass"))
                for start in range(max(0, end - longest), end):
                    own = cost_of(token[start:end])
                    if own is not None:
                        before, pieces = path[start]
                        before += own
                        if before < cost or (before == cost and pieces + 1 < count):
                            cost, count = before, pieces + 1
                path.append((cost, count))
            last = token
            yield token, path[-1][1]


@cache
def vocabulary_at(path: str) -> Vocabulary:
    return Vocabulary(path)


def _counting(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known, older = vocabulary_at(path), {}, {}
        for batch in batches:
            for first in range(0, len(batch), _TOGETHER):
                part = batch.slice(first, _TOGETHER)
                split = [(text or "").split() for text in part["text"].to_pylist()]
                if len(known) > _CACHED:
                    known, older = {}, known
                unseen = set().union(*split).difference(known)
                again = unseen & older.keys()
                known.update((w, older[w]) for w in again)
                found = vocabulary.counts(START + w for w in unseen - again)
                known.update((token[1:], n) for token, n in found)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(words) for words in split], pa.int64()),
                        pa.array([sum(map(known.__getitem__, w)) for w in split], pa.int64()),
                    ],
                    ["doc_id", "n_pre_tokens", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_pre_tokens, n_tokens`` per row of ``docs (doc_id, text, ...)``.

    White space separates pre-tokens; each begins with the mark of a word start. Null and empty
    texts have none. Whole texts are counted; repeated rows and null ids keep a row each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"),
        _counting(public_tokenizers.path(vocabulary)),
        f"doc_id {kind}, n_pre_tokens long, n_tokens long",
    )
