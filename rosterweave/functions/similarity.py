"""Token-sort similarity, and keys that let similar names meet in an equi-join.

The score of two names is ``100 * 2*L / (la + lb)`` where ``L`` is the length of the longest
common subsequence of their token-sorted texts. A pair reaches the threshold ``T`` exactly when
the edits that turn one text into the other by deleting and inserting characters,
``la + lb - 2*L``, number at most ``(100 - T) * (la + lb) / 100`` (the *budget*).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterweave.functions.text import strip


def token_sorted(name: Column) -> Column:
    tokens = F.split(strip(name), r"(?U)\s+")
    return F.array_join(F.sort_array(tokens), " ")


def budget(length_a: Column, length_b: Column, threshold: int) -> Column:
    """Most single-character edits a pair of these lengths may need and still match."""
    return F.floor((100 - threshold) * (length_a + length_b) / 100).cast("int")


def _longest_partner(length: Column, threshold: int) -> Column:
    return F.floor(length * (200 - threshold) / threshold).cast("int")


def _segment_width(length: Column, threshold: int) -> Column:
    edits = budget(length, _longest_partner(length, threshold), threshold)
    return F.floor(length / (edits + 1)).cast("int")


def blocks_on_segments(threshold: int) -> bool:
    """Below two thirds the budget exceeds the text, so no segment is sure to survive."""
    return 3 * threshold > 200


def _segment(width: Column, position: Column, text: Column, start: Column) -> Column:
    return F.concat_ws(":", width, position, F.substring(text, start + 1, width))


def _of_length(length: Column) -> Column:
    """The key of texts that only their length tells apart."""
    return F.concat(F.lit("length:"), length)


def indexed_segments(text: Column, threshold: int) -> Column:
    """Keys of the indexed side: its text cut into one segment more than its largest budget.

    Each edit touches at most one segment, so one of them is found unchanged in any text that
    matches, moved by at most the budget. Where no segment is sure to survive, the key is the length.
    """
    if threshold < 1:
        raise ValueError("a threshold below 1 is reached by every pair of names")
    length = F.length(text)
    if not blocks_on_segments(threshold):
        return F.array(_of_length(length))
    edits = budget(length, _longest_partner(length, threshold), threshold)
    width = _segment_width(length, threshold)
    return F.when(width < 1, F.array(_of_length(length))).otherwise(
        F.transform(F.sequence(F.lit(0), edits), lambda i: _segment(width, i, text, i * width))
    )


def probing_segments(text: Column, threshold: int) -> Column:
    """Keys of the probing side: every place an indexed segment of a matching text can sit."""
    length = F.length(text)
    shortest = F.ceil(length * threshold / (200 - threshold)).cast("int")
    longest = _longest_partner(length, threshold)
    lengths = F.sequence(shortest, longest)
    if not blocks_on_segments(threshold):
        return F.transform(lengths, _of_length)
    edits = budget(length, longest, threshold)
    widths = F.array_distinct(F.transform(lengths, lambda n: _segment_width(n, threshold)))
    too_short = F.filter(lengths, lambda n: _segment_width(n, threshold) < 1)

    def places(width: Column) -> Column:
        last = F.floor((length + edits) / width).cast("int")
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.transform(
                    F.filter(
                        F.sequence(i * width - edits, i * width + edits),
                        lambda p: (p >= 0) & (p + width <= length),
                    ),
                    lambda p: _segment(width, i, text, p),
                ),
            )
        )

    found = F.flatten(F.transform(F.filter(widths, lambda w: w >= 1), places))
    return F.array_distinct(F.concat(found, F.transform(too_short, _of_length)))


def may_match(a: Column, b: Column, threshold: int) -> Column:
    """Cheap test that never rejects a match: Levenshtein is at most the number of edits."""
    la, lb = F.length(a), F.length(b)
    most = budget(la, lb, threshold)
    # With a bound the distance stops early, and is -1 beyond it.
    return (F.abs(la - lb) <= most) & (F.call_function("levenshtein", a, b, most) >= 0)


#: Characters of a name that one word of state stands for; a sum of two words must not overflow.
_WORD = 62
_ONES = (1 << _WORD) - 1


def _char_masks(chars: Column, start: Column, width: Column) -> Column:
    """Map from each character of a stretch of ``chars`` to the bits of its places there."""
    part = F.slice(chars, start + 1, width)

    def mask(char: Column) -> Column:
        bits = F.transform(
            part, lambda x, i: F.when(x == char, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(0)
        )
        return F.aggregate(bits, F.lit(0).cast("long"), lambda total, bit: total + bit)

    distinct = F.array_distinct(part)
    return F.map_from_arrays(distinct, F.transform(distinct, mask))


def _lcs_short(a: Column, b: Column) -> Column:
    """For ``a`` of up to 62 characters: one integer of state, four operations per character of ``b``.

    A bit of the state is 0 where the common subsequence of what was read grows; the sum carries
    each match on to the next place where one is possible.
    """
    masks = _char_masks(F.split(a, ""), F.lit(0), F.length(a))
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(a)) - 1

    def step(state: Column, char: Column) -> Column:
        known = F.coalesce(F.try_element_at(masks, char), F.lit(0).cast("long"))
        hit = state.bitwiseAND(known)
        return (state + hit).bitwiseOR(state - hit).bitwiseAND(full)

    last = F.aggregate(F.split(b, ""), full, step)
    return F.length(a) - F.bit_count(last)


def _lcs_long(a: Column, b: Column) -> Column:
    """The same over words of 62 characters; a carry goes from word to word."""
    length = F.length(a)
    words = F.ceil(length / _WORD).cast("int")
    chars = F.split(a, "")
    starts = F.transform(F.sequence(F.lit(0), words - 1), lambda k: k * _WORD)
    width = lambda start: F.least(length - start, F.lit(_WORD))
    masks = F.transform(starts, lambda start: _char_masks(chars, start, width(start)))
    shift = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    full = F.transform(starts, lambda start: shift(width(start)) - 1)

    def step(state: Column, char: Column) -> Column:
        def word(done: Column, k: Column) -> Column:
            mine = F.element_at(state, k + 1)
            known = F.coalesce(F.try_element_at(F.element_at(masks, k + 1), char), F.lit(0).cast("long"))
            hit = mine.bitwiseAND(known)
            total = mine + hit + done["carry"]
            new = total.bitwiseOR(mine - hit).bitwiseAND(F.element_at(full, k + 1))
            carry = F.call_function("shiftright", total, F.lit(_WORD))
            return F.struct(carry.alias("carry"), F.array_append(done["words"], new).alias("words"))

        start = F.struct(
            F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("words")
        )
        return F.aggregate(F.sequence(F.lit(0), words - 1), start, word, lambda done: done["words"])

    last = F.aggregate(F.split(b, ""), full, step)
    ones = F.transform(last, lambda w: F.bit_count(w))
    return length - F.aggregate(ones, F.lit(0), lambda total, n: total + n)


def lcs_length(a: Column, b: Column) -> Column:
    """Longest common subsequence, by bits: a step per character of ``b`` and 62 of ``a``."""
    return (
        F.when((a == "") | (b == ""), 0)
        .when(F.length(a) <= _WORD, _lcs_short(a, b))
        .otherwise(_lcs_long(a, b))
    )


def score_reached(lcs: Column, lengths: Column, threshold: int) -> Column:
    """Integer comparison, so the threshold itself is not subject to rounding."""
    return 200 * lcs.cast("long") >= threshold * lengths.cast("long")


def score(lcs: Column, lengths: Column) -> Column:
    return F.when(lengths == 0, 100.0).otherwise(200.0 * lcs / lengths)
