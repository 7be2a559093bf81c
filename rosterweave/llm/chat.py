"""Chats from event logs: folded, rendered with a template, and read back.

A conversation is a log of events in sequence. A message starts, grows by streamed deltas, may be
edited (its text is replaced) or regenerated (it starts anew); what is left at the end of the log
is rendered. Logs are partitioned by conversation and sorted, and the fold walks through them with
one message in memory, so a conversation may have any number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import map_arrow, rows

START, DELTA, EDIT, REGENERATE = "start", "delta", "edit", "regenerate"
#: What opens and closes a turn. Any other role is written out between ROLE marks.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
ROLE_OPEN, ROLE_CLOSE, OTHER_CLOSE = "[ROLE] ", " [/ROLE] ", " </s>"
CONTROLS = ["<<SYS>>", "<</SYS>>", "<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]
TRAINED = "assistant"
_CONTROL = "|".join(map(re.escape, CONTROLS))
_ESCAPE = re.compile(rf"(\\*)({_CONTROL})")
_MARK = re.compile(rf"(?<!\\)(?:{_CONTROL})")
_OUT = 2_000  # rows per batch handed out
_PIECES = "conv_id long, place long, role string, piece string, loss_begin long, loss_end long"
_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def escaped(text: str) -> str:
    """Put a backslash before each control string, and double those already there."""
    return _ESCAPE.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[1][: (len(m[1]) - 1) // 2] + m[2] if m[1] else m[0], text)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn as the template writes it, and where the loss applies in it (nowhere: 0, 0)."""
    if role in TEMPLATE:
        head, tail = TEMPLATE[role]
    else:
        head, tail = f"{ROLE_OPEN}{escaped(role)}{ROLE_CLOSE}", OTHER_CLOSE
    body = escaped(text)
    span = (len(head), len(head) + len(body)) if role == TRAINED else (0, 0)
    return head + body + tail, *span


def parsed(text: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns in rendered text; only unescaped control strings count."""
    marks = [(m.start(), m[0]) for m in _MARK.finditer(text)] + [(len(text), "")]
    turns, at, i = [], 0, 0
    closing = {"<<SYS>>": "system", "<s>": "user"}
    while at < len(text):
        start, mark = marks[i]
        if start == at and mark in closing:
            role = closing[mark]
            i += 1 + (role == "user")
        elif start == at and mark == "[ROLE]":
            role = unescaped(text[at + len(ROLE_OPEN) : marks[i + 1][0] - 1])
            at = marks[i + 1][0] - 1
            i += 2
        else:
            role = TRAINED
        head, tail = TEMPLATE.get(role, (ROLE_CLOSE, OTHER_CLOSE))
        end = marks[i][0] - 1
        turns.append((role, unescaped(text[at + len(head) : end])))
        at = end + len(tail)
        i += 1
    return turns


def messages(events: DataFrame) -> DataFrame:
    """``conv_id, place, role, piece, loss_begin, loss_end``: final turns, rendered, in order.

    ``events`` has ``conv_id, message, seq, kind, role, text``; ``message`` orders the turns of a
    conversation and ``seq`` the events of a message. A start or a regeneration begins the text
    anew and sets the role if it has one, an edit replaces the text, a delta extends it; events
    before the first start count as well, and other kinds do nothing. Null texts are empty, null
    roles too. Events that tie are taken by kind, role and text. Null conversations are one
    conversation. The rendered conversation is its pieces one behind the other.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, place, role, parts = None, 0, "", []

        def close():
            piece, begin, end = rendered(role, "".join(parts))
            out.append((key[0], place, role, piece, begin, end))

        def batch():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            names = ["conv_id", "place", "role", "piece", "loss_begin", "loss_end"]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return made

        for conv, message, kind, said_by, text in rows(
            batches, "conv_id", "message", "kind", "role", "text"
        ):
            if key != (conv, message):
                if key is not None:
                    close()
                    place = place + 1 if key[0] == conv else 0
                    if len(out) >= _OUT:
                        yield batch()
                key, role, parts = (conv, message), "", []
            if kind in (START, REGENERATE):
                role = said_by or role
            if kind in (START, REGENERATE, EDIT):
                parts = [text or ""]
            elif kind == DELTA:
                parts.append(text or "")
        if key is not None:
            close()
        if out:
            yield batch()

    order = ["conv_id", "message", "seq", "kind", "role", "text"]
    dealt = events.select(*order).repartition("conv_id").sortWithinPartitions(*order)
    return map_arrow(dealt, run, _PIECES)


def read_back(pieces: DataFrame) -> DataFrame:
    """What stands in rendered conversations: turns, loss and length, one row per conversation.

    ``pieces`` comes from ``messages``, whose order within partitions is relied on.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def close():
            n, turns, chars, loss, length = state
            out.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), length))

        def batch():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [part.split()[0] for part in _DIGEST.split(", ")]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return made

        for conv, piece, begin, end in rows(batches, "conv_id", "piece", "loss_begin", "loss_end"):
            if key != (conv,):
                if key is not None:
                    close()
                    if len(out) >= _OUT:
                        yield batch()
                key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parsed(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            loss = unescaped(piece[begin:end])
            state[2] += len(loss)
            state[3].update(loss.encode("utf-8", "surrogatepass"))
            state[4] += len(piece)
        if key is not None:
            close()
        if out:
            yield batch()

    return map_arrow(pieces, run, _DIGEST)


def events_of_turns(turns: DataFrame) -> DataFrame:
    """Event log of ``turns (conv_id, turn, role, text)``, as a chat that went wrong once per turn.

    A turn starts and streams a draft. In odd turns the answer is then regenerated and streamed
    anew in two deltas; in even ones an edit replaces the draft by the first half, and a delta adds
    the second. Events come in the wrong order. Turns with equal numbers are ordered by role and text.
    """
    numbered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    first = F.substring("text", F.lit(1), half)
    second = F.substring("text", half + 1, F.length("text"))
    none = F.lit(None).cast("string")

    def event(seq, kind, role, text):
        return F.struct(
            F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"),
            text.alias("text"),
        )

    draft = event(1, DELTA, none, F.reverse(second))
    start = event(0, START, F.col("role"), none)
    again = F.array(
        event(4, DELTA, none, second), event(3, DELTA, none, first), event(2, REGENERATE, none, none),
        draft, start,
    )
    edited = F.array(event(3, DELTA, none, second), event(2, EDIT, none, first), draft, start)
    log = F.when(F.col("message") % 2 == 1, again).otherwise(edited)
    return (
        turns.withColumn("message", F.row_number().over(numbered))
        .select("conv_id", "message", F.explode(log).alias("e"))
        .select("conv_id", "message", "e.*")
    )
