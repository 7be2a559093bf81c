"""Rows to shards by jump consistent hashing.

A stable key and the number of shards alone decide: there is no ring and no table of shards, and an
appended shard takes the share of rows it needs from the others, which exchange none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import ship
from rosterweave.plans.staging import Stage

SHARDS = 24
#: Bytes that a row counts beyond its text.
OVERHEAD = 8
LAW = "key"
#: The multiplier of the jump hash and those of the mixing of ids (fixed values).
JUMP = 2862933555777941757
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
#: The key of rows without an id.
NO_ID = 0x9E3779B97F4A7C15
#: Rows of offsets that are broadcast at most (32 bytes each).
_SMALL = 200_000


def mixed(ids: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit keys of integer ids, so that neighbouring ids share no pattern."""
    keys = ids.astype(np.int64).view(np.uint64).copy()
    shift = np.uint64(33)
    for factor in MIX:
        keys ^= keys >> shift
        keys *= np.uint64(factor)
    return keys ^ (keys >> shift)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key, 0 to ``shards`` - 1.

    A key jumps to ever higher shards, further the later; the last one below ``shards`` is its own.
    All keys jump together; those that have passed the end leave.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    moving, at = np.arange(len(state)), np.zeros(len(state), np.int64)
    while len(moving):
        shard[moving] = at
        state = state * np.uint64(JUMP) + np.uint64(1)
        span = float(1 << 31) / ((state >> np.uint64(33)) + np.uint64(1)).astype(float)
        at = ((at + 1) * span).astype(np.int64)
        inside = at < shards
        moving, at, state = moving[inside], at[inside], state[inside]
    return shard


def shard_of(docs: DataFrame, shards: int, key: Column | None = None) -> Column:
    """The shard of a row of ``docs`` by an integer ``key`` (``doc_id``); nulls are one key."""
    ship(docs.sparkSession)

    @F.pandas_udf("int")
    def placed(ids: pd.Series, none: pd.Series) -> pd.Series:
        keys = mixed(ids.to_numpy(np.int64))
        keys[none.to_numpy(bool)] = np.uint64(NO_ID)
        return pd.Series(jump(keys, shards), dtype="int32")

    key = (F.col("doc_id") if key is None else key).cast("long")
    # Nulls go by a column of their own: longs with nulls would reach pandas as floats.
    return placed(F.coalesce(key, F.lit(0)), key.isNull())


def assigned(docs: DataFrame, stage: Stage, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``.

    ``size`` is the UTF-8 bytes of the text and ``OVERHEAD``; a null text counts as empty. The id
    alone decides on the shard, so copies of a text spread and rows with one id stay together; rows
    without an id are one key. ``grown_shard`` is the shard once another has been appended.

    ``slot`` numbers the rows of a shard from 0 without gaps, by id (null first), size and
    checksum; repeated rows are interchangeable. Texts of any length are read once, and only
    numbers are sorted: by ranges over shard and id, down to single rows, so neither a shard nor an
    id has to fit one task. No rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = narrow.select(
        "*",
        shard_of(narrow, shards).alias("shard"),
        shard_of(narrow, shards + 1).alias("grown_shard"),
    )
    order = ["shard", "doc_id", "size", "text_crc32", "row"]
    keyed = stage(keyed, "keyed").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(keyed.drop("row").withColumn("at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    found = placed.groupBy("shard", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    offsets = stage(found.select("shard", "part", (before - F.col("first")).alias("shift")), "offsets")
    if offsets.count() <= _SMALL:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("at") + F.col("shift")).alias("slot"), "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> str:
    """Write all rows and columns of ``docs`` as Parquet, a folder per shard; returns its column.

    The column is called ``shard``, with underscores behind it while ``docs`` has that name. Rows
    are dealt by ranges over shard, id and text, so a large shard is many files.
    """
    name = "shard"
    while name in docs.columns:
        name += "_"
    order = [name, "doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    made = docs.withColumn(name, shard_of(docs, shards)).repartitionByRange(*order)
    made.sortWithinPartitions(name, "doc_id").write.partitionBy(name).parquet(path)
    return name
