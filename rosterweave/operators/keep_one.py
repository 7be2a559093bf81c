"""Keep the latest row per key, and the rows it supersedes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.plans.staging import Stage

ORDINAL = "ingest_ordinal"


class Split(NamedTuple):
    current: DataFrame
    history: DataFrame


def _newest_first(by: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in by]


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key: the highest of ``by``, nulls lowest.

    Asking for ``row_number() = 1`` lets Spark cut each key to one row before the shuffle, so a
    key with a third of all rows arrives as one row per map task.
    """
    order = Window.partitionBy(*keys).orderBy(*_newest_first(by))
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def split_latest(
    df: DataFrame,
    keys: list[str],
    by: list[str],
    row_id: list[str] | None = None,
    stage: Stage | None = None,
) -> Split:
    """Latest rows and all others.

    The others are found by row identity, not by ranking inside the key: the join is spread evenly
    however many rows one key has. ``row_id`` must be unique; nulls in it are values.
    With ``stage`` the latest rows are stored, so that they are looked for once, however often they and
    the others are read.
    """
    row_id = row_id or [ORDINAL]
    current = latest(df, keys, by)
    if stage:
        current = stage(current, "latest_rows")
    kept = current.select(*[F.col(c).alias(f"_kept_{c}") for c in row_id])
    same = [F.col(c).eqNullSafe(F.col(f"_kept_{c}")) for c in row_id]
    return Split(current, df.join(kept, same, "left_anti"))
