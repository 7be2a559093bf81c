"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.config import HEAVY_ROWS

_CUTS, _OTHER_CUTS, _SLICE, _OTHER_SLICE = "_cuts", "_other_cuts", "_slice", "_other_slice"


def own_key(column: str, row_id: str = "ingest_ordinal") -> Column:
    """The key, or a value no key equals and no other row has, so that nulls do not gather."""
    return F.coalesce(F.col(column), F.concat(F.lit("\0"), F.col(row_id).cast("string")))


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` in as many parts as shuffles have, by ``columns``.

    For the sides of a join that makes far more rows than it reads: parts are otherwise merged, or
    taken as a scan has them, by the size of what is read, and a few tasks make all the rows.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def spread_join(
    rows: DataFrame,
    other: DataFrame,
    on: list[str],
    weights: DataFrame,
    row_id: str,
    how: str = "inner",
    heavy_rows: int = HEAVY_ROWS,
    other_id: str | None = None,
) -> DataFrame:
    """Join ``rows`` to ``other``, spreading the rows of heavy keys over many tasks.

    ``weights`` has the columns ``on`` and ``n``, the number of ``rows`` per key. One small job
    reads its maximum: without a heavy key the join is a plain one. Every key with ``heavy_rows``
    rows or more is cut into slices by ``row_id``, and its partners in ``other`` are repeated once
    per slice.

    With ``other_id``, for inner joins, ``weights`` also has ``m``, the number of partners per
    key. Then a key is heavy if it makes ``heavy_rows`` pairs or more, and both sides are cut, so
    that a slice makes about ``heavy_rows`` pairs. As few rows can make very many pairs, both sides
    are dealt over all parts (see ``dealt``).

    The table of heavy keys is joined like any other: its size decides how.
    """
    if other_id is None:
        heavy, side = weights.where(F.col("n") >= heavy_rows), heavy_rows
        other_cuts = F.lit(1)
    else:
        if how != "inner":
            raise ValueError("both sides of an inner join can be cut, of no other")
        heavy = weights.where(F.col("n") * F.col("m") >= heavy_rows)
        side = max(int(heavy_rows**0.5), 1)
        other_cuts = F.ceil(F.col("m") / side)
    def join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        if other_id is not None:
            a, b = dealt(a, *keys), dealt(b, *keys)
        return a.join(b, keys, how)

    if heavy.isEmpty():
        return join(rows, other, on)
    cuts = heavy.select(
        *on,
        F.ceil(F.col("n") / side).cast("long").alias(_CUTS),
        other_cuts.cast("long").alias(_OTHER_CUTS),
    )
    one = F.lit(1).cast("long")

    def cut(df: DataFrame, own: str, name: str, id_: str | None, far: str, far_name: str):
        """Each row in its slice of ``own`` cuts, once per slice of the ``far`` side."""
        mine = F.pmod(F.xxhash64(id_), F.coalesce(own, one)) if id_ else one - 1
        repeats = F.explode(F.sequence(one - 1, F.coalesce(far, one) - 1))
        sliced = df.join(cuts, on, "left").withColumn(name, mine)
        return sliced.withColumn(far_name, repeats).drop(_CUTS, _OTHER_CUTS)

    sliced = cut(rows, _CUTS, _SLICE, row_id, _OTHER_CUTS, _OTHER_SLICE)
    repeated = cut(other, _OTHER_CUTS, _OTHER_SLICE, other_id, _CUTS, _SLICE)
    keys = [*on, _SLICE, _OTHER_SLICE]
    return join(sliced, repeated, keys).drop(_SLICE, _OTHER_SLICE)
