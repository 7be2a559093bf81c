"""One-row reports of the de-duplication passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(values: dict[str, DataFrame]) -> DataFrame:
    """One row with a column per one-row, one-column (``value``) frame."""
    stacked = reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("name"), F.col("value").cast("long").alias("value"))
            for name, df in values.items()
        ],
    )
    return stacked.agg(
        *[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in values]
    )


def pass_report(name: str, counted: DataFrame, details: dict[str, Column]) -> DataFrame:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("long"))]
    return counted.select(
        F.lit(name).alias("pass_name"),
        "input_rows",
        "output_rows",
        "rows_removed",
        "rows_quarantined",
        F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("details"),
    )
