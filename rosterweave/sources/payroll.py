"""Payroll extract: a table export (CSV with header, or Parquet), all columns as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.config import MISSING_CELLS, PAYROLL
from rosterweave.functions.text import missing_as_null
from rosterweave.plans.staging import Stage
from rosterweave.sources.common import (
    ERROR,
    FILE,
    RAW_RECORD,
    file_of_scan,
    read_or_empty,
    split_rejects,
    string_columns,
    with_ordinal,
)
from rosterweave.sources.csv_records import parse_csv

COLUMNS = [
    "employee_id", "source", "base_salary", "currency", "pay_frequency", "bonus_target_pct",
    "effective_date",
]


def parse_payroll(
    spark: SparkSession,
    path: str,
    stage: Stage,
    fmt: str = "csv",
    encoding: str = "UTF-8",
    multiline: bool = True,
) -> DataFrame:
    """Rows with ordinals and errors. Store the result, then ``split_rejects`` it.

    Only CSV has damaged records; a table format is read as it is.
    """
    if fmt == "csv":
        parsed = parse_csv(spark, path, COLUMNS, stage, encoding, multiline)
    else:
        scan = read_or_empty(
            spark,
            lambda: spark.read.format(fmt).load(path).select("*", file_of_scan()),
            string_columns([*COLUMNS, FILE]),
        )
        cells = [missing_as_null(F.col(c).cast("string"), MISSING_CELLS).alias(c) for c in COLUMNS]
        none = F.lit(None).cast("string")
        parsed = with_ordinal(scan.select(FILE, *cells, none.alias(ERROR), none.alias(RAW_RECORD)))
    return parsed.withColumn("bonus_target_pct", F.col("bonus_target_pct").try_cast("double"))


def read_payroll(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    encoding: str = "UTF-8",
    multiline: bool = True,
) -> DataFrame:
    """The usable rows alone."""
    parsed = parse_payroll(spark, path, Stage(spark), fmt, encoding, multiline)
    return split_rejects(parsed, PAYROLL).rows


def repeated_ids(df: DataFrame, column: str = "employee_id") -> DataFrame:
    """How many rows repeat an id seen before; null counts as one more value."""
    per_id = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    )
