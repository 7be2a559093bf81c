"""Staff master of company A: CSV with a header, all columns as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterweave.config import STAFF_A
from rosterweave.plans.staging import Stage
from rosterweave.sources.common import split_rejects
from rosterweave.sources.csv_records import parse_csv

COLUMNS = [
    "employee_id", "first_name", "last_name", "email", "department", "job_title", "hire_date",
    "country", "employment_type", "manager_id",
]


def parse_staff_csv(
    spark: SparkSession, path: str, stage: Stage, encoding: str = "UTF-8", multiline: bool = True
) -> DataFrame:
    """Rows with ordinals and errors. Store the result, then ``split_rejects`` it."""
    return parse_csv(spark, path, COLUMNS, stage, encoding, multiline)


def read_staff_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multiline: bool = True
) -> DataFrame:
    """The usable rows alone."""
    parsed = parse_staff_csv(spark, path, Stage(spark), encoding, multiline)
    return split_rejects(parsed, STAFF_A).rows
