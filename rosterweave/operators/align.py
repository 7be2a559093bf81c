"""Two staff schemas -> one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.config import (
    EMPLOYMENT_TYPE_CODES,
    EMPLOYMENT_TYPES,
    STAFF_A,
    STAFF_B,
    STANDARD_COLUMNS,
)
from rosterweave.functions.text import relabel
from rosterweave.functions.values import MONTH_NAME_DATE

COLUMNS = ["ingest_ordinal", *STANDARD_COLUMNS]


def align_staff_a(staff: DataFrame) -> DataFrame:
    """The whole date text is kept; a date in the third layout has eleven characters."""
    return staff.select(
        "ingest_ordinal",
        "employee_id",
        F.lit(STAFF_A).alias("source_system"),
        "first_name",
        "last_name",
        "email",
        "department",
        "job_title",
        "hire_date",
        "country",
        "employment_type",
        F.lit("Active").alias("employment_status"),
        F.regexp_replace(F.coalesce("manager_id", F.lit("")), r"\.0$", "").alias("manager_id"),
    )


def align_staff_b(staff: DataFrame) -> DataFrame:
    """Of a time stamp the date is kept; a date in the third layout has eleven characters."""
    hired = F.col("hire_timestamp")
    whole = F.when(hired.rlike(MONTH_NAME_DATE), hired).otherwise(F.substring(hired, 1, 10))
    return staff.select(
        "ingest_ordinal",
        F.col("employee_identifier").alias("employee_id"),
        F.lit(STAFF_B).alias("source_system"),
        "first_name",
        "last_name",
        "email",
        "department",
        F.col("role").alias("job_title"),
        whole.alias("hire_date"),
        F.col("location").alias("country"),
        relabel(F.col("employment_type"), EMPLOYMENT_TYPE_CODES).alias("employment_type"),
        "employment_status",
        F.coalesce("manager_employee_id", F.lit("")).alias("manager_id"),
    )


def align(staff_a: DataFrame, staff_b: DataFrame) -> DataFrame:
    """The 12 standard columns (and the ordinal) of both masters; either may be empty."""
    return align_staff_a(staff_a).unionByName(align_staff_b(staff_b)).select(*COLUMNS)


def unknown_types_a(staff_a: DataFrame) -> DataFrame:
    """Employment types of company A outside the allow-list; null is not one."""
    return (
        staff_a.where(~F.col("employment_type").isin(EMPLOYMENT_TYPES))
        .select("employment_type")
        .distinct()
    )


def unknown_types_b(staff_b: DataFrame) -> DataFrame:
    """Employment codes of company B without a label, null included."""
    code = F.col("employment_type")
    return (
        staff_b.where(code.isNull() | ~code.isin(list(EMPLOYMENT_TYPE_CODES)))
        .select("employment_type")
        .distinct()
    )
