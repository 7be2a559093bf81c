"""Declarative data-quality checks, the report and the gate.

All row-level checks of a table share one scan. A uniqueness or reference check counts per value
first, so a value that fills a third of the table is combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.config import (
    CURRENCIES,
    EMAIL_PATTERN,
    EMPLOYEE_ID_PATTERN,
    EMPLOYMENT_TYPES,
    HIRE_DATE_MIN,
    SALARY_MAX,
    SALARY_MIN,
    Settings,
)
from rosterweave.functions.text import present
from rosterweave.functions.values import pass_rate

REPORT_COLUMNS = [
    "check_no", "check", "description", "total", "passed", "failed", "pass_rate", "status",
]
ROW_KINDS = ("not_null", "values_in_set", "regex", "numeric_range", "date_range")


@dataclass(frozen=True)
class Check:
    """One rule on one column. ``params`` by kind: values, pattern, low/high, or ref column."""

    kind: str
    table: str
    column: str
    description: str
    params: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}.{self.column}"


# --- constructors; the description texts are fixed values ---


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column, f"{column} must not be null or blank")


def unique(table: str, column: str) -> Check:
    text = f"{column} must be unique across all records (post-dedup)"
    return Check("unique", table, column, text)


def values_in_set(table: str, column: str, values: Sequence[str]) -> Check:
    text = f"{column} must be one of: {', '.join(sorted(values))}"
    return Check("values_in_set", table, column, text, {"values": list(values)})


def regex(table: str, column: str, pattern: str, description: str) -> Check:
    return Check("regex", table, column, description, {"pattern": pattern})


def numeric_range(table: str, column: str, low: float, high: float) -> Check:
    text = f"{column} must be between {low:,.0f} and {high:,.0f}"
    return Check("numeric_range", table, column, text, {"low": low, "high": high})


def date_range(table: str, column: str, low: dt.date, high: dt.date) -> Check:
    text = f"{column} must be between {low} and {high}"
    return Check("date_range", table, column, text, {"low": low, "high": high})


def reference(table: str, column: str, ref_table: str, ref_column: str) -> Check:
    text = f"Every non-blank {column} must exist as an {ref_column}"
    params = {"table": ref_table, "column": ref_column}
    return Check("referential_integrity", table, column, text, params)


def default_checks(settings: Settings) -> list[Check]:
    emp, pay = "employees", "payroll"
    return [
        *[
            not_null(emp, c)
            for c in ("employee_id", "first_name", "last_name", "email", "department", "country")
        ],
        unique(emp, "employee_id"),
        unique(emp, "email"),
        values_in_set(emp, "employment_type", EMPLOYMENT_TYPES),
        values_in_set(pay, "currency", CURRENCIES),
        regex(emp, "email", EMAIL_PATTERN, "email must match valid RFC-style address format"),
        regex(
            emp, "employee_id", EMPLOYEE_ID_PATTERN,
            r"employee_id must match GT-\d{6} or AC-\d{6}",
        ),
        numeric_range(pay, "salary_usd_annual", SALARY_MIN, SALARY_MAX),
        date_range(emp, "hire_date", HIRE_DATE_MIN, settings.report_date),
        reference(emp, "manager_id", emp, "employee_id"),
    ]


# --- evaluation ---


def _population_and_pass(check: Check) -> tuple[Column, Column]:
    c, p = F.col(check.column), check.params
    if check.kind == "not_null":
        return F.lit(True), present(c)
    if check.kind == "values_in_set":
        return present(c), c.isin(p["values"])
    if check.kind == "regex":
        return present(c), c.rlike(p["pattern"])
    return c.isNotNull(), c.between(F.lit(p["low"]), F.lit(p["high"]))


def _result(number: int, check: Check, total: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(number).alias("check_no"),
        F.lit(check.name).alias("check"),
        F.lit(check.description).alias("description"),
        total.alias("total"),
        passed.alias("passed"),
    )


def _row_checks(table: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    counts, results = [], []
    for number, check in checks:
        population, ok = _population_and_pass(check)
        total, passed = f"total_{number}", f"passed_{number}"
        counts.append(F.count_if(population).alias(total))
        counts.append(F.count_if(population & F.coalesce(ok, F.lit(False))).alias(passed))
        results.append(_result(number, check, F.col(total), F.col(passed)))
    return table.agg(*counts).select(F.inline(F.array(*results)))


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def per_value(table: DataFrame, column: str) -> DataFrame:
    return table.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _unique_check(table: DataFrame, number: int, check: Check) -> DataFrame:
    """The first row of each value passes, null being a value too."""
    return (
        per_value(table, check.column)
        .agg(_sum(F.col("n")).alias("total"), F.count(F.lit(1)).alias("passed"))
        .select(F.inline(F.array(_result(number, check, F.col("total"), F.col("passed")))))
    )


def reference_counts(
    table: DataFrame, column: str, ref_table: DataFrame, ref_column: str
) -> DataFrame:
    """Each present reference with its row count and whether it is found."""
    used = per_value(table.where(present(F.col(column))), column)
    known = (
        per_value(ref_table.where(F.col(ref_column).isNotNull()), ref_column)
        .select(F.col(ref_column).alias(column), F.lit(True).alias("_known"))
    )
    return used.join(known, column, "left").select(
        column, "n", F.coalesce("_known", F.lit(False)).alias("known")
    )


def _reference_check(
    table: DataFrame, ref_table: DataFrame, number: int, check: Check
) -> DataFrame:
    counts = reference_counts(table, check.column, ref_table, check.params["column"])
    return counts.agg(
        _sum(F.col("n")).alias("total"), _sum(F.when(F.col("known"), F.col("n"))).alias("passed")
    ).select(F.inline(F.array(_result(number, check, F.col("total"), F.col("passed")))))


def orphans(
    table: DataFrame, column: str, ref_table: DataFrame, ref_column: str = "employee_id"
) -> DataFrame:
    """Distinct references that lead nowhere, with their row counts."""
    counts = reference_counts(table, column, ref_table, ref_column)
    return counts.where(~F.col("known")).select(column, F.col("n").alias("rows"))


def quality_report(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: total, passed, failed, pass_rate and PASS or FAIL."""
    numbered = list(enumerate(checks, start=1))
    parts = []
    for name, table in tables.items():
        row_checks = [(i, c) for i, c in numbered if c.table == name and c.kind in ROW_KINDS]
        if row_checks:
            parts.append(_row_checks(table, row_checks))
    for number, check in numbered:
        if check.kind == "unique":
            parts.append(_unique_check(tables[check.table], number, check))
        elif check.kind == "referential_integrity":
            ref = tables[check.params["table"]]
            parts.append(_reference_check(tables[check.table], ref, number, check))
    failed = F.col("total") - F.col("passed")
    return reduce(DataFrame.unionByName, parts).select(
        "check_no",
        "check",
        "description",
        "total",
        "passed",
        failed.alias("failed"),
        pass_rate(F.col("passed"), F.col("total")).alias("pass_rate"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def summary(report: DataFrame, max_failed: int) -> DataFrame:
    """Checks run, passed and failed, the share passed, and the gate with its label."""
    n_failed = F.col("failed")
    plural = F.when(n_failed == 1, "").otherwise("s")
    passed_label = F.concat(
        F.lit("PASSED ("), n_failed.cast("string"), F.lit(" failure"), plural,
        F.lit(f", threshold {max_failed})"),
    )
    failed_label = F.concat(
        F.lit("FAILED — PIPELINE HALTED ("), n_failed.cast("string"),
        F.lit(f" failures, threshold {max_failed})"),
    )
    return (
        report.agg(
            F.count(F.lit(1)).alias("checks_run"),
            F.count_if(F.col("status") == "PASS").alias("passed"),
            F.count_if(F.col("status") == "FAIL").alias("failed"),
        )
        .withColumn("pass_rate", pass_rate(F.col("passed"), F.col("checks_run")))
        .withColumn("gate_passed", n_failed <= max_failed)
        .withColumn("gate", F.when(F.col("gate_passed"), passed_label).otherwise(failed_label))
    )


def gate(report: DataFrame, max_failed: int) -> bool:
    """Whether the job may go on. Reads one row."""
    return summary(report, max_failed).select("gate_passed").first()[0]
