"""Standardise the three aligned tables, and report what was fixed or flagged.

Rows are flagged, not dropped; only payroll loses rows (superseded pay records). Each report is a
single aggregate over the table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.config import (
    CURRENCIES,
    EMPLOYMENT_STATUSES,
    EMPLOYMENT_TYPES,
    HIRE_DATE_MIN,
    PAYROLL_SOURCE_SYSTEM,
    STAFF_A,
    STANDARD_COLUMNS,
    Settings,
)
from rosterweave.functions import ids, text, values
from rosterweave.operators.keep_one import latest
from rosterweave.plans.staging import Stage

RAW = "_raw_"

EMPLOYEE_COLUMNS = [
    "ingest_ordinal", *STANDARD_COLUMNS, "first_name_raw", "last_name_raw", "employee_id_raw",
]
PAYROLL_KEY = ["employee_id", "source"]
PAYROLL_ORDER = ["effective_date", "ingest_ordinal"]


class Cleaned(NamedTuple):
    employees: DataFrame
    payroll: DataFrame
    benefits: DataFrame
    reports: DataFrame


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _unlisted(c: Column, allowed: list[str]) -> Column:
    return c.isNotNull() & ~c.isin(allowed)


def _entries(pairs: dict[str, Column]) -> Column:
    """Map of counters; a null counter is left out."""
    listed = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in pairs.items()])
    return F.map_from_entries(F.filter(listed, lambda e: e["v"].isNotNull()))


def _found(counter: Column) -> Column:
    return F.when(counter > 0, counter)


def _unless(issue: Column, counter: Column) -> Column:
    return F.when(issue == 0, counter)


def _report(
    source: str,
    counted: DataFrame,
    fixes: dict[str, Column],
    issues: dict[str, Column],
    dropped: Column | None = None,
) -> DataFrame:
    n = F.col("n")
    dropped = F.lit(0).cast("long") if dropped is None else dropped
    return counted.select(
        F.lit(source).alias("source"),
        n.alias("input_rows"),
        (n - dropped).alias("output_rows"),
        dropped.alias("rows_dropped"),
        _entries(fixes).alias("fixes_applied"),
        _entries(issues).alias("issues_flagged"),
    )


# --- employees ---------------------------------------------------------------------------------


def employee_steps(aligned: DataFrame, settings: Settings) -> DataFrame:
    """Cleaned columns, the texts some of them came from, and the number of stripped cells."""
    both = aligned.select(
        "ingest_ordinal",
        *[text.strip(F.col(c)).alias(c) for c in STANDARD_COLUMNS],
        *[F.col(c).alias(RAW + c) for c in STANDARD_COLUMNS],
    )
    changed = [
        F.coalesce((F.col(RAW + c) != F.col(c)).cast("int"), F.lit(0)) for c in STANDARD_COLUMNS
    ]
    stripped = both.select(
        "ingest_ordinal", *STANDARD_COLUMNS, values.total_of(changed).alias("_stripped_cells")
    )
    # Alone in its projection: the accent step is the one expression without code generation.
    composed = stripped.withColumns(
        {"_first": text.compose_accents(F.col("first_name")),
         "_last": text.compose_accents(F.col("last_name"))}
    )
    return composed.withColumns(
        {
            "first_name_raw": F.col("first_name"),
            "last_name_raw": F.col("last_name"),
            "employee_id_raw": F.col("employee_id"),
            "_department_in": F.col("department"),
            "first_name": text.name_case(F.col("_first")),
            "last_name": text.name_case(F.col("_last")),
            "employee_id": ids.employee_id(F.col("employee_id"), F.col("source_system")),
            "manager_id": ids.manager_id(F.col("manager_id")),
            "department": text.relabel(F.col("department"), settings.department_map),
            "hire_date": values.parse_hire_date(F.col("hire_date")),
        }
    )


def clean_employees(aligned: DataFrame, settings: Settings) -> DataFrame:
    return employee_steps(aligned, settings).select(*EMPLOYEE_COLUMNS)


def employees_report(steps: DataFrame, settings: Settings) -> DataFrame:
    """Counters of the result of ``employee_steps``."""
    c = F.col
    known = c("_department_in").isin(list(settings.department_map))
    hired = c("hire_date")
    counted = steps.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("_stripped_cells"), F.lit(0)).alias("stripped"),
        (
            count_if(c("first_name") != c("first_name_raw"))
            + count_if(c("last_name") != c("last_name_raw"))
        ).alias("names"),
        count_if(known).alias("mapped"),
        count_if(c("_department_in").isNotNull() & ~known).alias("unmapped"),
        count_if(c("department").isNull()).alias("no_department"),
        count_if(c("country").isNull()).alias("no_country"),
        F.count_if(~F.coalesce(text.is_email(c("email")), F.lit(False))).alias("bad_email"),
        count_if(_unlisted(c("employment_type"), EMPLOYMENT_TYPES)).alias("bad_type"),
        count_if(_unlisted(c("employment_status"), EMPLOYMENT_STATUSES)).alias("bad_status"),
        count_if(hired.isNull()).alias("no_date"),
        count_if(
            (hired < F.lit(HIRE_DATE_MIN)) | (hired > F.lit(settings.report_date))
        ).alias("odd_date"),
    )
    fixes = {
        "whitespace_stripped_cells": _found(c("stripped")),
        "names_normalized": _found(c("names")),
        "employee_ids_namespaced": c("n"),
        "departments_mapped": c("mapped"),
        "hire_date_parsed": _unless(c("no_date"), c("n")),
    }
    issues = {
        "unmapped_department": _found(c("unmapped")),
        "null_department": _found(c("no_department")),
        "null_country": _found(c("no_country")),
        "invalid_email": _found(c("bad_email")),
        "invalid_employment_type": _found(c("bad_type")),
        "invalid_employment_status": _found(c("bad_status")),
        "unparseable_hire_date": _found(c("no_date")),
        "implausible_hire_date": _found(c("odd_date")),
    }
    return _report("clean_employees", counted, fixes, issues)


def unmapped_departments(aligned: DataFrame, settings: Settings) -> DataFrame:
    """Department texts without a standard name, with their row counts."""
    value = text.strip(F.col("department"))
    return (
        aligned.select(value.alias("department"))
        .where(_unlisted(F.col("department"), list(settings.department_map)))
        .groupBy("department")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def nulls_by_source(employees: DataFrame, column: str) -> DataFrame:
    return (
        employees.where(F.col(column).isNull())
        .groupBy("source_system")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# --- payroll -----------------------------------------------------------------------------------


def payroll_steps(payroll: DataFrame, settings: Settings) -> DataFrame:
    """Typed and converted pay records, before the keep-latest step."""
    c = F.col
    typed = payroll.withColumns(
        {
            "_salary_in": c("base_salary"),
            "base_salary": values.parse_salary(c("base_salary")),
            "employee_id": ids.employee_id(
                c("employee_id"), text.relabel(c("source"), PAYROLL_SOURCE_SYSTEM)
            ),
            "effective_date": values.parse_date(c("effective_date")),
        }
    )
    in_usd = typed.withColumn(
        "base_salary_usd", c("base_salary") * text.lookup(c("currency"), settings.fx_rates)
    )
    return in_usd.withColumn(
        "salary_usd_annual",
        c("base_salary_usd") * text.lookup(c("pay_frequency"), settings.pay_periods),
    )


def payroll_ids(payroll: DataFrame) -> DataFrame:
    """Distinct ids as ``clean_payroll`` writes them; each raw id is rewritten once."""
    raw = payroll.select("employee_id", "source").distinct()
    made = ids.employee_id(F.col("employee_id"), text.relabel(F.col("source"), PAYROLL_SOURCE_SYSTEM))
    return raw.select(made.alias("employee_id")).distinct()


def benefit_ids(benefits: DataFrame) -> DataFrame:
    """Distinct ids as ``clean_benefits`` writes them; each raw id is rewritten once."""
    raw = benefits.select("employee_id").distinct()
    return raw.select(ids.employee_id(F.col("employee_id"), F.lit(STAFF_A)).alias("employee_id")).distinct()


def clean_payroll(payroll: DataFrame, settings: Settings) -> DataFrame:
    """Latest pay record per employee and source."""
    steps = payroll_steps(payroll, settings).drop("_salary_in")
    return latest(steps, PAYROLL_KEY, PAYROLL_ORDER)


def payroll_report(
    steps: DataFrame, settings: Settings, kept: DataFrame | None = None
) -> DataFrame:
    """Counters of the result of ``payroll_steps``; ``kept``, the latest of them, if it is stored."""
    c = F.col
    salary = c("base_salary")
    plain = values.parse_number(text.strip(c("_salary_in")))
    # A struct is never null, so a null id or source still counts as a key.
    keys = [] if kept is not None else [F.count_distinct(F.struct(*PAYROLL_KEY)).alias("kept")]
    counted = steps.agg(
        F.count(F.lit(1)).alias("n"),
        *keys,
        count_if(plain.isNull() & salary.isNotNull()).alias("formatted"),
        count_if(salary.isNull()).alias("no_salary"),
        count_if(salary <= 0).alias("not_positive"),
        count_if(_unlisted(c("currency"), CURRENCIES)).alias("bad_currency"),
        count_if(salary.isNotNull() & c("base_salary_usd").isNull()).alias("no_rate"),
        F.count("base_salary_usd").alias("in_usd"),
        count_if(_unlisted(c("pay_frequency"), list(settings.pay_periods))).alias("bad_frequency"),
        F.count("salary_usd_annual").alias("annual"),
        count_if(c("effective_date").isNull()).alias("no_date"),
    )
    if kept is not None:
        counted = counted.crossJoin(kept.agg(F.count(F.lit(1)).alias("kept")))
    dropped = c("n") - c("kept")
    fixes = {
        "salary_symbols_stripped": _found(c("formatted")),
        "payroll_ids_namespaced": c("n"),
        "salary_converted_to_usd": _unless(c("no_rate"), c("in_usd")),
        "salary_usd_annual_computed": _unless(c("bad_frequency"), c("annual")),
        "effective_date_parsed": _unless(c("no_date"), c("n")),
        "payroll_duplicates_removed": _found(dropped),
    }
    issues = {
        "unparseable_salary": _found(c("no_salary")),
        "non_positive_salary": _found(c("not_positive")),
        "invalid_currency": _found(c("bad_currency")),
        "missing_fx_rate": _found(c("no_rate")),
        "unmapped_pay_frequency": _found(c("bad_frequency")),
        "unparseable_effective_date": _found(c("no_date")),
    }
    return _report("clean_payroll", counted, fixes, issues, dropped)


def unlisted_currencies(payroll: DataFrame) -> DataFrame:
    return (
        payroll.where(_unlisted(F.col("currency"), CURRENCIES))
        .groupBy("currency")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# --- benefits ----------------------------------------------------------------------------------


def clean_benefits(benefits: DataFrame) -> DataFrame:
    """Only company A has enrolments, so all ids take its prefix."""
    return benefits.withColumns(
        {
            "employee_id": ids.employee_id(F.col("employee_id"), F.lit(STAFF_A)),
            "enrollment_date": values.parse_date(F.col("enrollment_date")),
        }
    )


def benefits_report(cleaned: DataFrame) -> DataFrame:
    """Counters of the result of ``clean_benefits``."""
    c = F.col
    counted = cleaned.agg(
        F.count(F.lit(1)).alias("n"),
        count_if(c("enrollment_date").isNull()).alias("no_date"),
        count_if(c("premium_employee") < 0).alias("negative_employee"),
        count_if(c("premium_employer") < 0).alias("negative_employer"),
    )
    fixes = {
        "benefits_ids_namespaced": c("n"),
        "enrollment_date_parsed": _unless(c("no_date"), c("n")),
    }
    issues = {
        "unparseable_enrollment_date": _found(c("no_date")),
        "negative_premium_employee": _found(c("negative_employee")),
        "negative_premium_employer": _found(c("negative_employer")),
    }
    return _report("clean_benefits", counted, fixes, issues)


def clean_reports(
    aligned: DataFrame, payroll: DataFrame, benefits: DataFrame, settings: Settings
) -> DataFrame:
    return (
        employees_report(employee_steps(aligned, settings), settings)
        .unionByName(payroll_report(payroll_steps(payroll, settings), settings))
        .unionByName(benefits_report(clean_benefits(benefits)))
    )


def clean_all(
    aligned: DataFrame, payroll: DataFrame, benefits: DataFrame, settings: Settings, stage: Stage
) -> Cleaned:
    """The cleaned tables, stored, and their reports.

    Every source is cleaned once: its steps are stored with the columns that only the counters need,
    and both the table and the counters read them from there. Counters observed while a table is
    written would count the rows of a repeated task twice.
    """
    employee = stage(employee_steps(aligned, settings), "clean_employees")
    paid = stage(payroll_steps(payroll, settings), "payroll_steps")
    enrolled = stage(clean_benefits(benefits), "clean_benefits")
    latest_paid = stage(latest(paid.drop("_salary_in"), PAYROLL_KEY, PAYROLL_ORDER), "clean_payroll")
    reports = employees_report(employee, settings).unionByName(
        payroll_report(paid, settings, latest_paid)
    )
    return Cleaned(
        employee.select(*EMPLOYEE_COLUMNS),
        latest_paid,
        enrolled,
        reports.unionByName(benefits_report(enrolled)),
    )
