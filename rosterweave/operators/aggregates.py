"""Workforce figures: the tables behind the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.config import EMPLOYMENT_TYPES, STAFF_A, STAFF_B
from rosterweave.operators.identity import staff_of
from rosterweave.operators.quantiles import exact_quantiles
from rosterweave.plans.staging import Stage

NO_DEPARTMENT = "(no department)"
DAYS_PER_YEAR = 365.25
TENURE_BINS = 35


def _count(column: str = "employee_id"):
    return F.count(column)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def headcount_by_department(employees: DataFrame) -> DataFrame:
    return (
        employees.groupBy("department")
        .agg(_count().alias("headcount"))
        .select(F.coalesce("department", F.lit(NO_DEPARTMENT)).alias("department"), "headcount")
        .orderBy("headcount", "department")
    )


def headcount_by_country(employees: DataFrame, top: int = 20) -> DataFrame:
    """The countries with most people; equal counts by name."""
    return (
        employees.where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("headcount"))
        .orderBy(F.col("headcount").desc(), "country")
        .limit(top)
    )


def headcount_by_company(employees: DataFrame) -> DataFrame:
    system = F.col("source_system")
    return employees.agg(
        F.count(F.lit(1)).alias("employees"),
        F.count_if(system == STAFF_A).alias("company_a"),
        F.count_if(system == STAFF_B).alias("company_b"),
    )


def matched_salaries(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Annual salary next to the employment type, where both are known."""
    types = employees.select("employee_id", "employment_type").where(
        F.col("employment_type").isNotNull()
    )
    paid = payroll.select("employee_id", "salary_usd_annual").where(
        F.col("salary_usd_annual").isNotNull()
    )
    return paid.join(types, "employee_id")


def matched_total(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Number of all matched pay records, whatever their type."""
    return matched_salaries(payroll, employees).agg(F.count(F.lit(1)).alias("matched_records"))


def salary_distribution(
    payroll: DataFrame, employees: DataFrame, stage: Stage | None = None
) -> DataFrame:
    """Box figures per employment type of the allow-list."""
    salaries = matched_salaries(payroll, employees).where(
        F.col("employment_type").isin(EMPLOYMENT_TYPES)
    )
    box = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return exact_quantiles(salaries, "employment_type", "salary_usd_annual", box, stage)


def salary_histogram(payroll: DataFrame, employees: DataFrame, step: float = 0.1) -> DataFrame:
    """Counts on a log10 scale; salaries that are not positive have no place on it."""
    salary = F.col("salary_usd_annual")
    return (
        matched_salaries(payroll, employees)
        .where(F.col("employment_type").isin(EMPLOYMENT_TYPES) & (salary > 0))
        .groupBy("employment_type", F.floor(F.log10(salary) / step).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _days_of_service(employees: DataFrame, report_date: dt.date) -> DataFrame:
    """Number of people per day count. A calendar has few days, so this stays small."""
    days = F.date_diff(F.lit(report_date), F.col("hire_date"))
    return (
        employees.select(days.alias("days"))
        .where("days >= 0")
        .groupBy("days")
        .agg(F.count(F.lit(1)).alias("people"))
    )


def tenure_stats(employees: DataFrame, report_date: dt.date) -> DataFrame:
    """n, min, max, mean, median and sample deviation, in years.

    Sums are exact integers over days, so neither their order nor cancellation matters.
    """
    days, people = F.col("days"), F.col("people").cast("decimal(19,0)")
    sums = _days_of_service(employees, report_date).agg(
        F.sum("people").alias("n"),
        F.min("days").alias("min"),
        F.max("days").alias("max"),
        F.sum((people * days).cast("decimal(38,0)")).cast("double").alias("s1"),
        F.sum((people * days * days).cast("decimal(38,0)")).cast("double").alias("s2"),
        F.percentile("days", F.lit(0.5), F.col("people")).alias("median"),
    )
    n = F.col("n")
    mean = F.col("s1") / n
    variance = F.try_divide(F.col("s2") - F.col("s1") * mean, n - 1)

    def years(c):
        return c / F.lit(DAYS_PER_YEAR)

    return sums.select(
        "n",
        years(F.col("min")).alias("min_years"),
        years(F.col("max")).alias("max_years"),
        years(mean).alias("mean_years"),
        years(F.col("median")).alias("median_years"),
        years(F.sqrt(variance)).alias("std_years"),
    )


def tenure_histogram(employees: DataFrame, report_date: dt.date, bins: int = TENURE_BINS) -> DataFrame:
    """Equal-width bins over the tenure range, the last one closed. Empty bins are listed."""
    per_day = _days_of_service(employees, report_date)
    # At most one row per calendar day reaches the window.
    whole = Window.partitionBy(F.lit(0))
    placed = per_day.withColumns(
        {"lo": F.min("days").over(whole), "hi": F.max("days").over(whole)}
    ).withColumn(
        "bin",
        F.when(F.col("lo") == F.col("hi"), bins // 2).otherwise(
            F.least(
                F.expr(f"(days - lo) * {bins}L div (hi - lo)").cast("int"), F.lit(bins - 1)
            )
        ),
    )
    counted = placed.groupBy("bin").agg(
        F.sum("people").alias("people"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    # A range of zero width is widened by half a year each way.
    flat = F.col("lo") == F.col("hi")
    low = F.col("lo") / DAYS_PER_YEAR - F.when(flat, 0.5).otherwise(0.0)
    width = F.when(flat, 1.0).otherwise((F.col("hi") - F.col("lo")) / DAYS_PER_YEAR) / bins
    edges = counted.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        low.alias("low"),
        width.alias("width"),
    )
    return (
        edges.where(F.col("low").isNotNull())
        .join(counted.select("bin", "people"), "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("from_years"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("to_years"),
            F.coalesce("people", F.lit(0)).alias("employees"),
        )
    )


def enrollment_rate(employees: DataFrame, benefits: DataFrame) -> DataFrame:
    """Share of company A staff with an enrolment, per department.

    Enrolled ids are made distinct before the join, so one person's many enrolments cost nothing.
    Enrolments of unknown people fall to the null department, as a left join makes them.
    """
    staff = staff_of(employees, STAFF_A)
    headcount = staff.groupBy("department").agg(_count().alias("headcount"))
    enrolled_ids = benefits.where(F.col("employee_id").isNotNull()).select("employee_id").distinct()
    departments = staff.where(F.col("employee_id").isNotNull()).select(
        "employee_id", "department"
    ).distinct()
    enrolled = (
        enrolled_ids.join(departments, "employee_id", "left")
        .groupBy(F.col("department").alias("enrolled_department"))
        .agg(F.count(F.lit(1)).alias("enrolled"))
    )
    rate = F.coalesce(
        F.try_divide(F.col("enrolled"), F.col("headcount")) * 100, F.lit(0.0)
    )
    return (
        headcount.join(
            enrolled, F.col("department").eqNullSafe(F.col("enrolled_department")), "full"
        )
        .select(
            F.coalesce("department", "enrolled_department", F.lit(NO_DEPARTMENT)).alias(
                "department"
            ),
            F.coalesce("enrolled", F.lit(0)).alias("enrolled"),
            F.coalesce("headcount", F.lit(0)).alias("headcount"),
            rate.alias("rate_percent"),
            (rate >= 50).alias("at_least_half"),
        )
        .orderBy("rate_percent", "department")
    )


def check_bars(report: DataFrame) -> DataFrame:
    """Passed and failed per check; no failure is drawn as 0.5 on a log axis."""
    failed = F.col("failed").cast("double")
    return report.select(
        "check_no",
        "check",
        F.col("passed").cast("double").alias("passed"),
        failed.alias("failed"),
        F.when(failed == 0, 0.5).otherwise(failed).alias("failed_bar"),
        "status",
    )
