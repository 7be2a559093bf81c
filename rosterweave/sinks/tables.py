"""Golden table, audit extracts, reports and figures."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.config import Settings
from rosterweave.operators import aggregates, quality, review
from rosterweave.sinks.dictionary import GOLDEN_SCHEMA, data_dictionary
from rosterweave.sources.common import dead_letter_summary

if TYPE_CHECKING:
    from rosterweave.plans.resolve import Resolved
    from rosterweave.plans.staging import Stage

# Splits what one task writes to a company folder, so a large company is many files.
MAX_RECORDS_PER_FILE = 20_000_000


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def documented(golden: DataFrame) -> DataFrame:
    """Types and column comments of the schema; the hire date is a time stamp without a zone."""
    return golden.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in GOLDEN_SCHEMA]
    )


def write_golden(employees: DataFrame, settings: Settings, out: str) -> str:
    """One folder per company. No shuffle: few companies would mean as few tasks."""
    path = f"{out}/golden_employees"
    (
        documented(review.golden_employees(employees, settings))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("company_origin")
        .parquet(path)
    )
    return path


def write_dictionary(spark: SparkSession, out: str) -> str:
    path = f"{out}/golden_employees_schema"
    _csv(data_dictionary(spark), path)
    return path


def write_ghosts(ghosts: DataFrame, out: str) -> str:
    path = f"{out}/ghost_employees"
    _csv(review.ghost_report(ghosts), path)
    return path


def write_match_review(pairs: DataFrame, out: str) -> str:
    """Best matches first; the ids in the sort keep equal scores from filling one task."""
    path = f"{out}/probable_matches_review"
    best_first = [F.col("similarity_score").desc(), "record_1_id", "record_2_id"]
    _csv(review.match_review(pairs).orderBy(*best_first), path)
    return path


def export_all(resolved: Resolved, settings: Settings, out: str) -> dict[str, str]:
    paths = {
        "golden": write_golden(resolved.employees, settings, out),
        "dictionary": write_dictionary(resolved.employees.sparkSession, out),
        "ghosts": write_ghosts(resolved.ghost_employees, out),
        "probable_matches": write_match_review(resolved.probable_matches, out),
    }
    for name in ("id_quarantine", "email_quarantine", "benefits", "benefits_history"):
        paths[name] = f"{out}/{name}"
        _parquet(getattr(resolved, name), paths[name])
    return paths


def write_quality_report(report: DataFrame, settings: Settings, out: str) -> None:
    """One row per check, so one file."""
    _csv(report.orderBy("check_no").drop("check_no").coalesce(1), f"{out}/validation_report")
    _csv(
        quality.summary(report, settings.max_failed_checks).coalesce(1),
        f"{out}/validation_summary",
    )


def write_stage_reports(
    ingest_report: DataFrame, clean_reports: DataFrame, pass_reports: DataFrame, out: str
) -> None:
    _parquet(ingest_report.coalesce(1), f"{out}/reports/ingest")
    _parquet(clean_reports.coalesce(1), f"{out}/reports/clean")
    _parquet(pass_reports.coalesce(1), f"{out}/reports/passes")


def write_dead_letters(dead_letters: DataFrame, out: str) -> None:
    _parquet(dead_letters, f"{out}/dead_letters")
    _parquet(dead_letter_summary(dead_letters), f"{out}/dead_letter_summary")


def figures(
    resolved: Resolved, report: DataFrame, settings: Settings, stage: Stage | None = None
) -> dict[str, DataFrame]:
    emp, pay, ben = resolved.employees, resolved.payroll, resolved.benefits
    return {
        "headcount_company": aggregates.headcount_by_company(emp),
        "headcount_department": aggregates.headcount_by_department(emp),
        "headcount_country": aggregates.headcount_by_country(emp),
        "salary_distribution": aggregates.salary_distribution(pay, emp, stage),
        "salary_matched_total": aggregates.matched_total(pay, emp),
        "salary_histogram": aggregates.salary_histogram(pay, emp),
        "tenure_stats": aggregates.tenure_stats(emp, settings.report_date),
        "tenure_histogram": aggregates.tenure_histogram(emp, settings.report_date),
        "enrollment_rate": aggregates.enrollment_rate(emp, ben),
        "check_bars": aggregates.check_bars(report),
    }


def write_figures(
    resolved: Resolved,
    report: DataFrame,
    settings: Settings,
    out: str,
    stage: Stage | None = None,
) -> None:
    for name, table in figures(resolved, report, settings, stage).items():
        _parquet(table, f"{out}/figures/{name}")
