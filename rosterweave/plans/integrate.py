"""End to end: sources in, golden table and audit extracts out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from rosterweave.config import Settings
from rosterweave.operators import clean, quality
from rosterweave.plans.ingest import Ingested, Sources, ingest_all
from rosterweave.plans.resolve import Resolved, resolve_all
from rosterweave.plans.staging import Stage
from rosterweave.sinks import tables


class Outcome(NamedTuple):
    passed: bool
    exported: bool
    report: DataFrame
    ingested: Ingested
    resolved: Resolved
    clean_reports: DataFrame


def validate_all(resolved: Resolved, settings: Settings) -> DataFrame:
    return quality.quality_report(
        {"employees": resolved.employees, "payroll": resolved.payroll},
        quality.default_checks(settings),
    )


def integrate(
    spark: SparkSession,
    sources: Sources,
    out: str,
    settings: Settings,
    respect_gate: bool = True,
    stage: Stage | None = None,
) -> Outcome:
    """Run the job. A failed gate stops it after the report unless ``respect_gate`` is off."""
    stage = stage or Stage(spark)
    ingested = ingest_all(spark, sources, stage)
    cleaned = clean.clean_all(
        ingested.employees, ingested.payroll, ingested.benefits, settings, stage
    )
    resolved = resolve_all(cleaned.employees, cleaned.payroll, cleaned.benefits, settings, stage)
    report = stage(validate_all(resolved, settings), "quality_report")
    tables.write_quality_report(report, settings, out)
    tables.write_stage_reports(ingested.report, cleaned.reports, resolved.reports, out)
    tables.write_dead_letters(ingested.dead_letters, out)

    passed = quality.gate(report, settings.max_failed_checks)
    exported = passed or not respect_gate
    if exported:
        tables.write_figures(resolved, report, settings, out, stage)
        tables.export_all(resolved, settings, out)
    return Outcome(passed, exported, report, ingested, resolved, cleaned.reports)
