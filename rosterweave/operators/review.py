"""Audit extracts for people to look at, and the derived columns of the golden table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.config import COMPANY_ORIGIN, STANDARD_COLUMNS, Settings
from rosterweave.functions import values
from rosterweave.functions.text import full_name, lookup, strip

GOLDEN_COLUMNS = [
    *STANDARD_COLUMNS, "first_name_raw", "last_name_raw", "source_systems", "dedup_method",
    "company_origin", "full_name", "tenure_years",
]


def golden_employees(employees: DataFrame, settings: Settings) -> DataFrame:
    origin = F.coalesce(lookup(F.col("source_system"), COMPANY_ORIGIN), F.lit("Unknown"))
    return employees.withColumns(
        {
            "company_origin": origin,
            "full_name": full_name(F.col("first_name"), F.col("last_name")),
            "tenure_years": values.tenure_years(F.col("hire_date"), settings.report_date),
        }
    ).select(*GOLDEN_COLUMNS)


def ghost_report(ghosts: DataFrame) -> DataFrame:
    return ghosts.select(
        F.col("employee_id").alias("payroll_employee_id"),
        F.lit("Unknown — no HRIS record").alias("name"),
        F.bround("salary_usd_annual", 2).alias("salary_usd_annual"),
        F.concat(
            F.lit("Payroll record (source: "),
            F.col("source"),
            F.lit(") has no matching employee_id in HRIS"),
        ).alias("ghost_flag_reason"),
    )


def match_review(pairs: DataFrame) -> DataFrame:
    c = F.col
    return pairs.select(
        c("acq_employee_id").alias("record_1_id"),
        strip(c("acq_full_name")).alias("record_1_name"),
        c("acq_hire_date").alias("record_1_hire_date"),
        c("acq_email").alias("record_1_email"),
        c("gt_employee_id").alias("record_2_id"),
        strip(c("gt_full_name")).alias("record_2_name"),
        c("gt_hire_date").alias("record_2_hire_date"),
        c("gt_email").alias("record_2_email"),
        F.bround("match_score", 2).alias("similarity_score"),
        c("hire_date_delta_days").alias("hire_date_diff_days"),
        values.recommended_action(c("match_score")).alias("recommended_action"),
    )
