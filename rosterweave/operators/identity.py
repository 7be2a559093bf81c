"""Passes over exact identity: duplicated ids, e-mails shared by both companies, orphans."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.config import STAFF_A, STAFF_B, Settings
from rosterweave.functions.text import slug
from rosterweave.operators.reports import counters, pass_report
from rosterweave.operators.skew import own_key, spread_join

ORDINAL = "ingest_ordinal"
ROWS, SAME_PERSON, CROSS_EMAIL = "_rows", "_same_person", "_cross_email"


class Pass(NamedTuple):
    employees: DataFrame
    quarantine: DataFrame
    report: DataFrame


def _known_ids(df: DataFrame, flag: str) -> DataFrame:
    return df.select("employee_id").distinct().withColumn(flag, F.lit(True))


# --- pass 1: one row per employee id -----------------------------------------------------------


def resolve_ids(
    employees: DataFrame, payroll: DataFrame, benefits: DataFrame, settings: Settings
) -> DataFrame:
    """One row per id with provenance, the group size and whether the group is one person.

    Ids are counted by an aggregate over names and ordinals only, so a heavy id is combined before
    the shuffle. The id stays the partitioning of both provenance joins, and the ordinal of the
    row to keep then fetches that row: whole rows are shuffled once, by a key that none shares.
    Rows without an id are no group: each takes a key of its own, which also spreads them.
    """
    columns = [c for c in employees.columns if c != "employee_id"]
    marked = F.coalesce(
        F.lower(settings.copy_marker_column).contains(settings.copy_marker), F.lit(False)
    )
    grouped = (
        employees.withColumn("_id", own_key("employee_id"))
        .groupBy("_id")
        .agg(
            F.count(F.lit(1)).alias(ROWS),
            # Nulls are ignored, and a group without any name is not one person.
            F.coalesce(
                (F.min("first_name") == F.max("first_name"))
                & (F.min("last_name") == F.max("last_name")),
                F.lit(False),
            ).alias(SAME_PERSON),
            F.min(ORDINAL).alias("_first"),
            F.min(F.when(~marked, F.col(ORDINAL))).alias("_first_unmarked"),
        )
    )
    kept = F.when(F.col(SAME_PERSON), F.col("_first")).otherwise(
        F.coalesce("_first_unmarked", "_first")
    )
    one_each = grouped.select("_id", ROWS, SAME_PERSON, kept.alias("_kept"))
    sources = F.concat_ws(
        ",",
        F.sort_array(
            F.array(
                slug(F.col("source_system")),
                F.when(F.col("_in_payroll"), "payroll"),
                F.when(F.col("_in_benefits"), "benefits"),
            )
        ),
    )
    known = one_each.join(
        _known_ids(payroll, "_in_payroll").withColumnRenamed("employee_id", "_id"), "_id", "left"
    ).join(
        _known_ids(benefits, "_in_benefits").withColumnRenamed("employee_id", "_id"), "_id", "left"
    )
    return (
        employees.join(known, F.col(ORDINAL) == F.col("_kept"))
        .select("employee_id", *columns, ROWS, SAME_PERSON, sources.alias("source_systems"))
        .withColumn(
            "dedup_method",
            F.when(F.col("source_systems").contains(","), "exact_id").otherwise("single_source"),
        )
    )


def _collides() -> Column:
    return (F.col(ROWS) > 1) & ~F.col(SAME_PERSON)


def colliding_rows(employees: DataFrame, resolved: DataFrame, settings: Settings) -> DataFrame:
    """Rows that share an id with a different person and were not the one kept."""
    groups = resolved.where(_collides()).select(
        "employee_id", F.col(ORDINAL).alias("_kept_ordinal"), F.col(ROWS).alias("n")
    )
    return (
        spread_join(
            employees,
            groups.drop("n"),
            ["employee_id"],
            groups.select("employee_id", "n"),
            ORDINAL,
            heavy_rows=settings.heavy_rows,
        )
        .where(F.col(ORDINAL) != F.col("_kept_ordinal"))
        .select(*employees.columns, F.lit("ID_COLLISION").alias("quarantine_reason"))
    )


def ids_report(resolved: DataFrame) -> DataFrame:
    extra = F.col(ROWS) - 1

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    counted = resolved.agg(
        total(F.col(ROWS)).alias("input_rows"),
        F.count(F.lit(1)).alias("output_rows"),
        total(F.when(F.col(SAME_PERSON), extra)).alias("rows_removed"),
        total(F.when(~F.col(SAME_PERSON), extra)).alias("rows_quarantined"),
        F.count_if(F.col("source_systems").contains(",")).alias("multi"),
    )
    return pass_report(
        "pass1_exact_id",
        counted,
        {
            "intra_hris_same_person_removed": F.col("rows_removed"),
            "intra_hris_id_collision_quarantined": F.col("rows_quarantined"),
            "multi_source_employees": F.col("multi"),
        },
    )


def kept_rows(resolved: DataFrame) -> DataFrame:
    return resolved.drop(ROWS, SAME_PERSON)


# --- pass 2: e-mail used in both companies -----------------------------------------------------


def cross_emails(employees: DataFrame) -> DataFrame:
    """E-mails seen under more than one source system, with the number of rows that use them.

    Source systems are a handful of labels, so comparing their hashes is safe, and it keeps the
    aggregate a hash aggregate.
    """
    system = F.xxhash64("source_system")
    return (
        employees.where(F.col("email").isNotNull())
        .groupBy("email")
        .agg(F.min(system).alias("_lo"), F.max(system).alias("_hi"), F.count(F.lit(1)).alias("n"))
        .where("_lo <> _hi")
        .select("email", "n")
    )


def flag_cross_emails(
    employees: DataFrame, shared: DataFrame, settings: Settings
) -> DataFrame:
    """Whether the e-mail of a row is one of ``shared`` (see ``cross_emails``)."""
    flags = shared.select(F.col("email").alias("_email"), F.lit(True).alias(CROSS_EMAIL))
    flagged = spread_join(
        employees.withColumn("_email", own_key("email")),
        flags,
        ["_email"],
        shared.select(F.col("email").alias("_email"), "n"),
        ORDINAL,
        how="left",
        heavy_rows=settings.heavy_rows,
    )
    return flagged.select(
        *employees.columns, F.coalesce(CROSS_EMAIL, F.lit(False)).alias(CROSS_EMAIL)
    )


def _quarantined() -> Column:
    return F.col(CROSS_EMAIL) & (F.col("source_system") == STAFF_B)


def split_cross_emails(flagged: DataFrame) -> Pass:
    """Rows of company B go to quarantine, the other rows with the e-mail are marked."""
    columns = [c for c in flagged.columns if c != CROSS_EMAIL]
    quarantine = flagged.where(_quarantined()).select(
        *columns, F.lit("EMAIL_MATCH_CROSS_COMPANY").alias("quarantine_reason")
    )
    kept = flagged.where(~_quarantined()).withColumn(
        "dedup_method", F.when(F.col(CROSS_EMAIL), "email_match").otherwise(F.col("dedup_method"))
    )
    counted = flagged.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(_quarantined()).alias("rows_removed"),
        F.count_distinct(F.when(F.col(CROSS_EMAIL), F.col("email"))).alias("emails"),
    ).withColumns(
        {
            "output_rows": F.col("input_rows") - F.col("rows_removed"),
            "rows_quarantined": F.col("rows_removed"),
        }
    )
    report = pass_report(
        "pass2_email_match",
        counted,
        {
            "cross_company_email_matches": F.col("emails"),
            "acqco_rows_removed": F.col("rows_removed"),
        },
    )
    return Pass(kept.select(*columns), quarantine, report)


# --- orphans -----------------------------------------------------------------------------------


def ghost_employees(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Pay records whose employee is in no staff master."""
    known = employees.where(F.col("employee_id").isNotNull()).select("employee_id").distinct()
    return payroll.join(known, "employee_id", "left_anti").withColumn(
        "ghost_employee", F.lit(True)
    )


def unpaid_employees(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Ids of the staff masters without a pay record."""
    ids = employees.where(F.col("employee_id").isNotNull()).select("employee_id").distinct()
    paid = payroll.select("employee_id").distinct()
    return ids.join(paid, "employee_id", "left_anti")


def ghosts_report(payroll: DataFrame, ghosts: DataFrame, unpaid: DataFrame) -> DataFrame:
    counted = counters(
        {
            "input_rows": payroll.agg(F.count(F.lit(1)).alias("value")),
            "rows_quarantined": ghosts.agg(F.count(F.lit(1)).alias("value")),
            "unpaid": unpaid.agg(F.count(F.lit(1)).alias("value")),
        }
    ).withColumns(
        {
            "output_rows": F.col("input_rows") - F.col("rows_quarantined"),
            "rows_removed": F.lit(0).cast("long"),
        }
    )
    return pass_report(
        "ghost_employee_detection",
        counted,
        {
            "ghost_employees_detected": F.col("rows_quarantined"),
            "hris_employees_not_in_payroll": F.col("unpaid"),
        },
    )


def staff_of(employees: DataFrame, system: str = STAFF_A) -> DataFrame:
    return employees.where(F.col("source_system") == system)
