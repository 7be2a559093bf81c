"""The de-duplication passes in order."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from rosterweave.config import Settings
from rosterweave.operators import fuzzy, identity
from rosterweave.operators.keep_one import split_latest
from rosterweave.plans.staging import Stage

BENEFITS_KEY = ["employee_id", "plan_type"]
BENEFITS_ORDER = ["enrollment_date", "ingest_ordinal"]


class Resolved(NamedTuple):
    employees: DataFrame
    payroll: DataFrame
    benefits: DataFrame
    benefits_history: DataFrame
    id_quarantine: DataFrame
    email_quarantine: DataFrame
    probable_matches: DataFrame
    ghost_employees: DataFrame
    reports: DataFrame


class ExactPasses(NamedTuple):
    employees: DataFrame
    id_quarantine: DataFrame
    email_quarantine: DataFrame
    reports: DataFrame


def exact_passes(
    employees: DataFrame,
    payroll: DataFrame,
    benefits: DataFrame,
    settings: Settings,
    stage: Stage,
) -> ExactPasses:
    """Passes 1 and 2. Their results are stored, as all that follows reads them repeatedly."""
    resolved = stage(
        identity.resolve_ids(employees, payroll, benefits, settings), "resolved_ids"
    )
    kept = identity.kept_rows(resolved)
    # Stored first, so that Spark knows its size when it plans the join.
    shared = stage(identity.cross_emails(kept), "cross_emails")
    flagged = stage(identity.flag_cross_emails(kept, shared, settings), "flagged_emails")
    emails = identity.split_cross_emails(flagged)
    return ExactPasses(
        emails.employees,
        identity.colliding_rows(employees, resolved, settings),
        emails.quarantine,
        identity.ids_report(resolved).unionByName(emails.report),
    )


def resolve_all(
    employees: DataFrame,
    payroll: DataFrame,
    benefits: DataFrame,
    settings: Settings,
    stage: Stage,
    benefits_order: list[str] | None = None,
    benefits_row_id: list[str] | None = None,
) -> Resolved:
    exact = exact_passes(employees, payroll, benefits, settings, stage)
    names = stage(fuzzy.similar_names(exact.employees, settings), "similar_names")
    pairs = stage(fuzzy.probable_matches(exact.employees, names, settings), "probable_matches")
    final = stage(fuzzy.flag_fuzzy(exact.employees, pairs), "employees")
    ghosts = identity.ghost_employees(payroll, final)
    plans = split_latest(
        benefits, BENEFITS_KEY, benefits_order or BENEFITS_ORDER, benefits_row_id, stage
    )
    reports = (
        exact.reports.unionByName(fuzzy.fuzzy_report(exact.employees, pairs, settings))
        .unionByName(
            identity.ghosts_report(payroll, ghosts, identity.unpaid_employees(payroll, final))
        )
    )
    return Resolved(
        final,
        payroll,
        plans.current,
        plans.history,
        exact.id_quarantine,
        exact.email_quarantine,
        pairs,
        ghosts,
        reports,
    )
