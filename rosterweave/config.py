"""Fixed values of the record-integration job and the settings that vary per run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

# --- fixed values: labels, lookup tables, patterns and bounds that results depend on ---

STAFF_A = "GlobalTech_HRIS"
STAFF_B = "AcquiredCo_HRIS"
PAYROLL = "Payroll_ADP"
BENEFITS = "Benefits_MedShield"

# Label used inside the payroll extract -> staff system it stands for.
PAYROLL_SOURCE_SYSTEM = {"GlobalTech": STAFF_A, "AcquiredCo": STAFF_B}
COMPANY_ORIGIN = {STAFF_A: "GlobalTech", STAFF_B: "AcquiredCo"}
ID_PREFIX = {STAFF_A: "GT", STAFF_B: "AC"}
UNKNOWN_PREFIX = "XX"

STANDARD_COLUMNS = [
    "employee_id", "source_system", "first_name", "last_name", "email", "department",
    "job_title", "hire_date", "country", "employment_type", "employment_status", "manager_id",
]

EMPLOYMENT_TYPE_CODES = {"FT": "Full-Time", "PT": "Part-Time", "CONTRACTOR": "Contractor"}
EMPLOYMENT_TYPES = ["Full-Time", "Part-Time", "Contractor"]
EMPLOYMENT_STATUSES = ["Active", "Inactive", "On Leave"]
CURRENCIES = ["USD", "EUR", "GBP"]

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EMPLOYEE_ID_PATTERN = r"^(GT|AC)-\d{6}$"

FX_RATES_TO_USD = {"USD": 1.00, "EUR": 1.08}
PAY_PERIODS_PER_YEAR = {"Annual": 1, "Monthly": 12, "Bi-Weekly": 26}

DEPARTMENTS = [
    "Business Development", "Communications", "Customer Success", "Data Science", "DevOps",
    "Engineering", "Finance", "Human Resources", "Information Technology", "Legal",
    "Manufacturing", "Marketing", "Operations", "Product", "Quality Assurance", "Sales",
    "Strategy", "Supply Chain",
]
LEGACY_DEPARTMENT_CODES = {
    "ENG-01": "Engineering", "MKT-03": "Marketing", "HR-02": "Human Resources",
    "FIN-01": "Finance", "OPS-04": "Operations", "IT-05": "Information Technology",
}

HIRE_DATE_MIN = dt.date(1970, 1, 1)
SALARY_MIN, SALARY_MAX = 15_000, 2_000_000
MAX_FAILED_CHECKS = 2

MATCH_THRESHOLD = 88
MATCH_WINDOW_DAYS = 30
CONFIRM_SCORE, REVIEW_SCORE = 95, 88

# Cell texts a pandas table reader takes as missing (its documented defaults).
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- end of fixed values ---

# Rows a single key may hold, or joined rows it may make, before a join slices it.
HEAVY_ROWS = 1_000_000


@dataclass(frozen=True)
class Settings:
    """What a run may vary. The report date is always given, never the run day."""

    report_date: dt.date
    fx_rates: Mapping[str, float] = field(default_factory=lambda: dict(FX_RATES_TO_USD))
    pay_periods: Mapping[str, int] = field(default_factory=lambda: dict(PAY_PERIODS_PER_YEAR))
    department_map: Mapping[str, str] = field(
        default_factory=lambda: {d: d for d in DEPARTMENTS} | LEGACY_DEPARTMENT_CODES
    )
    match_threshold: int = MATCH_THRESHOLD
    match_window_days: int = MATCH_WINDOW_DAYS
    copy_marker_column: str = "first_name_raw"
    copy_marker: str = "dup"
    max_failed_checks: int = MAX_FAILED_CHECKS
    heavy_rows: int = HEAVY_ROWS
