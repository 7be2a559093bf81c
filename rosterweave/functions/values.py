"""Dates, money, scores and rounding."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterweave.config import CONFIRM_SCORE, REVIEW_SCORE
from rosterweave.functions.text import strip

# Accepted date layouts.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
SLASH_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\z"
MONTH_NAME_DATE = r"^\d{1,2}-[A-Za-z]{3}-\d{4}\z"

# Letters of what Spark reads as a double but is no plain number: 1.0d, 1f, NaN, inf, 0x1p3.
NOT_A_NUMBER = "[dDfFnNxX]"


def parse_date(c: Column) -> Column:
    """Null unless the whole text is a date in one of the layouts.

    The layout is told by its shape, so no parser runs on text of another layout; a failing
    date formatter costs an exception per row.
    """
    return (
        F.when(c.rlike(ISO_DATE), c.try_cast("date"))
        .when(c.rlike(SLASH_DATE), F.regexp_replace(c, SLASH_DATE, "$3-$1-$2").try_cast("date"))
        .when(c.rlike(MONTH_NAME_DATE), F.try_to_date(c, "d-MMM-yyyy"))
    )


def parse_hire_date(c: Column) -> Column:
    """As ``parse_date``; of a longer text that is no date its first ten characters count."""
    whole = F.when(c.rlike(MONTH_NAME_DATE), c).otherwise(F.substring(c, 1, 10))
    return parse_date(whole)


def parse_number(c: Column) -> Column:
    return F.when(~c.rlike(NOT_A_NUMBER), c.try_cast("double"))


def parse_salary(c: Column) -> Column:
    """Currency signs and commas may stand anywhere."""
    return parse_number(strip(F.translate(c, "$£€,", "")))


def tenure_years(hire_date: Column, report_date: dt.date) -> Column:
    days = F.date_diff(F.lit(report_date), hire_date)
    return F.bround(days / F.lit(365.25), 2)


def recommended_action(score: Column) -> Column:
    return (
        F.when(score >= CONFIRM_SCORE, "CONFIRM_MERGE")
        .when(score >= REVIEW_SCORE, "MANUAL_REVIEW")
        .otherwise("REJECT")
    )


def pass_rate(passed: Column, total: Column) -> Column:
    return F.coalesce(F.bround(F.try_divide(passed.cast("double"), total), 6), F.lit(0.0))


def total_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
