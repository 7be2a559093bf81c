"""Namespaced employee and manager ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterweave.config import ID_PREFIX, STAFF_A, STAFF_B, UNKNOWN_PREFIX
from rosterweave.functions.text import lookup

def _number_or_raw(c: Column) -> Column:
    """Digits at the end without leading zeros but at least six, or the text if it has none.

    Kept as text, so numbers of any length survive and padding never cuts a longer one. The zeros
    put in front are taken off again down to six digits. Text of digits alone is padded or kept
    without a pattern.
    """
    digits = (c != "") & (F.translate(c, "0123456789", "") == "")
    padded = F.regexp_replace(c, r"(\d+)$", "000000$1")
    return (
        F.when(digits & (F.length(c) <= 6), F.lpad(c, 6, "0"))
        .when(digits & (c >= "1"), c)
        .otherwise(F.regexp_replace(padded, r"(?s)^.*?0*(\d{6,})\n?\z", "$1"))
    )


def employee_id(raw: Column, source_system: Column) -> Column:
    prefix = F.coalesce(lookup(source_system, ID_PREFIX), F.lit(UNKNOWN_PREFIX))
    return F.concat(prefix, F.lit("-"), _number_or_raw(raw))


def manager_id(text: Column) -> Column:
    """Manager references carry no source system; the (stripped) text itself shows the company."""
    prefix = F.when(F.upper(text).startswith("ACQ"), ID_PREFIX[STAFF_B]).otherwise(
        ID_PREFIX[STAFF_A]
    )
    return (
        F.when(text.isNull() | text.isin("", "nan"), "")
        .when(text.rlike(r"\d$"), F.concat(prefix, F.lit("-"), _number_or_raw(text)))
        .otherwise(text)
    )
