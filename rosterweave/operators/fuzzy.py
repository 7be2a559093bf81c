"""Pass 3: probable same persons of both companies, by similar name and close hire date.

Comparing everybody hired around the same time grows with the square of a busy day. Instead:

1. Names are compared, not rows: each distinct token-sorted name enters once per date bucket, so
   copies of a name or a busy hire date do not multiply the work.
2. Two names meet only if they share a segment (``functions.similarity``), which every pair that
   reaches the threshold does, or, below a threshold of 67, are of lengths that may match. The
   join is an equi-join on bucket and segment, with both sides of a heavy key cut in slices.
3. A Levenshtein bound, which rejects no match, leaves few pairs for the exact score.
4. Matched name pairs are joined back to the rows. What this emits is the result itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.config import HEAVY_ROWS, STAFF_A, STAFF_B, Settings
from rosterweave.functions import similarity
from rosterweave.functions.text import full_name
from rosterweave.operators.identity import staff_of
from rosterweave.operators.reports import counters, pass_report
from rosterweave.operators.skew import dealt, own_key, spread_join

ORDINAL = "ingest_ordinal"
SEGMENT = "_segment"

PAIR_COLUMNS = [
    "acq_employee_id", "gt_employee_id", "acq_full_name", "gt_full_name", "match_score",
    "acq_hire_date", "gt_hire_date", "hire_date_delta_days", "acq_email", "gt_email",
    "acq_country", "gt_country",
]


def _side(employees: DataFrame, system: str) -> DataFrame:
    name = full_name(F.col("first_name"), F.col("last_name"))
    return (
        staff_of(employees, system)
        .select(ORDINAL, "employee_id", name.alias("full_name"), "hire_date", "email", "country")
        .where(F.col("full_name").isNotNull() & F.col("hire_date").isNotNull())
        .withColumn("name_key", similarity.token_sorted(F.col("full_name")))
    )


def _bucket(days: Column, width: int) -> Column:
    return F.floor(days / width).cast("int")


def _own_bucket(day: Column, width: int) -> Column:
    return _bucket(F.unix_date(day), width)


def _near_buckets(day: Column, width: int) -> Column:
    """Buckets a partner within the window can be in; the bucket is as wide as the window."""
    return F.sequence(
        _bucket(F.unix_date(day) - width, width), _bucket(F.unix_date(day) + width, width)
    )


def _bucket_width(settings: Settings) -> int:
    return max(settings.match_window_days, 1)


def _meeting(names_a: DataFrame, names_b: DataFrame, a: DataFrame, b: DataFrame, heavy_rows: int) -> DataFrame:
    """The exploded sides joined on bucket and segment, both cut where a key makes very many pairs.

    No key makes more pairs than its bucket, so keys are only counted if some bucket is heavy.
    """
    key, many = ["bucket", SEGMENT], F.count(F.lit(1))
    per_bucket = names_a.groupBy("bucket").agg(many.alias("n")).join(
        names_b.groupBy("bucket").agg(many.alias("m")), "bucket"
    )
    if per_bucket.where(F.col("n") * F.col("m") >= heavy_rows).isEmpty():
        # Exploded sides are larger than Spark estimates, so neither is to be broadcast.
        return dealt(a, *key).join(dealt(b, *key).hint("merge"), key)
    weights = a.groupBy(*key).agg(many.alias("n")).join(b.groupBy(*key).agg(many.alias("m")), key)
    return spread_join(a, b.hint("merge"), key, weights, "a_key", heavy_rows=heavy_rows, other_id="b_key")


def name_pairs(
    names_a: DataFrame, names_b: DataFrame, threshold: int, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Distinct name pairs that reach the threshold, from names with the bucket they occur in."""
    a = names_a.select(
        "bucket",
        F.col("name_key").alias("a_key"),
        F.explode(similarity.indexed_segments(F.col("name_key"), threshold)).alias(SEGMENT),
    )
    b = names_b.select(
        "bucket",
        F.col("name_key").alias("b_key"),
        F.explode(similarity.probing_segments(F.col("name_key"), threshold)).alias(SEGMENT),
    )
    a_key, b_key = F.col("a_key"), F.col("b_key")
    lengths = F.length("a_key") + F.length("b_key")
    return (
        _meeting(names_a, names_b, a, b, heavy_rows)
        .where(similarity.may_match(a_key, b_key, threshold))
        .select("a_key", "b_key")
        .distinct()
        .withColumn("lcs", similarity.lcs_length(a_key, b_key))
        .withColumn("lengths", lengths)
        .where(similarity.score_reached(F.col("lcs"), F.col("lengths"), threshold))
    )


def similar_names(employees: DataFrame, settings: Settings) -> DataFrame:
    """Name pairs of the two companies that reach the threshold and occur in near buckets."""
    width = _bucket_width(settings)
    names_a = _side(employees, STAFF_A).select(
        "name_key", _own_bucket(F.col("hire_date"), width).alias("bucket")
    ).distinct()
    names_b = _side(employees, STAFF_B).select(
        "name_key", F.explode(_near_buckets(F.col("hire_date"), width)).alias("bucket")
    ).distinct()
    return name_pairs(names_a, names_b, settings.match_threshold, settings.heavy_rows)


def _prefixed(side: DataFrame, key: str, prefix: str) -> DataFrame:
    return side.select(
        F.col("name_key").alias(key),
        F.col(ORDINAL).alias(f"{key}_row"),
        *[
            F.col(c).alias(f"{prefix}_{c}")
            for c in ("employee_id", "full_name", "hire_date", "email", "country")
        ],
    )


def probable_matches(employees: DataFrame, names: DataFrame, settings: Settings) -> DataFrame:
    """Rows of both companies whose names are a pair of ``names`` and whose dates are close.

    ``names`` should be stored, as it is read three times. It picks the rows of company A that
    take part; rows of one name and bucket are cut by the pairs they make.
    """
    width, window = _bucket_width(settings), settings.match_window_days
    picked = names.select(F.col("a_key").alias("name_key")).distinct()
    a = _side(employees, STAFF_A).join(picked, "name_key", "left_semi")
    b = _side(employees, STAFF_B)
    rows_a = _prefixed(a, "a_key", "gt").withColumn(
        "bucket", _own_bucket(F.col("gt_hire_date"), width)
    )
    rows_b = _prefixed(b, "b_key", "acq")
    b_with_names = spread_join(
        rows_b,
        names,
        ["b_key"],
        rows_b.groupBy("b_key").agg(F.count(F.lit(1)).alias("n")),
        "b_key_row",
        heavy_rows=settings.heavy_rows,
    )
    near = _near_buckets(F.col("acq_hire_date"), width)
    b_in_buckets = b_with_names.withColumn("bucket", F.explode(near))
    key, many = ["a_key", "bucket"], F.count(F.lit(1))
    weights = rows_a.groupBy(*key).agg(many.alias("n")).join(
        b_in_buckets.groupBy(*key).agg(many.alias("m")), key
    )
    pairs = spread_join(
        rows_a, b_in_buckets, key, weights, "a_key_row", heavy_rows=settings.heavy_rows,
        other_id="b_key_row",
    )
    apart = F.abs(F.date_diff("acq_hire_date", "gt_hire_date"))
    return (
        pairs.where(apart <= window)
        .withColumn("hire_date_delta_days", apart)
        .withColumn("match_score", similarity.score(F.col("lcs"), F.col("lengths")))
        .select(*PAIR_COLUMNS)
    )


def flag_fuzzy(employees: DataFrame, pairs: DataFrame) -> DataFrame:
    """Mark the company B rows of a pair; nothing is removed."""
    matched = pairs.select(F.col("acq_employee_id").alias("_id")).distinct()
    return (
        employees.withColumn("_id", own_key("employee_id"))
        .join(matched.withColumn("_fuzzy", F.lit(True)), "_id", "left")
        .withColumn(
            "dedup_method", F.when(F.col("_fuzzy"), "fuzzy_name").otherwise(F.col("dedup_method"))
        )
        .select(*employees.columns)
    )


def blocked_comparisons(employees: DataFrame, settings: Settings) -> DataFrame:
    """How many pairs lie within the date window, from head counts per day.

    There are no more days than the calendar has, whatever the number of rows.
    """
    window = settings.match_window_days

    def per_day(system: str, n: str) -> DataFrame:
        dated = staff_of(employees, system).where(F.col("hire_date").isNotNull())
        return dated.groupBy("hire_date").agg(F.count(F.lit(1)).cast("decimal(19,0)").alias(n))

    day = F.col("hire_date")
    spread = per_day(STAFF_B, "n_b").select(
        F.explode(F.sequence(F.date_sub(day, window), F.date_add(day, window))).alias("hire_date"),
        "n_b",
    )
    near = spread.groupBy("hire_date").agg(F.sum("n_b").alias("n_b"))
    return (
        near.join(per_day(STAFF_A, "n_a"), "hire_date")
        .agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("value"))
        .select(F.col("value").cast("long").alias("value"))
    )


def fuzzy_report(employees: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    by_system = employees.groupBy("source_system").agg(F.count(F.lit(1)).alias("n"))

    def rows_of(system: str) -> DataFrame:
        return by_system.where(F.col("source_system") == system).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("value")
        )

    per_id = pairs.groupBy("acq_employee_id").agg(F.count(F.lit(1)).alias("n"))
    counted = counters(
        {
            "input_rows": by_system.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value")),
            "rows_a": rows_of(STAFF_A),
            "rows_b": rows_of(STAFF_B),
            "comparisons": blocked_comparisons(employees, settings),
            "pairs": per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value")),
            "flagged": per_id.agg(F.count(F.lit(1)).alias("value")),
        }
    ).withColumns(
        {
            "output_rows": F.col("input_rows"),
            "rows_removed": F.lit(0).cast("long"),
            "rows_quarantined": F.lit(0).cast("long"),
        }
    )
    # The parameters and the comparison count are reported only if there was something to compare.
    ran = (F.col("rows_a") > 0) & (F.col("rows_b") > 0)
    return pass_report(
        "pass3_fuzzy_name",
        counted,
        {
            "total_comparisons": F.when(ran, F.col("comparisons")),
            "probable_match_pairs": F.col("pairs"),
            "acqco_rows_flagged": F.col("flagged"),
            "fuzzy_threshold": F.when(ran, F.lit(settings.match_threshold)),
            "date_window_days": F.when(ran, F.lit(settings.match_window_days)),
        },
    )
