import datetime as dt
import glob
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rosterweave.config import STAFF_A, STAFF_B, Settings
from rosterweave.operators import aggregates, clean, quality, review
from rosterweave.operators.quantiles import exact_quantiles
from tests.conftest import REPORT_DATE

D = dt.date


def quantile(values, p):
    v = sorted(values)
    pos = p * (len(v) - 1)
    lo = int(pos)
    hi = min(lo + (pos > lo), len(v) - 1)
    return v[lo] + (v[hi] - v[lo]) * (pos - lo)


@pytest.mark.parametrize("cells", [100, 4_096])
def test_exact_quantiles_by_narrowing_and_a_hot_value(spark, stage, cells):
    rng = random.Random(1)
    data = [("a", rng.choice([5.0, round(rng.lognormvariate(3, 1), 3)])) for _ in range(3000)]
    data += [("b", float(i)) for i in range(7)] + [("c", 1.5), ("c", None), ("d", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    probabilities = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    got = {r.g: r for r in exact_quantiles(df, "g", "v", probabilities, stage, cells).collect()}
    assert set(got) == {"a", "b", "c"}
    for g, row in got.items():
        values = [v for k, v in data if k == g and v is not None]
        assert (row.n, row.min, row.max) == (len(values), min(values), max(values))
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(quantile(values, p), abs=1e-12)


def test_a_group_over_many_tasks_is_summed_by_cells(spark, stage):
    df = spark.range(200_000).select(F.lit("g").alias("g"), (F.col("id") * 7 % 200_000 / 3.0).alias("v")).repartition(8)
    got = exact_quantiles(df, "g", "v", {"p10": 0.1, "p90": 0.9}, stage, 64).first()
    assert (got.n, got.min) == (200_000, 0.0)
    assert got.p10 == pytest.approx(0.1 * 199_999 / 3) and got.p90 == pytest.approx(0.9 * 199_999 / 3)
    # No task sums more than the cells of a bracket, in a logarithmic number of rounds.
    rounds = [int(p.rsplit("_", 1)[1]) for p in glob.glob(f"{stage.folder}/brackets_*")]
    assert 2 <= max(rounds) <= 4


def hired(spark, dates):
    rows = [(f"GT-{i:06d}", STAFF_A, d) for i, d in enumerate(dates)]
    return spark.createDataFrame(rows, "employee_id string, source_system string, hire_date date")


def test_tenure_figures(spark):
    rng = random.Random(2)
    days = [rng.randrange(0, 4000) for _ in range(400)]
    dates = [REPORT_DATE - dt.timedelta(d) for d in days] + [REPORT_DATE + dt.timedelta(9), None]
    emp = hired(spark, dates)
    years = [d / 365.25 for d in days]
    s = aggregates.tenure_stats(emp, REPORT_DATE).first()
    assert s.n == 400 and s.min_years == min(years) and s.max_years == max(years)
    assert s.mean_years == pytest.approx(statistics.mean(years))
    assert s.median_years == pytest.approx(statistics.median(years))
    assert s.std_years == pytest.approx(statistics.stdev(years))
    bins = aggregates.tenure_histogram(emp, REPORT_DATE).orderBy("bin").collect()
    assert len(bins) == 35 and sum(b.employees for b in bins) == 400
    lo, hi = min(days), max(days)
    for b in bins:
        assert b.employees == sum(min((d - lo) * 35 // (hi - lo), 34) == b.bin for d in days)
    assert bins[-1].to_years == pytest.approx(max(years))


def test_tenure_of_one_day_and_of_nobody(spark):
    same = hired(spark, [D(2000, 1, 1)] * 3)
    bins = aggregates.tenure_histogram(same, REPORT_DATE).where("employees > 0").collect()
    assert [(b.bin, b.employees) for b in bins] == [(17, 3)]
    assert aggregates.tenure_histogram(hired(spark, [None]), REPORT_DATE).count() == 0
    assert aggregates.tenure_stats(hired(spark, [D(2000, 1, 1)]), REPORT_DATE).first().std_years is None


def test_enrollment_rate_keeps_the_null_department(spark):
    emp = spark.createDataFrame(
        [("GT-1", STAFF_A, "Sales"), ("GT-2", STAFF_A, "Sales"), ("GT-3", STAFF_A, None),
         ("GT-4", STAFF_A, "Legal"), ("AC-1", STAFF_B, "Sales")],
        "employee_id string, source_system string, department string")
    ben = spark.createDataFrame([("GT-1",)] * 50 + [("GT-9",), ("GT-8",), ("AC-1",), (None,)], "employee_id string")
    got = {r.department: (r.enrolled, r.headcount, r.rate_percent, r.at_least_half)
           for r in aggregates.enrollment_rate(emp, ben).collect()}
    assert got == {"Sales": (1, 2, 50.0, True), "(no department)": (3, 1, 300.0, True), "Legal": (0, 1, 0.0, False)}


def test_quality_report_and_gate(spark, settings):
    emp = spark.createDataFrame(
        [("GT-000001", "Ann", "Lee", "a@b.co", "Sales", "Peru", "Full-Time", D(2000, 1, 1), ""),
         ("GT-000002", " ", None, "a@b.co", None, "Peru", "Temp", D(1960, 1, 1), "GT-000001"),
         ("bad", "Bo", "Li", None, "Sales", "", "", None, "GT-000009"),
         (None, "Bo", "Li", None, "Sales", "X", None, D(2003, 1, 1), "GT-000009")],
        "employee_id string, first_name string, last_name string, email string, department string, "
        "country string, employment_type string, hire_date date, manager_id string")
    pay = spark.createDataFrame([("USD", 20000.0), ("JPY", 1.0), (None, None)], "currency string, salary_usd_annual double")
    report = quality.quality_report({"employees": emp, "payroll": pay}, quality.default_checks(settings))
    rows = report.orderBy("check_no").collect()
    assert [r.check_no for r in rows] == list(range(1, 16))
    got = {r.check: (r.total, r.passed) for r in rows}
    assert got == {
        "not_null.employee_id": (4, 3), "not_null.first_name": (4, 3), "not_null.last_name": (4, 3),
        "not_null.email": (4, 2), "not_null.department": (4, 3), "not_null.country": (4, 3),
        "unique.employee_id": (4, 4), "unique.email": (4, 2),
        "values_in_set.employment_type": (2, 1), "values_in_set.currency": (2, 1),
        "regex.email": (2, 2), "regex.employee_id": (3, 2), "numeric_range.salary_usd_annual": (2, 1),
        "date_range.hire_date": (3, 1), "referential_integrity.manager_id": (3, 1),
    }
    assert all(r.failed == r.total - r.passed and (r.status == "PASS") == (r.failed == 0) for r in rows)
    assert rows[12].description == "salary_usd_annual must be between 15,000 and 2,000,000"
    assert not quality.gate(report, 2) and quality.gate(report, 13)
    s = quality.summary(report, 2).first()
    assert (s.checks_run, s.passed, s.failed, s.gate) == (15, 2, 13, "FAILED — PIPELINE HALTED (13 failures, threshold 2)")
    orphans = quality.orphans(emp, "manager_id", emp).collect()
    assert [tuple(r) for r in orphans] == [("GT-000009", 2)]


def test_empty_population_passes_with_rate_zero(spark, settings):
    emp = spark.createDataFrame([], "employee_id string, email string")
    checks = [quality.not_null("e", "email"), quality.unique("e", "email"), quality.reference("e", "email", "e", "employee_id")]
    for r in quality.quality_report({"e": emp}, checks).collect():
        assert (r.total, r.passed, r.pass_rate, r.status) == (0, 0, 0.0, "PASS")


PAY = "ingest_ordinal long, employee_id string, source string, base_salary string, currency string, pay_frequency string, effective_date string"


def test_payroll_report_lists_fixes_only_without_the_issue(spark, settings):
    good = spark.createDataFrame([(1, "7", "GlobalTech", "$70,315", "EUR", "Monthly", "3/5/2018"),
                                  (2, "7", "GlobalTech", "100", "USD", "Annual", "2018-03-06"),
                                  (3, "7", "AcquiredCo", "100", "USD", None, "2018-03-06")], PAY)
    r = clean.payroll_report(clean.payroll_steps(good, settings), settings).first()
    assert (r.input_rows, r.output_rows, r.rows_dropped) == (3, 2, 1)
    assert r.fixes_applied == {
        "salary_symbols_stripped": 1, "payroll_ids_namespaced": 3, "salary_converted_to_usd": 3,
        "salary_usd_annual_computed": 2, "effective_date_parsed": 3, "payroll_duplicates_removed": 1}
    assert r.issues_flagged == {}
    bad = spark.createDataFrame([(1, "7", "x", "100", "GBP", "Weekly", "soon"), (2, "8", "x", "-1", "JPY", "Annual", None)], PAY)
    r = clean.payroll_report(clean.payroll_steps(bad, settings), settings).first()
    assert r.fixes_applied == {"payroll_ids_namespaced": 2}
    assert r.issues_flagged == {"non_positive_salary": 1, "invalid_currency": 1, "missing_fx_rate": 2,
                                "unmapped_pay_frequency": 1, "unparseable_effective_date": 2}
    with_gbp = Settings(REPORT_DATE, fx_rates={"USD": 1.0, "GBP": 1.27, "JPY": 0.01})
    r = clean.payroll_report(clean.payroll_steps(bad, with_gbp), with_gbp).first()
    assert "missing_fx_rate" not in r.issues_flagged and r.fixes_applied["salary_converted_to_usd"] == 2
    kept = clean.clean_payroll(good, settings).orderBy("source").collect()
    assert [(k.employee_id, k.salary_usd_annual) for k in kept] == [("AC-000007", None), ("GT-000007", 100.0)]


def test_ghost_report_and_review_columns(spark):
    ghosts = spark.createDataFrame([("GT-000009", "GlobalTech", 0.125)], "employee_id string, source string, salary_usd_annual double")
    assert tuple(review.ghost_report(ghosts).first()) == (
        "GT-000009", "Unknown — no HRIS record", 0.12,
        "Payroll record (source: GlobalTech) has no matching employee_id in HRIS")
    assert len(review.GOLDEN_COLUMNS) == 19


def test_payroll_report_counts_kept_rows_of_the_stored_latest(spark, settings):
    rows = [("1", "A", "5"), ("1", "A", "6"), (None, "A", "7"), (None, "A", "8"), (None, None, "9")]
    raw = spark.createDataFrame(
        [(i, e, s, b, "USD", "Annual", "2020-01-01") for i, (e, s, b) in enumerate(rows)],
        "ingest_ordinal long, employee_id string, source string, base_salary string, currency string,"
        " pay_frequency string, effective_date string",
    )
    steps = clean.payroll_steps(raw, settings)
    kept = clean.clean_payroll(raw, settings)
    given, counted = (clean.payroll_report(steps, settings, *k).first() for k in ((kept,), ()))
    assert given == counted and given.output_rows == 3
