import random

import pytest
from pyspark.sql import functions as F

from rosterweave.config import STAFF_A, STAFF_B, Settings
from rosterweave.operators import identity
from rosterweave.operators.keep_one import latest, split_latest
from rosterweave.operators.skew import spread_join
from tests.conftest import REPORT_DATE

SCHEMA = (
    "ingest_ordinal long, employee_id string, source_system string, first_name string, "
    "last_name string, first_name_raw string, email string"
)


def staff(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all rows share one id, and a third one e-mail.
        key = rng.choice(["GT-000001", f"GT-{rng.randrange(60):06d}", f"AC-{rng.randrange(60):06d}", None])
        system = STAFF_B if key and key.startswith("AC") else STAFF_A
        first = rng.choice(["Ann", "Ann", "Bob", None])
        raw = rng.choice(["dup" + first, first]) if first else None
        mail = rng.choice(["hot@x.co", f"m{rng.randrange(40)}@x.co", None])
        rows.append((i, key, system, first, "Lee", raw, mail))
    return rows


def expected_pass1(rows):
    keep, removed, quarantine, groups = [], 0, [], {}
    for r in rows:
        if r[1] is None:
            keep.append(r[0])
        else:
            groups.setdefault(r[1], []).append(r)
    for g in groups.values():
        same = len({r[3] for r in g if r[3]}) == 1 and len({r[4] for r in g if r[4]}) == 1
        unmarked = [r for r in g if not (r[5] and "dup" in r[5].lower())]
        kept = g[0] if same or len(g) == 1 or not unmarked else unmarked[0]
        keep.append(kept[0])
        if same:
            removed += len(g) - 1
        else:
            quarantine += [r[0] for r in g if r is not kept]
    return keep, removed, quarantine


@pytest.mark.parametrize("seed,heavy", [(1, 10**6), (2, 3), (3, 1)])
def test_pass1_keeps_removes_and_quarantines_every_row_once(spark, stage, seed, heavy):
    rows = staff(seed)
    settings = Settings(REPORT_DATE, heavy_rows=heavy)
    emp = spark.createDataFrame(rows, SCHEMA).repartition(3)
    paid = spark.createDataFrame([("GT-000001",), ("GT-000001",), ("AC-000003",), (None,)], "employee_id string")
    enrolled = spark.createDataFrame([("GT-000001",), ("GT-000002",)], "employee_id string")
    resolved = stage(identity.resolve_ids(emp, paid, enrolled, settings), "resolved")
    kept = identity.kept_rows(resolved).collect()
    quarantine = identity.colliding_rows(emp, resolved, settings).collect()
    keep, removed, colliding = expected_pass1(rows)
    assert sorted(r.ingest_ordinal for r in kept) == sorted(keep)
    assert sorted(r.ingest_ordinal for r in quarantine) == sorted(colliding)
    report = identity.ids_report(resolved).first()
    assert (report.input_rows, report.output_rows) == (len(rows), len(keep))
    assert (report.rows_removed, report.rows_quarantined) == (removed, len(colliding))
    assert len(keep) + removed + len(colliding) == len(rows)
    sources = {r.employee_id: (r.source_systems, r.dedup_method) for r in kept if r.employee_id}
    assert sources["GT-000001"] == ("benefits,globaltech_hris,payroll", "exact_id")
    assert sources.get("AC-000003", ["acquiredco_hris,payroll"])[0] == "acquiredco_hris,payroll"
    assert all(r.source_systems == "globaltech_hris" for r in kept if r.employee_id is None)


def test_copy_marker_may_be_another_column(spark):
    rows = [(0, "AC-000001", STAFF_B, "Dupont", "Lee", "Dupont", None), (1, "AC-000001", STAFF_B, "Ann", "Lee", "Ann", None)]
    emp = spark.createDataFrame(rows, SCHEMA).withColumn(
        "employee_id_raw", F.when(F.col("ingest_ordinal") == 1, "ACQ_DUP_1").otherwise("ACQ_1"))
    none = spark.createDataFrame([], "employee_id string")

    def kept(settings):
        return identity.resolve_ids(emp, none, none, settings).first().ingest_ordinal

    assert kept(Settings(REPORT_DATE)) == 1
    assert kept(Settings(REPORT_DATE, copy_marker_column="employee_id_raw")) == 0


@pytest.mark.parametrize("heavy", [10**6, 2])
def test_pass2_quarantines_company_b_and_marks_the_rest(spark, stage, heavy):
    rows = staff(7)
    settings = Settings(REPORT_DATE, heavy_rows=heavy)
    emp = spark.createDataFrame(rows, SCHEMA).withColumn("dedup_method", F.lit("single_source"))
    shared = stage(identity.cross_emails(emp), "shared")
    done = identity.split_cross_emails(stage(identity.flag_cross_emails(emp, shared, settings), "f"))
    cross = {r[6] for r in rows if r[6] and len({x[2] for x in rows if x[6] == r[6]}) > 1}
    want = sorted(r[0] for r in rows if r[2] == STAFF_B and r[6] in cross)
    assert cross and sorted(r.ingest_ordinal for r in done.quarantine.collect()) == want
    kept = done.employees.collect()
    assert len(kept) + len(want) == len(rows)
    assert all((r.dedup_method == "email_match") == (r.email in cross) for r in kept)
    report = done.report.first()
    assert report.details == {"cross_company_email_matches": len(cross), "acqco_rows_removed": len(want)}


@pytest.mark.parametrize("heavy", [10**6, 5, 1])
def test_spread_join_equals_a_plain_join(spark, heavy):
    rng = random.Random(3)
    left = spark.createDataFrame([(i, rng.choice(["hot", "hot", f"k{i % 9}"])) for i in range(200)], "id long, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("zz", 4)], "k string, v int")
    weights = left.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how).select("id", "k", "v")
        spread = spread_join(left, right, ["k"], weights, "id", how, heavy_rows=heavy)
        assert sorted(map(repr, spread.select("id", "k", "v").collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("heavy", [10**9, 400, 9, 1])
def test_both_sides_of_a_heavy_key_are_cut(spark, heavy):
    left = spark.range(120).selectExpr("id", "if(id < 90, 'hot', 'k' || id % 7) as k")
    right = spark.range(100).selectExpr("id as v", "if(id < 60, 'hot', 'k' || id % 9) as k")
    many = F.count("*")
    weights = left.groupBy("k").agg(many.alias("n")).join(right.groupBy("k").agg(many.alias("m")), "k")
    spread = spread_join(left, right, ["k"], weights, "id", heavy_rows=heavy, other_id="v")
    plain = left.join(right, "k")
    assert sorted(map(tuple, spread.select("id", "k", "v").collect())) == sorted(
        map(tuple, plain.select("id", "k", "v").collect())
    )


def test_nulls_in_row_ids_are_values(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "x", "b")], "k long, part string, d string")
    both = split_latest(df, ["k"], ["d"], ["k", "part"])
    assert [r.d for r in both.current.collect()] == ["b"] and [r.d for r in both.history.collect()] == ["a"]


def test_latest_does_not_depend_on_row_order(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", f"k{i % 5}", None]), rng.choice([None, "2020-01-01", f"2020-01-{1 + i % 9:02d}"])) for i in range(200)]
    best = {}
    for i, k, d in rows:
        if k not in best or (d or "", i) > best[k]:
            best[k] = (d or "", i)
    want = sorted(i for _, i in best.values())
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "ingest_ordinal long, k string, d string").repartition(parts)
        both = split_latest(df, ["k"], ["d", "ingest_ordinal"])
        assert sorted(r.ingest_ordinal for r in both.current.collect()) == want
        assert sorted(r.ingest_ordinal for r in both.history.collect()) == sorted(set(range(200)) - set(want))


def test_heavy_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id as ingest_ordinal", "id % 3 as k", "id % 7 as d")
    plan = latest(df, ["k"], ["d", "ingest_ordinal"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ghosts_and_unpaid(spark):
    pay = spark.createDataFrame([("GT-000001", "a"), ("GT-000009", "b"), (None, "c")], "employee_id string, source string")
    emp = spark.createDataFrame([("GT-000001",), ("GT-000002",), (None,)], "employee_id string")
    ghosts = identity.ghost_employees(pay, emp)
    assert sorted(r.source for r in ghosts.collect()) == ["b", "c"]
    unpaid = identity.unpaid_employees(pay, emp)
    assert [r[0] for r in unpaid.collect()] == ["GT-000002"]
    report = identity.ghosts_report(pay, ghosts, unpaid).first()
    assert (report.input_rows, report.output_rows, report.rows_quarantined) == (3, 1, 2)
    assert report.details == {"ghost_employees_detected": 2, "hris_employees_not_in_payroll": 1}


def test_latest_rows_are_stored_once(spark, stage):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), (None, 3, 2), ("b", 1, 3)], "k string, d int, ingest_ordinal long")
    both = split_latest(df, ["k"], ["d", "ingest_ordinal"], stage=stage)
    assert sorted(r.ingest_ordinal for r in both.current.collect()) == [1, 2, 3]
    assert [r.ingest_ordinal for r in both.history.collect()] == [0]
    assert "Window" not in both.current._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in both.history._jdf.queryExecution().executedPlan().toString()
