from pathlib import Path

import pytest

from workload.oracle import ORACLE_SQL
from rosterweave.operators import fuzzy
from tools.check_oracle import rows_of
from workload.queries import QUERIES, SETTINGS, exact

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "align_staff", "namespace_ids", "parse_dates", "payroll_latest", "benefits_history",
    "pass1_quarantine", "tenure_histogram", "golden_employees",
]
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not here")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        db.sql(f"create view {path.stem} as select * from '{path}'")
    df = QUERIES[name](spark, FOLDER)
    want = db.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@needs_data
def test_fuzzy_plan_has_no_pairwise_join(spark, stage):
    names = fuzzy.similar_names(exact(spark, FOLDER, stage).employees, SETTINGS)
    plan = names._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
