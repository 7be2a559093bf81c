import json

import pytest

from rosterweave.config import Settings
from rosterweave.plans.ingest import Sources
from rosterweave.plans.integrate import integrate
from rosterweave.plans.staging import SETTING, Stage, shared_folder
from rosterweave.sources.golden import read_golden
from tests.conftest import REPORT_DATE
from tests.test_sources import HEADER, record


@pytest.fixture
def sources(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text(HEADER + "".join([
        "1,ann,lee,ann.lee@a.co,Sales,Rep,2000-01-10,Peru,Full-Time,Active,\n",
        "2,BO,mcdonald,bo@a.co,ENG-01,Dev,1/15/2000,Peru,Part-Time,Active,1.0\n",
        "3,Cy,O'neil,shared@a.co,Legal,Law,15-Jan-2000,Kenya,Contractor,Active,1.0\n",
    ]))
    (raw / "b.json").write_text(json.dumps({"employees": [
        record(employee_identifier="ACQ_00001", name={"first": "Ann", "last": "Leee"}, contact={"email": "x@b.co"},
               assignment={"department": "Sales", "role": "R", "location": "Peru", "hire_timestamp": "2000-01-20T09:00:00Z"}, manager_employee_id=""),
        record(employee_identifier="ACQ_DUP_00001", name={"first": "dupZed", "last": "Q"}, contact={"email": "z@b.co"}, manager_employee_id=""),
        record(employee_identifier="ACQ_00004", name={"first": "Cyr", "last": "X"}, contact={"email": "shared@a.co"}, manager_employee_id=""),
        record(contact={}),
    ]}))
    (raw / "p.csv").write_text(
        "employee_id,source,base_salary,currency,pay_frequency,bonus_target_pct,effective_date\n"
        '1,GlobalTech,"$20,000",USD,Annual,1,2000-01-01\n1,GlobalTech,30000,USD,Annual,1,2001-01-01\n'
        "77,AcquiredCo,5000,EUR,Monthly,1,2001-01-01\n")
    (raw / "e.xml").write_text(
        "<r>" + "".join(
            f"<enrollment><employee_id>{i}</employee_id><plan_type>HMO</plan_type><coverage_level>S</coverage_level>"
            f"<enrollment_date>{d}</enrollment_date><premium_employee>1</premium_employee><premium_employer>2</premium_employer></enrollment>"
            for i, d in [("1", "2000-02-01"), ("1", "2001-02-01"), ("2", "2000-02-01"), ("", "2000-02-01")]
        ) + "</r>")
    return Sources(str(raw / "a.csv"), str(raw / "b.json"), str(raw / "p.csv"), str(raw / "e.xml"))


def test_end_to_end_and_read_back(spark, sources, stage, settings, tmp_path):
    out = str(tmp_path / "out")
    done = integrate(spark, sources, out, settings, stage=stage)
    assert done.passed and done.exported
    golden = read_golden(spark, f"{out}/golden_employees")
    rows = {r.employee_id: r for r in golden.collect()}
    assert set(rows) == {"GT-000001", "GT-000002", "GT-000003", "AC-000001"}
    assert len(golden.columns) == 19 and golden.columns[-1] == "company_origin"
    assert dict(golden.dtypes)["hire_date"] == "timestamp_ntz"
    assert rows["AC-000001"].dedup_method == "fuzzy_name"
    assert rows["GT-000003"].dedup_method == "email_match" and rows["GT-000003"].full_name == "Cy O'Neil"
    assert rows["GT-000001"].source_systems == "benefits,globaltech_hris,payroll"
    assert rows["GT-000002"].department == "Engineering" and rows["GT-000002"].last_name == "McDonald"
    assert rows["GT-000002"].manager_id == "GT-000001"
    only_b = read_golden(spark, f"{out}/golden_employees", "AcquiredCo")
    assert only_b.count() == 1
    assert "PartitionFilters: [isnotnull" in only_b._jdf.queryExecution().executedPlan().toString()

    def csv(name):
        return spark.read.option("header", True).csv(f"{out}/{name}").collect()

    assert [r.payroll_employee_id for r in csv("ghost_employees")] == ["AC-000077"]
    review = csv("probable_matches_review")
    assert [(r.record_1_id, r.record_2_id, r.recommended_action) for r in review] == [("AC-000001", "GT-000001", "MANUAL_REVIEW")]
    assert len(csv("golden_employees_schema")) == 19 and len(csv("validation_report")) == 15
    assert csv("validation_summary")[0].gate_passed == "true"
    for name, n in [("id_quarantine", 1), ("email_quarantine", 1), ("benefits", 2), ("benefits_history", 1),
                    ("dead_letters", 2), ("dead_letter_summary", 2), ("reports/clean", 3), ("reports/passes", 4),
                    ("figures/tenure_histogram", 35), ("figures/headcount_company", 1)]:
        assert spark.read.parquet(f"{out}/{name}").count() == n, name


def test_a_failed_gate_stops_the_export_unless_told_otherwise(spark, sources, stage, tmp_path):
    strict = Settings(REPORT_DATE, max_failed_checks=-1)
    out = tmp_path / "strict"
    done = integrate(spark, sources, str(out), strict, stage=stage)
    assert not done.passed and not done.exported
    assert (out / "validation_report").exists() and not (out / "golden_employees").exists()
    done = integrate(spark, sources, str(out), strict, respect_gate=False, stage=Stage(spark, str(tmp_path / "s2")))
    assert not done.passed and done.exported and (out / "golden_employees").exists()


class Named:
    """Stands for a session with the given settings and master."""

    def __init__(self, master, **settings):
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: settings.get(k, d))})
        self.sparkContext = type("Context", (), {"master": master})


def test_stage_uses_the_folder_the_session_names():
    named = Named("spark://host:1", **{SETTING: "s3a://shared/x/"})
    assert shared_folder(named) == "s3a://shared/x/"
    assert Stage(named).folder.startswith("s3a://shared/x/rosterweave-")
    with pytest.raises(ValueError, match=SETTING):
        shared_folder(Named("spark://host:1"))
    assert shared_folder(Named("local[2]")) == shared_folder(Named("local[2]"))
