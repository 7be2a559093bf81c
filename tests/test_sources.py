import json

import pytest
from pyspark.sql import functions as F

from rosterweave.config import BENEFITS, STAFF_B
from rosterweave.functions.values import parse_hire_date
from rosterweave.operators import align
from rosterweave.sources import benefits_xml, payroll, staff_csv, staff_json
from rosterweave.sources.common import STAFF_B_OFFSET, dead_letter_summary, in_file_order, split_rejects

HEADER = "employee_id,first_name,last_name,email,department,job_title,hire_date,country,employment_type,employment_status,manager_id\n"


def record(**changes):
    base = {
        "employee_identifier": "ACQ_00001",
        "name": {"first": "Ann", "last": "Lee", "full": "Ann Lee"},
        "contact": {"email": "a@b.co"},
        "assignment": {"department": "Sales", "role": "Rep", "location": "Peru", "hire_timestamp": "2018-03-05T09:00:00Z"},
        "employment": {"type": "FT", "status": "Active"},
        "manager_employee_id": "ACQ_00002",
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v != "ABSENT"}


def test_csv_by_header_name_with_missing_cells(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        HEADER + '007,Ann,"Lee, Jr",a@b.co,,"say ""hi""",3/5/2018,NA,Full-Time,Inactive,12.0\n'
        "8,Bob,null,b@b.co,Sales,Rep,2018-03-05,Peru,Temp,Active,\n", encoding="utf-8")
    rows = staff_csv.read_staff_csv(spark, str(path)).orderBy("ingest_ordinal").collect()
    assert [r.employee_id for r in rows] == ["007", "8"]
    assert rows[0].last_name == "Lee, Jr" and rows[0].job_title == 'say "hi"'
    assert rows[0].department is None and rows[0].country is None and rows[1].last_name is None
    aligned = align.align_staff_a(staff_csv.read_staff_csv(spark, str(path)))
    got = aligned.orderBy("ingest_ordinal").collect()
    assert [r.manager_id for r in got] == ["12", ""]
    assert {r.employment_status for r in got} == {"Active"}
    unknown = align.unknown_types_a(staff_csv.read_staff_csv(spark, str(path))).collect()
    assert [r[0] for r in unknown] == ["Temp"]


def test_csv_ordinals_follow_the_file_across_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    body = "".join(f"{i},F,L,e,d,j,2018-03-05,c,Full-Time,Active,\n" for i in range(4000))
    path.write_text(HEADER + body)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 16000)
        spark.conf.set("spark.sql.files.openCostInBytes", 1000)
        table = staff_csv.read_staff_csv(spark, str(path), multiline=False)
        ids = [int(r.employee_id) for r in table.orderBy("ingest_ordinal").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ids == list(range(4000))


def test_csv_without_a_needed_column_is_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("employee_id,first_name\n1,Ann\n")
    with pytest.raises(ValueError, match="last_name"):
        staff_csv.read_staff_csv(spark, str(path))


def test_absent_files_are_empty_tables_with_schema(spark, tmp_path):
    gone = str(tmp_path / "gone")
    assert staff_csv.read_staff_csv(spark, gone).count() == 0
    assert payroll.read_payroll(spark, gone).columns[0] == "employee_id"
    assert payroll.read_payroll(spark, gone, "parquet").count() == 0
    assert benefits_xml.parse_benefits_xml(spark, gone).count() == 0
    both = align.align(
        staff_csv.read_staff_csv(spark, gone),
        split_rejects(staff_json.parse_staff_json(spark, gone), STAFF_B).rows,
    )
    assert both.count() == 0 and both.columns == align.COLUMNS


def test_json_leaves_absent_null_and_wrong_parent(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"total_records": 7, "employees": [
        record(),
        record(contact={"email": None}),
        record(employee_identifier="ABSENT"),
        record(name={"first": "Ann"}),
        record(name="Ann Lee"),
        record(assignment=None),
        record(employment=["FT"]),
        record(name={"first": "Bo", "last": "Li"}, manager_employee_id="ABSENT"),
        record(manager_employee_id=None),
    ]}))
    (tmp_path / "broken.json").write_text('{"employees": [')
    (tmp_path / "nolist.json").write_text('{"employees": {"a": 1}}')
    (tmp_path / "other.json").write_text('{"total_records": 0}')
    parsed = split_rejects(staff_json.parse_staff_json(spark, str(tmp_path)), STAFF_B)
    rows = parsed.rows.orderBy("ingest_ordinal").collect()
    assert [r.email for r in rows] == ["a@b.co", None, "a@b.co", "a@b.co"]
    assert [r.manager_employee_id for r in rows] == ["ACQ_00002", "ACQ_00002", "", None]
    assert [r.full_name for r in rows] == ["Ann Lee", "Ann Lee", "", "Ann Lee"]
    rejects = parsed.rejects.collect()
    assert sorted(r.error for r in rejects) == sorted([
        staff_json.BAD_PAGE, staff_json.BAD_PAGE, staff_json.BAD_PAGE,
        "Missing field: 'employee_identifier'", "Missing field: 'last'",
        "Missing field: 'name' is not an object", "Missing field: 'assignment' is not an object",
        "Missing field: 'employment' is not an object",
    ])
    assert {r.raw_record for r in rejects if r.error == staff_json.BAD_PAGE} == {
        '{"employees": [', '{"employees": {"a": 1}}', '{"total_records": 0}'
    }
    assert all(json.loads(r.raw_record) for r in rejects if r.error != staff_json.BAD_PAGE)
    summary = {r.error: r["count"] for r in dead_letter_summary(parsed.rejects).collect()}
    assert summary["Missing field: 'last'"] == 1 and len(summary) == 6


def test_indented_pages_and_their_counts(spark, tmp_path):
    page = {"total_records": 3, "employees": [record(employee_identifier=f"ACQ_{i}") for i in range(3)]}
    (tmp_path / "p.json").write_text(json.dumps(page, indent=2))
    rows = staff_json.parse_staff_json(spark, str(tmp_path)).orderBy("ingest_ordinal").collect()
    assert [r.employee_identifier for r in rows] == ["ACQ_0", "ACQ_1", "ACQ_2"]
    assert [r.total_records for r in staff_json.expected_records(spark, str(tmp_path)).collect()] == [3]


def test_page_larger_than_a_variant(spark):
    one = json.dumps(record())
    n = 140_000_000 // len(one)
    page = spark.range(1).selectExpr(f"""concat('{{"employees":[', array_join(array_repeat('{one}', {n}), ','), ']}}') as value""")
    assert staff_json.explode_pages(page).where("fault is null").count() == n


def test_lines_that_cannot_be_read_are_dead_letters(spark, tmp_path):
    good, twice = json.dumps(record()), '{"a": 1, "a": 2}'
    (tmp_path / "a.jsonl").write_text("\n".join([good, good[:50], "", twice, good]))
    parsed = split_rejects(staff_json.parse_staff_json(spark, str(tmp_path), lines=True), STAFF_B)
    assert parsed.rows.count() == 2
    got = {(r.error, r.raw_record) for r in parsed.rejects.collect()}
    assert got == {(staff_json.BAD_RECORD, good[:50]), (staff_json.BAD_RECORD, twice)}


def test_csv_line_breaks_and_column_orders(spark, tmp_path):
    (tmp_path / "1.csv").write_text(HEADER + '1,Ann,"Le\ne",a@b.co,Sales,Rep,2018-03-05,Peru,Temp,Active,2\n')
    turned = ",".join(reversed(HEADER.strip().split(",")))
    (tmp_path / "2.csv").write_text(turned + "\n3,Active,Temp,Peru,2018-03-05,Rep,Sales,b@b.co,Li,Bob,2\n")
    rows = sorted(staff_csv.read_staff_csv(spark, str(tmp_path)).collect(), key=lambda r: r.employee_id)
    assert [(r.employee_id, r.last_name, r.manager_id) for r in rows] == [("1", "Le\ne", "2"), ("2", "Li", "3")]


def test_xml_damage_stays_in_its_element(spark, tmp_path):
    bad = "<enrollment><employee_id>2</employee_id><plan_type>A &bad; </plan_type><premium_employee>5</premium_employee></enrollment>"
    (tmp_path / "b.xml").write_text(
        "<root><enrollment><employee_id>1</employee_id></enrollment>" + bad
        + "<enrollment><employee_id> </employee_id><note>keep <b>me</b></note></enrollment>"
        + "<enrollment><employee_id>3</employee_id></enrollment></root>")
    parsed = split_rejects(benefits_xml.parse_benefits_xml(spark, str(tmp_path)), BENEFITS)
    assert sorted(r.employee_id for r in parsed.rows.collect()) == ["1", "3"]
    raw = {r.error: r.raw_record for r in parsed.rejects.collect()}
    assert raw[benefits_xml.BAD_ELEMENT] == bad
    assert raw["empty employee_id"] == "<enrollment><employee_id> </employee_id><note>keep <b>me</b></note></enrollment>"


def test_xml_elements_without_end_tags_and_over_splits(spark, tmp_path):
    good = [f'<enrollment n="{i}">\n <employee_id>{i}</employee_id></enrollment>' for i in range(900)]
    lost = "<enrollment><employee_id>lost</employee_id>\n"
    text = "<r>" + "\n".join(good[:450]) + lost + "<enrollment/><enrollment />" + "\n".join(good[450:]) + lost + "</r>"
    (tmp_path / "b.xml").write_text(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 7000)
        spark.conf.set("spark.sql.files.openCostInBytes", 1000)
        read = benefits_xml.parse_benefits_xml(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 4
        parsed = split_rejects(read, BENEFITS)
        ids = [r.employee_id for r in parsed.rows.orderBy("ingest_ordinal").collect()]
        raw = sorted(r.raw_record for r in parsed.rejects.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ids == [str(i) for i in range(900)]
    assert raw == sorted([lost + "<enrollment/>", lost + "</r></enrollment>"])
    assert benefits_xml.expected_elements(spark, str(tmp_path)).first().expected == 902


def test_ordinals_follow_the_names_of_files_of_any_size(spark, tmp_path):
    sizes = [3, 400, 1, 90, 1000]
    for n, size in enumerate(sizes):
        lines = [json.dumps(record(employee_identifier=f"{n}-{i:04}")) for i in range(size)]
        (tmp_path / f"{n}.jsonl").write_text("\n".join(lines))
    parsed = staff_json.parse_staff_json(spark, str(tmp_path), lines=True)
    parsed.write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    placed = in_file_order(stored, STAFF_B_OFFSET)
    got = [r.employee_identifier for r in placed.orderBy("ingest_ordinal").collect()]
    assert got == [f"{n}-{i:04}" for n, size in enumerate(sizes) for i in range(size)]
    assert placed.agg(F.min("ingest_ordinal")).first()[0] >= STAFF_B_OFFSET


def test_dates_of_company_b_in_all_layouts(spark):
    rows = [("2018-03-05T09:00:00Z",), ("15-Mar-2018",), ("03/15/2018",), (None,)]
    staff = spark.createDataFrame([record() for _ in rows], "employee_identifier string").select(
        "employee_identifier", *[F.lit("x").alias(c) for c in (
            "first_name", "last_name", "email", "department", "role", "location",
            "employment_type", "employment_status", "manager_employee_id")])
    dated = staff.limit(1).crossJoin(spark.createDataFrame(rows, "hire_timestamp string"))
    got = align.align_staff_b(dated.withColumn("ingest_ordinal", F.lit(1)))
    parsed = got.select(parse_hire_date(F.col("hire_date")).cast("string").alias("d")).collect()
    assert [r.d for r in parsed] == ["2018-03-05", "2018-03-15", "2018-03-15", None]


def test_json_lines_give_the_same_rows(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(record(employee_identifier=f"ACQ_{i}")) for i in range(3)))
    rows = staff_json.parse_staff_json(spark, str(tmp_path), lines=True).orderBy("ingest_ordinal").collect()
    assert [r.employee_identifier for r in rows] == ["ACQ_0", "ACQ_1", "ACQ_2"]


def test_xml_texts_premiums_and_dead_letters(spark, tmp_path):
    def element(i, premium, extra=""):
        return f"<enrollment><employee_id>{i}</employee_id><plan_type> HMO </plan_type>{extra}<premium_employee>{premium}</premium_employee></enrollment>"

    (tmp_path / "b.xml").write_text("<root>" + "".join([
        element(" 7 ", "12.5"), element("  ", "1"), element("8", "12x"), element("9", ""),
        element("10", "1_000"), element("11", "1.0d"), element("12", " 3 "), element("13", "Infinity"),
        element("14", " "), "<enrollment><plan_type>x</plan_type></enrollment>",
    ]) + "</root>")
    parsed = split_rejects(benefits_xml.parse_benefits_xml(spark, str(tmp_path)), BENEFITS)
    rows = {r.employee_id: r for r in parsed.rows.collect()}
    assert {k: r.premium_employee for k, r in rows.items()} == {
        "7": 12.5, "9": 0.0, "10": 1000.0, "12": 3.0, "13": float("inf")
    }
    assert rows["7"].plan_type == "HMO" and rows["7"].coverage_level == "" and rows["7"].premium_employer == 0.0
    errors = sorted(r.error for r in parsed.rejects.collect())
    assert errors == sorted(["empty employee_id"] * 2 + [
        f"could not convert string to float: '{x}'" for x in ("12x", "1.0d", " ")
    ])
    assert any("<employee_id>8</employee_id>" in r.raw_record for r in parsed.rejects.collect())


def test_payroll_repeated_ids(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("employee_id,source,base_salary,currency,pay_frequency,bonus_target_pct,effective_date\n"
                    "1,GlobalTech,\"$70,315\",USD,Annual,5,2018-03-05\n1,GlobalTech,n/a,USD,Annual,x,\n,GlobalTech,1,,,,\n,GlobalTech,2,,,,\n")
    rows = payroll.read_payroll(spark, str(path))
    got = rows.orderBy("ingest_ordinal").collect()
    assert [r.base_salary for r in got] == ["$70,315", None, "1", "2"]
    assert [r.bonus_target_pct for r in got] == [5.0, None, None, None]
    assert tuple(payroll.repeated_ids(rows).first()) == (2, 4)
