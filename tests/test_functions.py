import datetime as dt
import unicodedata

from pyspark.sql import functions as F

from rosterweave.config import PAY_PERIODS_PER_YEAR, STAFF_A, STAFF_B
from rosterweave.functions import ids, text, values

DAY = dt.date


def applied(spark, expression, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def check(spark, expression, table):
    assert applied(spark, expression, list(table)) == list(table.values())


def test_strip_takes_all_unicode_whitespace(spark):
    inputs = [" a\t", "a", "", " ", "\u2003x\u3000", "\x1cy\x1f", "\u00e9 ", "\u00e9", "a b", None, "~",
              "!", "a\u00a0", "\u0085a", "\x7f"]
    assert applied(spark, text.strip, inputs) == [x if x is None else x.strip() for x in inputs]


def test_names(spark):
    check(spark, text.name_case, {
        "o'brien": "O'Brien", "smith-jones": "Smith-Jones", "mcdonald": "McDonald",
        "MACKENZIE": "MacKenzie", "Macy": "MacY", "Mack": "MacK", "mc": "Mc", "mac": "Mac",
        "mary  jane": "Mary  Jane", "": "", "d'mcfoo mac-x": "D'McFoo Mac-X", "mcmac": "McMac",
        "--": "--", "élan": "Élan", "ANN MARIE": "Ann Marie", "tomcat": "Tomcat",
    })
    assert applied(spark, text.name_case, [None]) == [None]


def test_accents_are_composed_like_nfc(spark):
    inputs = ["e\u0301", "A\u030a", "\u1112\u1161\u11ab", "a\u0323\u0302", "a\u0302\u0323", "plain",
              "\u00e9a", "\u2126", "\u212b", None]
    want = [x if x is None else unicodedata.normalize("NFC", x) for x in inputs]
    assert applied(spark, text.compose_accents, inputs) == want


def test_employee_ids(spark):
    a = {"7": "GT-000007", "1234567": "GT-1234567", "abc": "GT-abc", "0": "GT-000000",
         "000123": "GT-000123", "x" + "9" * 30: "GT-" + "9" * 30, "a1b": "GT-a1b"}
    check(spark, lambda c: ids.employee_id(c, F.lit(STAFF_A)), a)
    check(spark, lambda c: ids.employee_id(c, F.lit(STAFF_B)),
          {"ACQ_DUP_00031": "AC-000031", "ACQ_5B7": "AC-000007"})
    check(spark, lambda c: ids.employee_id(c, F.lit("other")), {"3": "XX-000003"})
    assert applied(spark, lambda c: ids.employee_id(c, F.lit(STAFF_A)), [None]) == [None]


def test_manager_ids(spark):
    check(spark, ids.manager_id, {
        None: "", "": "", "nan": "", "acq_12": "AC-000012", "12": "GT-000012", "boss": "boss",
    })


def test_dates(spark):
    d = DAY(2018, 3, 5)
    check(spark, values.parse_date, {
        "2018-3-5": d, "2018-03-05": d, "3/5/2018": d, "5-Mar-2018": d, "05-MAR-2018": d,
        "15-MAR-2018": DAY(2018, 3, 15), "2018-03-05 00:00:00": None, "13/05/2018": None,
        "03/15/18": None, "20180305": None, "15-Mar-201": None, "": None, " ": None,
        "2018-02-30": None, "31-Feb-2018": None, "2018-03-05T1/2": None, None: None,
    })


def test_hire_dates_use_whole_text_then_ten_characters(spark):
    d = DAY(2018, 3, 5)
    check(spark, values.parse_hire_date, {
        "2018-03-05 00:00:00": d, "15-Mar-2018": DAY(2018, 3, 15), "3/5/2018": d,
        "2018-03-05T09:00:00Z": d, "unknown": None,
    })


def test_salaries(spark):
    check(spark, values.parse_salary, {
        "$70,315": 70315.0, "£1": 1.0, " 12 ": 12.0, "1e5": 100000.0, "€ 5.50": 5.5, "+.5": 0.5,
        "1.0d": None, "n/a": None, "": None, "inf": None, "NaN": None, "0x1p3": None, "1f": None,
        "-1": -1.0, None: None,
    })


def test_rounding_is_half_to_even(spark):
    row = spark.range(1).select(
        values.pass_rate(F.lit(1), F.lit(8)), values.pass_rate(F.lit(0), F.lit(0)),
        F.bround(F.lit(0.125), 2), F.bround(F.lit(0.375), 2),
    ).first()
    assert tuple(row) == (0.125, 0.0, 0.12, 0.38)


def test_recommended_action(spark):
    rows = spark.createDataFrame([(95.0,), (94.99,), (88.0,), (87.99,)], "s double")
    got = [r[0] for r in rows.select(values.recommended_action(F.col("s"))).collect()]
    assert got == ["CONFIRM_MERGE", "MANUAL_REVIEW", "MANUAL_REVIEW", "REJECT"]


def test_lookups_and_presence(spark):
    check(spark, lambda c: text.lookup(c, PAY_PERIODS_PER_YEAR),
          {"Annual": 1, "Monthly": 12, "Weekly": None, None: None})
    check(spark, lambda c: text.relabel(c, {"FT": "Full-Time"}),
          {"FT": "Full-Time", "INTERN": "INTERN", None: None})
    check(spark, text.present, {"a": True, "": False, " \t": False, None: False})
    check(spark, text.slug, {"A b-C": "a_b_c"})


def test_full_name_is_null_if_a_part_is(spark):
    rows = spark.createDataFrame([(" a ", "b"), ("a", None)], "f string, l string")
    got = [r[0] for r in rows.select(text.full_name(F.col("f"), F.col("l"))).collect()]
    assert got == ["a b", None]
