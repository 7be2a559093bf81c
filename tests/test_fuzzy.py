import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterweave.config import STAFF_A, STAFF_B, Settings
from rosterweave.functions import similarity
from rosterweave.operators import fuzzy
from tests.conftest import REPORT_DATE

SCHEMA = (
    "ingest_ordinal long, employee_id string, source_system string, first_name string, "
    "last_name string, hire_date date, email string, country string, dedup_method string"
)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        above, row = row, [0]
        for j, other in enumerate(b):
            row.append(above[j] + 1 if ch == other else max(above[j + 1], row[j]))
    return row[-1]


def sorted_tokens(name):
    return " ".join(sorted(name.split()))


def people(seed, n_a, n_b):
    rng = random.Random(seed)
    firsts = ["Ann", "Anna", "Bo", "José", "Maximilian", "Al", "Ån", "Christopher", "", "Li"]
    lasts = ["Smith", "Smyth", "O'Neil", "Li", "Vandenberg", "Van Den Berg", "Y", "", "Smithe"]

    def typo(s):
        if s and rng.random() < 0.4:
            i = rng.randrange(len(s))
            s = rng.choice([s[:i] + s[i + 1 :], s[:i] + "x" + s[i:], s[:i] + "q" + s[i + 1 :]])
        return s

    rows = []
    for i in range(n_a + n_b):
        a = i < n_a
        day = None if rng.random() < 0.05 else dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(150))
        first = None if rng.random() < 0.03 else typo(rng.choice(firsts))
        rows.append((i, f"{'GT' if a else 'AC'}-{i:06d}", STAFF_A if a else STAFF_B, first,
                     typo(rng.choice(lasts)), day, f"e{i}", "X", "single_source"))
    return rows


def brute_force(rows, threshold, window):
    found = set()
    for b in rows:
        for a in rows:
            if b[2] != STAFF_B or a[2] != STAFF_A or None in (a[5], b[5], a[3], b[3]):
                continue
            if abs((a[5] - b[5]).days) > window:
                continue
            x = sorted_tokens(a[3].strip() + " " + a[4].strip())
            y = sorted_tokens(b[3].strip() + " " + b[4].strip())
            common, total = lcs(x, y), len(x) + len(y)
            if 200 * common >= threshold * total:
                found.add((b[1], a[1], round(200 * common / total if total else 100.0, 9)))
    return found


@pytest.mark.parametrize(
    "threshold,window,heavy",
    [(88, 30, 10**6), (88, 30, 2), (75, 10, 10**6), (60, 30, 10**6), (100, 20, 3)],
)
def test_pairs_equal_brute_force(spark, stage, threshold, window, heavy):
    rows = people(threshold + window, 120, 60)
    settings = Settings(REPORT_DATE, match_threshold=threshold, match_window_days=window, heavy_rows=heavy)
    emp = spark.createDataFrame(rows, SCHEMA)
    names = stage(fuzzy.similar_names(emp, settings), "names")
    pairs = fuzzy.probable_matches(emp, names, settings).collect()
    got = [(p.acq_employee_id, p.gt_employee_id, round(p.match_score, 9)) for p in pairs]
    want = brute_force(rows, threshold, window)
    assert want and len(got) == len(set(got))
    assert set(got) == want


def test_segments_never_miss_a_match(spark):
    rng = random.Random(5)
    texts = set()
    for _ in range(150):
        s = "".join(rng.choice("abé ") for _ in range(rng.randrange(0, 26)))
        texts.add(s)
        for _ in range(3):
            i = rng.randrange(len(s) + 1)
            texts.add(rng.choice([s[:i] + "z" + s[i:], s[:i] + s[i + 1 :], s[i:] + s[:i]]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for threshold in (70, 80, 88, 95):
        keyed = df.select(
            "t",
            similarity.indexed_segments(F.col("t"), threshold).alias("i"),
            similarity.probing_segments(F.col("t"), threshold).alias("p"),
        ).collect()
        for a in keyed:
            for b in keyed:
                if 200 * lcs(a.t, b.t) >= threshold * (len(a.t) + len(b.t)):
                    assert set(a.i) & set(b.p), (a.t, b.t, threshold)


def test_score_at_the_threshold(spark):
    rows = spark.createDataFrame([(22, 50), (22, 51), (0, 0)], "lcs int, lengths int")
    got = rows.select(
        similarity.score_reached(F.col("lcs"), F.col("lengths"), 88), similarity.score(F.col("lcs"), F.col("lengths"))
    ).collect()
    assert [tuple(r) for r in got] == [(True, 88.0), (False, 200.0 * 22 / 51), (True, 100.0)]


def test_report_counts_comparisons_without_making_them(spark, stage, settings):
    rows = people(9, 80, 40)
    emp = spark.createDataFrame(rows, SCHEMA)
    names = stage(fuzzy.similar_names(emp, settings), "names")
    pairs = stage(fuzzy.probable_matches(emp, names, settings), "pairs")
    report = fuzzy.fuzzy_report(emp, pairs, settings).first()
    dated = [(r[2], r[5]) for r in rows if r[5]]
    compared = sum(
        abs((a - b).days) <= 30 for s, a in dated if s == STAFF_A for t, b in dated if t == STAFF_B
    )
    assert report.details["total_comparisons"] == compared
    assert report.details["probable_match_pairs"] == len(brute_force(rows, 88, 30))
    flagged = fuzzy.flag_fuzzy(emp, pairs)
    n = flagged.where("dedup_method = 'fuzzy_name'").count()
    assert n == report.details["acqco_rows_flagged"] > 0 and flagged.count() == len(rows)


def test_one_company_only_reports_no_comparison(spark, settings):
    emp = spark.createDataFrame([r for r in people(1, 20, 5) if r[2] == STAFF_A], SCHEMA)
    names = fuzzy.similar_names(emp, settings)
    pairs = fuzzy.probable_matches(emp, names, settings)
    report = fuzzy.fuzzy_report(emp, pairs, settings).first()
    assert report.details == {"probable_match_pairs": 0, "acqco_rows_flagged": 0}


def test_lcs_of_names_of_all_lengths(spark):
    rng = random.Random(7)
    sizes = [0, 1, 2, 25, 61, 62, 63, 64, 124, 125, 190]
    rows = []
    for x in sizes:
        for y in sizes:
            a = "".join(rng.choice("abé ") for _ in range(x))
            b = "".join(rng.choice("abé ") for _ in range(y)) if rng.random() < 0.6 else a[: y // 2] + a[-y:][: y - y // 2]
            rows.append((a, b))
    rows += [("a" * 130, "a" * 200), ("ab" * 40, "ba" * 40)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", similarity.lcs_length(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in got] == [lcs(r.a, r.b) for r in got]


def test_a_hot_bucket_is_cut_on_both_sides(spark):
    rng = random.Random(8)
    made = lambda n: [("".join(rng.choice("ab") for _ in range(rng.randint(6, 9))), 1) for _ in range(n)]
    a, b = (spark.createDataFrame(made(n), "name_key string, bucket int").distinct() for n in (150, 120))
    whole = {tuple(r) for r in fuzzy.name_pairs(a, b, 80, 10**9).collect()}
    cut = fuzzy.name_pairs(a, b, 80, 50)
    assert {tuple(r) for r in cut.collect()} == whole and whole
    assert "_slice" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_low_thresholds_meet_by_length(spark):
    df = spark.createDataFrame([("", ), ("abcdefgh",)], "t string")
    got = df.select(
        similarity.indexed_segments(F.col("t"), 60), similarity.probing_segments(F.col("t"), 60)
    ).collect()
    assert got[0][0] == ["length:0"] and got[0][1] == ["length:0"]
    assert got[1][0] == ["length:8"] and got[1][1] == [f"length:{n}" for n in range(4, 19)]
    with pytest.raises(ValueError, match="threshold"):
        similarity.indexed_segments(F.col("t"), 0)


def test_few_rows_that_make_many_pairs_are_dealt_over_parts(spark, stage, settings):
    """The rows are in one file, and far too small for Spark to split their join by size."""
    day = dt.date(2000, 1, 1)
    rows = [
        (i, f"{i}", STAFF_A if i % 2 else STAFF_B, "Ann", "Smith", day + dt.timedelta(i % 400), "e", "X", "m")
        for i in range(400)
    ]
    emp = stage(spark.createDataFrame(rows, SCHEMA).coalesce(1), "emp")
    names = stage(fuzzy.similar_names(emp, settings), "names")
    pairs = fuzzy.probable_matches(emp, names, settings)
    per_part = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_part) > 1 and sum(per_part) == len(brute_force(rows, 88, 30))
