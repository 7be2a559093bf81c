"""One query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterweave.config import BENEFITS, PAYROLL, STAFF_A, STAFF_B, Settings
from rosterweave.functions import text, values
from rosterweave.operators import aggregates, align, clean, fuzzy, identity, quality, review
from rosterweave.operators.keep_one import split_latest
from rosterweave.plans.ingest import Sources, ingest_all
from rosterweave.plans.integrate import integrate
from rosterweave.plans.resolve import BENEFITS_KEY, BENEFITS_ORDER, Resolved, exact_passes
from rosterweave.plans.staging import Stage
from rosterweave.sinks import tables
from rosterweave.sources import benefits_xml, golden, payroll, staff_csv, staff_json
from rosterweave.sources.common import ERROR, RAW_RECORD, dead_letter_summary, split_rejects
from workload.fixtures import BENEFITS_TIES, fixture, table

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings(report_date=dt.date(2002, 1, 1))
CODEC = "gzip"  # of written source files; readers tell it by the file's name
BENEFITS_BY = [*BENEFITS_ORDER, *BENEFITS_TIES]
BENEFITS_ROW = ["ingest_ordinal", *BENEFITS_TIES]
FIGURES = [
    "headcount_company", "headcount_department", "headcount_country", "salary_distribution",
    "salary_matched_total", "salary_histogram", "tenure_stats", "tenure_histogram", "enrollment_rate", "check_bars",
]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums and interpolations differ in the last bits between engines."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# --- inputs ------------------------------------------------------------------------------------


def staff_a(spark, folder):
    return fixture(spark, folder, "fx_hris_a")


def staff_b(spark, folder):
    return fixture(spark, folder, "fx_hris_b")


def aligned(spark, folder):
    return align.align(staff_a(spark, folder), staff_b(spark, folder))


def employees(spark, folder):
    return clean.clean_employees(aligned(spark, folder), SETTINGS)


def pay(spark, folder):
    return clean.clean_payroll(fixture(spark, folder, "fx_payroll"), SETTINGS)


def benefits(spark, folder):
    return clean.clean_benefits(fixture(spark, folder, "fx_benefits"))


def ids_of_both(spark, folder, stage):
    """Ids of payroll and benefits, stored: membership needs no more, and keep-latest drops none."""
    paid = stage(clean.payroll_ids(fixture(spark, folder, "fx_payroll")), "payroll_ids")
    return paid, stage(clean.benefit_ids(fixture(spark, folder, "fx_benefits")), "benefit_ids")


def exact(spark, folder, stage=None, known=None):
    stage = stage or Stage(spark)
    emp = stage(employees(spark, folder), "clean_employees")
    return exact_passes(emp, *(known or ids_of_both(spark, folder, stage)), SETTINGS, stage)


def with_pairs(spark, folder, stage=None):
    stage = stage or Stage(spark)
    emp = exact(spark, folder, stage).employees
    return emp, matches(emp, stage)


def matches(emp, stage):
    names = stage(fuzzy.similar_names(emp, SETTINGS), "similar_names")
    return stage(fuzzy.probable_matches(emp, names, SETTINGS), "probable_matches")


def final_employees(spark, folder, stage=None):
    stage = stage or Stage(spark)
    return stage(fuzzy.flag_fuzzy(*with_pairs(spark, folder, stage)), "employees")


# --- sources -----------------------------------------------------------------------------------


def _record() -> Column:
    """A staff B record as nested JSON. Some suppliers get a record that lacks a field."""
    s = F.col("ingest_ordinal") % 1000

    def part(**fields: Column) -> Column:
        return F.struct(*[c.alias(k) for k, c in fields.items()])

    def lacks(n: int, value: Column) -> Column:
        return F.when(s % 11 != n, value)

    c = F.col
    nested = part(
        employee_identifier=lacks(3, c("employee_identifier")),
        name=lacks(5, part(first=c("first_name"), last=lacks(7, c("last_name")))),
        contact=part(email=c("email")),
        assignment=part(
            department=c("department"), role=c("role"), location=c("location"),
            hire_timestamp=c("hire_timestamp"),
        ),
        employment=part(type=c("employment_type"), status=c("employment_status")),
        manager_employee_id=F.when(s % 2 == 0, c("manager_employee_id")),
    )
    # to_json leaves null fields out; one record in eleven keeps a present null instead.
    json = F.to_json(nested)
    return F.when(s % 11 == 9, F.regexp_replace(json, '"email":"[^"]*"', '"email":null')).otherwise(json)


def staff_pages(spark: SparkSession, folder: str, size: int = 100) -> DataFrame:
    """Page documents of ``size`` records, as an API delivers them."""
    rows = staff_b(spark, folder).select(
        F.floor((F.col("ingest_ordinal") - 1_000_000_000) / size).alias("page"),
        _record().alias("record"),
    )
    listed = F.array_join(F.collect_list("record"), ",")
    return rows.groupBy("page").agg(
        F.concat(F.lit('{"employees":['), listed, F.lit("]}")).alias("value")
    )


def parsed_staff(spark, folder):
    """Stored before it is split, as in the job: text is parsed once."""
    records = staff_json.explode_pages(staff_pages(spark, folder))
    return Stage(spark)(staff_json.flatten_records(records), "staff_b")


@query
def staff_json_records(spark, folder):
    return split_rejects(parsed_staff(spark, folder), STAFF_B).rows


@query
def staff_json_scan(spark, folder):
    """Indented page files and JSON lines written from staff B, and read back by the file reader."""
    folder_out = Stage(spark).folder
    pages = staff_pages(spark, folder).select(
        F.regexp_replace("value", r'([{,\[])(["{])', "$1\n  $2").alias("value")
    )
    # One document per file: a page is split off by the writer after each row.
    pages.write.option("maxRecordsPerFile", 1).text(f"{folder_out}/pages")
    staff_b(spark, folder).select(_record()).write.text(f"{folder_out}/lines")
    both = [
        staff_json.parse_staff_json(spark, f"{folder_out}/pages").withColumn("form", F.lit("pages")),
        staff_json.parse_staff_json(spark, f"{folder_out}/lines", lines=True).withColumn(
            "form", F.lit("lines")
        ),
    ]
    parsed = Stage(spark)(both[0].unionByName(both[1]), "staff_b")
    return split_rejects(parsed, STAFF_B).rows.drop("ingest_ordinal")


@query
def staff_json_dead_letters(spark, folder):
    """The raw record is shown by its role and location; JSON texts order keys differently."""
    rejects = split_rejects(parsed_staff(spark, folder), STAFF_B).rejects
    raw = F.parse_json(RAW_RECORD)
    return rejects.select(
        "source",
        ERROR,
        F.variant_get(raw, "$.assignment.location", "string").alias("location"),
        F.variant_get(raw, "$.assignment.hire_timestamp", "string").alias("hire_timestamp"),
    )


@query
def props_dead_letters(spark, folder):
    """The required-field test on another JSON column: one event in seven lacks its key."""
    events = table(spark, folder, "events")
    renamed = F.regexp_replace("props", '"k"', '"other"')
    record = F.try_parse_json(F.when(F.col("event_id") % 7 == 0, renamed).otherwise(F.col("props")))
    checked = events.select("event_id", record.alias("record")).withColumn(
        ERROR, staff_json.missing_field(F.col("record"), "k")
    )
    return checked.where(F.col(ERROR).isNotNull()).select(
        "event_id", ERROR, F.to_json("record").alias(RAW_RECORD)
    )


def element(*tags):
    """An enrolment element; absent texts leave no tag."""
    parts = [F.concat(F.lit(f"<{t}>"), c, F.lit(f"</{t}>")) for t, c in tags]
    texts = [F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(F.lit("<enrollment>"), *texts, F.lit("</enrollment>"))


def money(c):
    return F.col(c).cast("decimal(18,2)").cast("string")


def enrollment_text():
    """An enrolment as an element. Some have a blank id, a missing or an unreadable premium, or
    cannot be read at all; some of these hold other tags too."""
    c, n = F.col, F.col("ingest_ordinal")
    return element(
        ("employee_id", F.when(n % 97 == 0, "  ").otherwise(F.concat(F.lit(" "), c("employee_id")))),
        ("plan_type", F.when(n % 79 == 0, "A &bad; ").otherwise(c("plan_type"))),
        ("coverage_level", F.when(n % 5 != 0, c("coverage_level"))),
        ("note", F.when(n % 97 == 0, 'keep <b k="1">me</b>')),
        ("enrollment_date", c("enrollment_date")),
        ("premium_employee", F.when(n % 89 == 0, "12x").when(n % 7 == 0, "").otherwise(money("premium_employee"))),
        ("premium_employer", F.when(n % 83 == 0, "n/a").when(n % 3 != 0, money("premium_employer"))),
    )


def enrollment_texts(spark, folder):
    fx = fixture(spark, folder, "fx_benefits")
    return fx.select("ingest_ordinal", enrollment_text().alias(RAW_RECORD))


def parsed_enrollments(spark, folder):
    stage = Stage(spark)
    elements = enrollment_texts(spark, folder)
    parsed = stage(benefits_xml.parse_enrollments(elements, "ingest_ordinal"), "benefits")
    return split_rejects(parsed, BENEFITS)


@query
def enrollment_records(spark, folder):
    return parsed_enrollments(spark, folder).rows


@query
def dead_letters_by_error(spark, folder):
    both = split_rejects(parsed_staff(spark, folder), STAFF_B).rejects.unionByName(
        parsed_enrollments(spark, folder).rejects
    )
    return dead_letter_summary(both)


def in_page_ranges(df):
    """``df`` in as many parts as shuffles have, by ranges of ``_page`` of about as many rows each.

    The rows of each page are counted first, which reads no other column; a sort by ranges would work
    out whole rows once more to sample them.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.groupBy("_page").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_page")) - F.col("_rows")
    total = F.sum("_rows").over(Window.partitionBy())
    # One row per page; stored, so that its size decides how it is joined.
    parts = rows.select("_page", F.floor(before * n / total).cast("int").alias("_part"))
    parts = Stage(df.sparkSession)(parts.withColumnRenamed("_page", "_of"), "pages")
    placed = df.join(parts, F.col("_page").eqNullSafe(F.col("_of"))).drop("_of")
    return placed.repartitionById(n, "_part")


def write_pages(df, path, page, order, line, head, join="\n", tail=""):
    """Text files of the lines of a page each, in order; the files' names follow the pages.

    A page is a range of ordinals, so it holds a bounded number of lines. Rows are dealt by ranges of
    pages before they become lines, so that one shuffle of their columns does, and the files are
    compressed. The number of parts is fixed: a part names no more than 1,000 files in order.
    """
    dealt = in_page_ranges(df.withColumn("_page", page))
    lines = F.sort_array(F.collect_list(F.struct(*order, line.alias("_line"))))
    texts = dealt.groupBy("_part", "_page", head.alias("_head")).agg(
        F.array_join(F.transform(lines, lambda x: x["_line"]), join).alias("_lines"),
        F.count("*").alias("_n"),
    )
    value = F.concat(F.replace("_head", F.lit("#"), F.col("_n").cast("string")), "_lines", F.lit(tail))
    written = texts.sortWithinPartitions("_page").select(value.alias("value")).write
    written = written.option("maxRecordsPerFile", 1).option("compression", CODEC)
    written.option("zlib.compress.level", "BEST_SPEED").text(path)


def csv_line(columns):
    def cell(c):
        quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(F.col(c).rlike('[",\n\r]'), quoted).otherwise(F.col(c)), F.lit(""))

    return F.concat_ws(",", *[cell(c) for c in columns])


def csv_damage(spared):
    """How a record is damaged: a quote that stays open, a cell too few or too many, or not at all.

    Records with a line break (ordinals that end in ``spared``) are left alone.
    """
    n = F.col("ingest_ordinal")
    return F.when(n % 10 == spared, "none").when(n % 101 == 3, "open").when(n % 103 == 5, "short").when(
        n % 107 == 7, "surplus"
    ).otherwise("none")


def damaged_line(line, damage):
    first = F.substring_index(line, ",", 1)
    behind = F.substr(line, F.length(first) + 2)
    return (
        F.when(damage == "open", F.concat(first, F.lit(',"'), behind))
        .when(damage == "short", F.regexp_replace(line, ",[^,]*$", ""))
        .when(damage == "surplus", F.concat(line, F.lit(",more")))
        .otherwise(line)
    )


def write_csv_pages(rows, path, spared=None, size=500):
    """Pages of CSV, with the columns the other way round in every second one, some records damaged."""
    columns = [c for c in rows.columns if c != "ingest_ordinal"]
    page = F.floor(F.col("ingest_ordinal") / size)

    def either(form):
        return F.when(page % 2 == 0, form(columns)).otherwise(form(columns[::-1]))

    line = either(csv_line)
    if spared is not None:
        line = damaged_line(line, csv_damage(spared))
    head = either(lambda cs: F.lit(",".join(cs) + "\n"))
    write_pages(rows, path, page, ["ingest_ordinal"], line, head)


def raw_staff(spark, folder):
    """Staff A with line breaks in names."""
    rows = staff_a(spark, folder)
    broken = F.when(F.col("ingest_ordinal") % 10 == 4, F.concat("first_name", F.lit("\n"), "last_name"))
    return rows.withColumn("first_name", F.coalesce(broken, "first_name"))


def raw_payroll(spark, folder):
    """Payroll with line breaks in a column."""
    rows = fixture(spark, folder, "fx_payroll").withColumn("bonus_target_pct", F.lit("2.5"))
    broken = F.when(F.col("ingest_ordinal") % 10 == 7, F.concat(F.lit("a\nb "), "pay_frequency"))
    return rows.withColumn("pay_frequency", F.coalesce(broken, "pay_frequency"))


def parsed_csv(spark, folder):
    """Staff A and payroll written as CSV with damaged records, and parsed."""
    stage = Stage(spark)
    write_csv_pages(raw_staff(spark, folder), f"{stage.folder}/raw/staff", 4)
    write_csv_pages(raw_payroll(spark, folder), f"{stage.folder}/raw/payroll", 7)
    staff = staff_csv.parse_staff_csv(spark, f"{stage.folder}/raw/staff", stage.within("staff"))
    paid = payroll.parse_payroll(spark, f"{stage.folder}/raw/payroll", stage.within("payroll"))
    return (
        split_rejects(stage(staff, "staff_rows"), STAFF_A),
        split_rejects(stage(paid, "payroll_rows"), PAYROLL),
    )


@query
def staff_csv_scan(spark, folder):
    """Staff A read back from CSV with line breaks, two column orders and damaged records."""
    return parsed_csv(spark, folder)[0].rows.drop("ingest_ordinal")


@query
def payroll_csv_scan(spark, folder):
    """Payroll read back from such CSV; 'n/a' cells arrive as null."""
    return parsed_csv(spark, folder)[1].rows.drop("ingest_ordinal")


@query
def csv_dead_letters(spark, folder):
    """The damaged records of both, as they stand in their files."""
    staff, paid = parsed_csv(spark, folder)
    both = staff.rejects.unionByName(paid.rejects)
    text = F.regexp_extract(RAW_RECORD, r"\Apart-[^:]*\.txt\.\w+: (?s:(.*))", 1)
    return both.select("source", ERROR, text.alias(RAW_RECORD))


def write_enrollments(rows, text, path, size=10_000, ties=()):
    page = F.floor(F.col("ingest_ordinal") / size)
    write_pages(
        rows, path, page, ["ingest_ordinal", *ties], text, F.lit('<?xml version="1.0"?>\n<benefits n="#">\n'),
        tail="\n</benefits>",
    )


@query
def enrollment_xml_scan(spark, folder):
    """Enrolments written as XML pages, damaged ones among them, and read back."""
    return parsed_xml(spark, folder).rows.drop("ingest_ordinal")


@query
def enrollment_dead_letters(spark, folder):
    """The unusable elements of those pages, as they stand in their files."""
    return parsed_xml(spark, folder).rejects


def parsed_xml(spark, folder):
    stage = Stage(spark)
    write_enrollments(fixture(spark, folder, "fx_benefits"), enrollment_text(), f"{stage.folder}/raw")
    parsed = stage(benefits_xml.parse_benefits_xml(spark, f"{stage.folder}/raw"), "benefits")
    return split_rejects(parsed, BENEFITS)


def write_staff_pages(spark, folder, path, record, size=100):
    """Page documents of ``size`` records, named in their order, that tell how many they hold."""
    page = F.floor((F.col("ingest_ordinal") - 1_000_000_000) / size)
    rows = staff_b(spark, folder)
    head = F.lit('{"total_records": #, "employees": [\n')
    write_pages(rows, path, page, ["ingest_ordinal"], record, head, ",\n", "]}")


@query
def ingest_report(spark, folder):
    """All four sources written as pages with damaged records, and what became of every file."""
    stage = Stage(spark)
    raw = f"{stage.folder}/raw"
    write_csv_pages(raw_staff(spark, folder), f"{raw}/staff_a", 4)
    write_csv_pages(raw_payroll(spark, folder), f"{raw}/payroll", 7)
    write_staff_pages(spark, folder, f"{raw}/staff_b", _record())
    write_enrollments(fixture(spark, folder, "fx_benefits"), enrollment_text(), f"{raw}/benefits")
    sources = Sources(f"{raw}/staff_a", f"{raw}/staff_b", f"{raw}/payroll", f"{raw}/benefits")
    return ingest_all(spark, sources, stage).report


@query
def payroll_repeated_ids(spark, folder):
    return payroll.repeated_ids(fixture(spark, folder, "fx_payroll"))


# --- alignment ---------------------------------------------------------------------------------


@query
def align_staff(spark, folder):
    return aligned(spark, folder)


@query
def unknown_codes(spark, folder):
    a = align.unknown_types_a(staff_a(spark, folder)).withColumn("company", F.lit("a"))
    b = align.unknown_types_b(staff_b(spark, folder)).withColumn("company", F.lit("b"))
    return a.unionByName(b)


# --- cleaning ----------------------------------------------------------------------------------


@query
def clean_names(spark, folder):
    return employees(spark, folder).select(
        "ingest_ordinal", "first_name", "last_name", "first_name_raw", "last_name_raw"
    )


@query
def name_case_words(spark, folder):
    """The name rules on every distinct word of the documents, in all their languages."""
    words = (
        table(spark, folder, "documents")
        .select(F.explode(F.split("text", r"[^\p{L}\p{M}'-]+")).alias("word"))
        .where("word <> ''")
        .distinct()
    )
    composed = words.withColumn("composed", text.compose_accents(F.col("word")))
    return composed.select("word", text.name_case(F.col("composed")).alias("name"))


@query
def namespace_ids(spark, folder):
    return employees(spark, folder).select(
        "ingest_ordinal", "employee_id", "manager_id", "employee_id_raw"
    )


@query
def parse_dates(spark, folder):
    staff = staff_a(spark, folder).select(
        F.lit("staff").alias("kind"), "ingest_ordinal",
        values.parse_hire_date(F.col("hire_date")).alias("parsed"),
    )
    paid = fixture(spark, folder, "fx_payroll").select(
        F.lit("payroll").alias("kind"), "ingest_ordinal",
        values.parse_date(F.col("effective_date")).alias("parsed"),
    )
    return staff.unionByName(paid)


@query
def payroll_usd_annual(spark, folder):
    return clean.payroll_steps(fixture(spark, folder, "fx_payroll"), SETTINGS).select(
        "ingest_ordinal", "employee_id", "base_salary", "base_salary_usd", "salary_usd_annual"
    )


@query
def payroll_usd_annual_with_gbp(spark, folder):
    """The rates are an input: with a third one the GBP salaries convert as well."""
    rates = {**SETTINGS.fx_rates, "GBP": 1.27}
    settings = Settings(report_date=SETTINGS.report_date, fx_rates=rates)
    return clean.payroll_steps(fixture(spark, folder, "fx_payroll"), settings).select(
        "ingest_ordinal", "base_salary_usd", "salary_usd_annual"
    )


@query
def map_departments(spark, folder):
    return employees(spark, folder).select("ingest_ordinal", "department")


@query
def unmapped_departments(spark, folder):
    return clean.unmapped_departments(aligned(spark, folder), SETTINGS)


@query
def nulls_by_source(spark, folder):
    emp = employees(spark, folder)
    return reduce(
        DataFrame.unionByName,
        [
            clean.nulls_by_source(emp, c).withColumn("column", F.lit(c))
            for c in ("department", "country")
        ],
    )


@query
def unlisted_currencies(spark, folder):
    return clean.unlisted_currencies(fixture(spark, folder, "fx_payroll"))


@query
def clean_reports(spark, folder):
    reports = clean.clean_reports(
        aligned(spark, folder),
        fixture(spark, folder, "fx_payroll"),
        fixture(spark, folder, "fx_benefits"),
        SETTINGS,
    )
    return counter_rows(reports, "source", CLEAN_COUNTS, "fixes_applied", "issues_flagged")


CLEAN_COUNTS = ("input_rows", "output_rows", "rows_dropped")
PASS_COUNTS = ("input_rows", "output_rows", "rows_removed", "rows_quarantined")


def counter_rows(reports, name, fixed, *maps):
    """A row per counter of each report."""
    rows = F.map_from_arrays(F.array(*[F.lit(c) for c in fixed]), F.array(*fixed))
    return reports.select(name, F.explode(F.map_concat(rows, *maps)).alias("counter", "value"))


@query
def payroll_latest(spark, folder):
    return pay(spark, folder)


# --- de-duplication ----------------------------------------------------------------------------


@query
def benefits_current(spark, folder):
    return split_latest(benefits(spark, folder), BENEFITS_KEY, BENEFITS_BY, BENEFITS_ROW).current


@query
def benefits_history(spark, folder):
    cleaned = Stage(spark)(benefits(spark, folder), "clean_benefits")
    return split_latest(cleaned, BENEFITS_KEY, BENEFITS_BY, BENEFITS_ROW).history


def resolved_ids(spark, folder, stage):
    emp = stage(employees(spark, folder), "clean_employees")
    return emp, identity.resolve_ids(emp, *ids_of_both(spark, folder, stage), SETTINGS)


@query
def pass1_resolved(spark, folder):
    return identity.kept_rows(resolved_ids(spark, folder, Stage(spark))[1])


@query
def pass1_quarantine(spark, folder):
    stage = Stage(spark)
    emp, resolved = resolved_ids(spark, folder, stage)
    return identity.colliding_rows(emp, stage(resolved, "resolved_ids"), SETTINGS)


@query
def pass2_resolved(spark, folder):
    return exact(spark, folder).employees


@query
def pass2_quarantine(spark, folder):
    return exact(spark, folder).email_quarantine


@query
def fuzzy_pairs(spark, folder):
    pairs = with_pairs(spark, folder)[1]
    return long(rounded(pairs, 6, "match_score"), "hire_date_delta_days")


@query
def fuzzy_flagged(spark, folder):
    return fuzzy.flag_fuzzy(*with_pairs(spark, folder)).select("employee_id", "dedup_method")


@query
def probable_match_review(spark, folder):
    return long(review.match_review(with_pairs(spark, folder)[1]), "hire_date_diff_days")


@query
def ghosts(spark, folder):
    return identity.ghost_employees(pay(spark, folder), exact(spark, folder).employees)


@query
def ghost_report(spark, folder):
    return review.ghost_report(ghosts(spark, folder))


@query
def unpaid_employees(spark, folder):
    return identity.unpaid_employees(pay(spark, folder), exact(spark, folder).employees)


@query
def dedup_reports(spark, folder):
    stage = Stage(spark)
    done = exact(spark, folder, stage)
    pairs = matches(done.employees, stage)
    paid = stage(pay(spark, folder), "payroll")
    reports = (
        done.reports.unionByName(fuzzy.fuzzy_report(done.employees, pairs, SETTINGS))
        .unionByName(
            identity.ghosts_report(
                paid,
                identity.ghost_employees(paid, done.employees),
                identity.unpaid_employees(paid, done.employees),
            )
        )
    )
    return counter_rows(reports, "pass_name", PASS_COUNTS, "details")


@query
def value_counts(spark, folder):
    emp = final_employees(spark, folder)
    return reduce(
        DataFrame.unionByName,
        [
            aggregates.value_counts(emp, c).select(
                F.lit(c).alias("column"), F.col(c).alias("value"), "rows"
            )
            for c in ("dedup_method", "source_systems")
        ],
    )


# --- quality -----------------------------------------------------------------------------------


def report(spark, folder):
    stage = Stage(spark)
    data = {
        "employees": final_employees(spark, folder, stage),
        "payroll": stage(pay(spark, folder), "payroll"),
    }
    return quality.quality_report(data, quality.default_checks(SETTINGS))


@query
def dq_report(spark, folder):
    return long(report(spark, folder), "check_no")


@query
def dq_summary(spark, folder):
    return quality.summary(report(spark, folder), SETTINGS.max_failed_checks)


@query
def dq_check_bars(spark, folder):
    return long(aggregates.check_bars(report(spark, folder)), "check_no")


@query
def orphan_managers(spark, folder):
    emp = exact(spark, folder).employees
    return quality.orphans(emp, "manager_id", emp)


# --- figures -----------------------------------------------------------------------------------


@query
def headcount_department(spark, folder):
    return aggregates.headcount_by_department(exact(spark, folder).employees)


@query
def headcount_country_top20(spark, folder):
    return aggregates.headcount_by_country(exact(spark, folder).employees)


@query
def headcount_company(spark, folder):
    return aggregates.headcount_by_company(exact(spark, folder).employees)


def salaries(spark, folder):
    stage = Stage(spark)
    return stage(pay(spark, folder), "payroll"), exact(spark, folder, stage).employees


@query
def salary_distribution(spark, folder):
    found = aggregates.salary_distribution(*salaries(spark, folder), Stage(spark))
    return rounded(found, 4, "min", "max", "q1", "median", "q3")


@query
def salary_matched_total(spark, folder):
    return aggregates.matched_total(*salaries(spark, folder))


@query
def salary_histogram(spark, folder):
    return long(aggregates.salary_histogram(*salaries(spark, folder)), "bin")


@query
def tenure_stats(spark, folder):
    found = aggregates.tenure_stats(exact(spark, folder).employees, SETTINGS.report_date)
    return rounded(found, 6, *[c for c in found.columns if c != "n"])


@query
def tenure_histogram(spark, folder):
    found = aggregates.tenure_histogram(exact(spark, folder).employees, SETTINGS.report_date)
    return long(rounded(found, 6, "from_years", "to_years"), "bin")


@query
def enrollment_rate(spark, folder):
    stage = Stage(spark)
    known = ids_of_both(spark, folder, stage)
    emp = exact(spark, folder, stage, known).employees
    return rounded(aggregates.enrollment_rate(emp, known[1]), 6, "rate_percent")


# --- golden table ------------------------------------------------------------------------------


@query
def golden_employees(spark, folder):
    return review.golden_employees(final_employees(spark, folder), SETTINGS)


@query
def golden_company_rows(spark, folder):
    """The golden table written, and one company read back through its partition."""
    stage = Stage(spark)
    path = tables.write_golden(final_employees(spark, folder, stage), SETTINGS, stage.folder)
    company_b = golden.read_golden(spark, path, "AcquiredCo")
    return company_b.select(
        "employee_id", F.col("hire_date").cast("date").alias("hire_date"), "company_origin"
    )


@query
def golden_round_trip(spark, folder):
    """The golden table written and read back, all columns of both companies."""
    stage = Stage(spark)
    path = tables.write_golden(final_employees(spark, folder, stage), SETTINGS, stage.folder)
    return golden.read_golden(spark, path)


@query
def data_dictionary(spark, folder):
    """The dictionary as written, next to how many rows of the written table lack each column."""
    stage = Stage(spark)
    path = tables.write_golden(final_employees(spark, folder, stage), SETTINGS, stage.folder)
    table_ = golden.read_golden(spark, path)
    lacking = table_.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table_.columns])
    lacking = lacking.unpivot([], table_.columns, "column_name", "nulls")
    written = spark.read.option("header", True).csv(tables.write_dictionary(spark, stage.folder))
    return written.join(lacking, "column_name").select(
        "column_name", "data_type", "nullable", "nulls"
    )


@query
def ghost_extract(spark, folder):
    """The ghost extract written as CSV and read back."""
    path = tables.write_ghosts(ghosts(spark, folder), Stage(spark).folder)
    return _read_csv(spark, path, review.ghost_report(ghosts(spark, folder)).schema)


@query
def match_extract(spark, folder):
    """The match review written as CSV, best first, and read back with each row's place."""
    stage = Stage(spark)
    pairs = with_pairs(spark, folder, stage)[1]
    path = tables.write_match_review(pairs, stage.folder)
    read = _read_csv(spark, path, review.match_review(pairs).schema).select(
        "*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    read = stage(read, "match_review")
    sizes = read.groupBy("file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file")) - F.col("n")
    in_file = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    placed = read.withColumn("in_file", in_file).join(sizes.select("file", before.alias("before")), "file")
    placed = placed.withColumn("place", F.col("before") + F.col("in_file"))
    return long(placed.drop("file", "at", "in_file", "before"), "hire_date_diff_days")


@query
def validation_csv(spark, folder):
    """The quality report written as CSV and read back."""
    stage, found = Stage(spark), report(spark, folder)
    tables.write_quality_report(found, SETTINGS, stage.folder)
    return _read_csv(spark, f"{stage.folder}/validation_report", found.drop("check_no").schema)


def _read_csv(spark, path, schema):
    return spark.read.schema(schema).option("header", True).csv(path)


@query
def figures_written(spark, folder):
    """Every figure table of the job, with the number of rows that were written."""
    stage = Stage(spark)
    emp = final_employees(spark, folder, stage)
    paid = stage(pay(spark, folder), "payroll")
    # The figures read three tables of the resolved ones.
    resolved = Resolved(emp, paid, benefits(spark, folder), *[None] * 6)
    found = quality.quality_report(
        {"employees": emp, "payroll": paid}, quality.default_checks(SETTINGS)
    )
    tables.write_figures(resolved, stage(found, "report"), SETTINGS, stage.folder)
    counts = [
        spark.read.parquet(f"{stage.folder}/figures/{name}").agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("figure"), "rows"
        )
        for name in FIGURES
    ]
    return reduce(DataFrame.unionByName, counts)


_JOBS: dict[tuple[str, str], str] = {}


def job_output(spark, folder):
    """Where the whole job wrote its outputs; it runs once per session and data set.

    All sources are written as pages whose names follow their order, and read back by the job.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _JOBS:
        stage = Stage(spark)
        raw, out, c = f"{stage.folder}/raw", f"{stage.folder}/out", F.col
        write_csv_pages(staff_a(spark, folder), f"{raw}/staff_a")
        paid = fixture(spark, folder, "fx_payroll").withColumn("bonus_target_pct", F.lit("2.5"))
        write_csv_pages(paid, f"{raw}/payroll", size=5_000)
        premiums = [(p, money(p)) for p in benefits_xml.PREMIUMS]
        whole = element(*[(t, c(t)) for t in benefits_xml.TEXTS], *premiums)
        enrolled = fixture(spark, folder, "fx_benefits")
        write_enrollments(enrolled, whole, f"{raw}/benefits", 50_000, BENEFITS_TIES)
        record = F.struct(
            "employee_identifier",
            F.struct(c("first_name").alias("first"), c("last_name").alias("last")).alias("name"),
            F.struct("email").alias("contact"),
            F.struct("department", "role", "location", "hire_timestamp").alias("assignment"),
            F.struct(
                c("employment_type").alias("type"), c("employment_status").alias("status")
            ).alias("employment"),
            "manager_employee_id",
        )
        write_staff_pages(spark, folder, f"{raw}/staff_b", F.to_json(record))
        sources = Sources(f"{raw}/staff_a", f"{raw}/staff_b", f"{raw}/payroll", f"{raw}/benefits")
        integrate(spark, sources, out, SETTINGS, respect_gate=False, stage=stage)
        _JOBS[key] = out
    return _JOBS[key]


def job_table(spark, folder, name):
    return spark.read.parquet(f"{job_output(spark, folder)}/{name}")


@query
def integrate_golden(spark, folder):
    """The golden table of the whole job."""
    return golden.read_golden(spark, f"{job_output(spark, folder)}/golden_employees")


@query
def integrate_id_quarantine(spark, folder):
    return job_table(spark, folder, "id_quarantine").drop("ingest_ordinal")


@query
def integrate_email_quarantine(spark, folder):
    return job_table(spark, folder, "email_quarantine").drop("ingest_ordinal")


@query
def integrate_benefits(spark, folder):
    return job_table(spark, folder, "benefits").drop("ingest_ordinal")


@query
def integrate_benefits_history(spark, folder):
    return job_table(spark, folder, "benefits_history").drop("ingest_ordinal")


@query
def integrate_clean_reports(spark, folder):
    return counter_rows(job_table(spark, folder, "reports/clean"), "source", CLEAN_COUNTS, "fixes_applied", "issues_flagged")


@query
def integrate_pass_reports(spark, folder):
    return counter_rows(job_table(spark, folder, "reports/passes"), "pass_name", PASS_COUNTS, "details")


@query
def integrate_ingest_report(spark, folder):
    return job_table(spark, folder, "reports/ingest")


@query
def integrate_validation(spark, folder):
    kinds = (
        "check string, description string, total long, passed long, failed long, pass_rate double,"
        " status string"
    )
    return _read_csv(spark, f"{job_output(spark, folder)}/validation_report", kinds)


@query
def integrate_ghosts(spark, folder):
    # Only the schema is wanted here, so nothing is resolved a second time: the job's golden table stands in.
    out = job_output(spark, folder)
    found = identity.ghost_employees(pay(spark, folder), golden.read_golden(spark, f"{out}/golden_employees"))
    return _read_csv(spark, f"{out}/ghost_employees", review.ghost_report(found).schema)


@query
def rows_per_company(spark, folder):
    written = review.golden_employees(exact(spark, folder).employees, SETTINGS)
    return aggregates.value_counts(written, "company_origin")


