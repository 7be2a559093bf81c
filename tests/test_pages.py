"""Source files that queries write, and what is read of them by shorter ways."""

import glob
import gzip

from pyspark.sql import functions as F

from rosterweave.config import STAFF_A
from rosterweave.functions import ids
from rosterweave.sources import benefits_xml
from rosterweave.sources.common import RAW_RECORD
from workload import queries


def test_pages_are_compressed_and_named_in_order(spark, tmp_path):
    rows = spark.range(95).select(F.col("id").alias("ingest_ordinal"))
    line = F.col("ingest_ordinal").cast("string")
    queries.write_pages(
        rows, f"{tmp_path}/p", F.floor(F.col("ingest_ordinal") / 10), ["ingest_ordinal"], line, F.lit("#\n")
    )
    files = sorted(glob.glob(f"{tmp_path}/p/part-*"))
    assert len(files) == 10 and all(f.endswith(".gz") for f in files)
    pages = [gzip.open(f, "rt").read().split("\n") for f in files]
    assert [p[0] for p in pages] == ["10"] * 9 + ["5"]
    assert [int(x) for p in pages for x in p[1:] if x] == list(range(95))


def test_plain_elements_are_cut_and_others_read_as_xml(spark):
    e = "<enrollment>{}</enrollment>".format
    two = "<employee_id> 7</employee_id><premium_employee>{}</premium_employee>".format
    texts = [
        e(two("1.5")), e("\n  <employee_id>7</employee_id> "), e(two("")), e(two("  ")), e(two("a&amp;b")),
        e(two("<b>1</b>")), e(two("1\r\n")), e(two("1") + two("2")), e("<other>1</other>" + two("1")),
        e("<premium_employee>1</premium_employee><employee_id>7</employee_id>"), e(two("\x01")), e(""), e(two("]]>")),
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), f"n int, {RAW_RECORD} string")
    read = benefits_xml._read(rows)
    as_xml = F.from_xml(
        RAW_RECORD, f"{benefits_xml.string_columns(benefits_xml.COLUMNS)}, unreadable string",
        {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "unreadable", "rowTag": "enrollment"},
    )
    for row in read.select("n", "_e", as_xml.alias("xml")).collect():
        for c in [*benefits_xml.COLUMNS, "unreadable"]:
            assert (row["_e"][c] or "") == (row["xml"][c] or ""), (row.n, c)
    cut = rows.where(F.regexp_replace(RAW_RECORD, benefits_xml._SIMPLE, "") != F.col(RAW_RECORD))
    assert {r.n for r in cut.collect()} == {0, 1, 2, 11}


def test_ids_of_digits_are_padded_as_by_pattern(spark):
    given = {
        "": "", "7": "000007", "123456": "123456", "0000012": "000012", "1234567": "1234567",
        "01234567": "1234567", "0": "000000", "00000000": "000000", "12\n": "000012", "E-9": "000009", "E": "E",
    }
    rows = spark.createDataFrame([(k,) for k in given], "raw string")
    prefix = rows.select(ids.employee_id(F.lit("1"), F.lit(STAFF_A)).alias("id")).first().id[:-6]
    found = rows.select("raw", ids.employee_id(F.col("raw"), F.lit(STAFF_A)).alias("id")).collect()
    assert {r.raw: r.id for r in found} == {k: prefix + v for k, v in given.items()}


def test_pages_are_dealt_in_order_and_null_ordinals_stay(spark, tmp_path):
    """Parts follow the pages and are about as long, however unevenly pages are filled."""
    many = [(1,)] * 300 + [(i,) for i in range(100, 400)] + [(None,)]
    rows = spark.createDataFrame(many, "ingest_ordinal long")
    paged = rows.withColumn("_page", F.floor(F.col("ingest_ordinal") / 10))
    dealt = queries.in_page_ranges(paged).withColumn("at", F.spark_partition_id())
    found = dealt.groupBy("at").agg(
        F.min("_page").alias("low"), F.max("_page").alias("high"), F.count("*").alias("n")
    ).orderBy("at").collect()
    assert sum(r.n for r in found) == 601
    whole = [r for r in found if r.low is not None]
    assert all(a.high < b.low for a, b in zip(whole, whole[1:]))
    assert dealt.where("_page is null").count() == 1


def test_plain_chunks_are_cut_without_an_xml_reader(spark):
    """Chunks give the elements, ordinals and errors that splitting at start tags gives."""
    two = "<employee_id> 7</employee_id><premium_employee>{}</premium_employee>".format
    chunks = [
        f"\n<enrollment>{two('1.5')}", f"<enrollment>{two('1.5')}", f"some text <enrollment>\n {two('')} ",
        f"<enrollment>{two('12x')}", "<enrollment><employee_id> </employee_id>", "<enrollment>",
        f"<?xml?><benefits n='1'><enrollment>{two('2')}", f"<enrollment>{two('3')}<enrollment>{two('4')}",
        f"\x01<enrollment>{two('5')}", f"<enrollment a='1'>{two('6')}", "<enrollment a='1'/>", "\n</benefits>",
        f"<enrollments><enrollment>{two('7')}", f"<enrollment>{two('a&amp;b')}", f"<enrollment>{two('<b>1</b>')}",
    ]
    rows = spark.createDataFrame(list(enumerate(chunks)), "n int, value string")
    made = benefits_xml.elements_of(rows, "n")
    cut = made.where(f"{benefits_xml._OWN} is not null")
    assert sorted(r.n for r in cut.collect()) == [0, 1, 2, 3, 5]
    found = benefits_xml.parse_enrollments(made, "n").collect()
    raw = {
        n: [f"<enrollment{x}</enrollment>" for x in v.split("<enrollment")[1:] if x[0] in " >" and x[-2:] != "/>"]
        for n, v in enumerate(chunks)
    }
    raw[7] = [f"<enrollment>{two('3')}", f"<enrollment>{two('4')}</enrollment>"]
    listed = [(n, x) for n in raw for x in raw[n]]
    alone = spark.createDataFrame(listed, f"n int, {RAW_RECORD} string")
    wanted = benefits_xml.parse_enrollments(alone, "n").collect()
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    assert {r.n for r in found if r.error} == {3, 4, 5, 7, 13, 14}
