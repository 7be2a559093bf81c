"""Staff master of company B: nested JSON records, in page documents or one per line.

VARIANT keeps apart what a typed schema merges: a key that is absent, and a key that is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.sources.common import (
    ERROR,
    FILE,
    RAW_RECORD,
    STAFF_B_OFFSET,
    file_of_scan,
    read_or_empty,
    with_ordinal,
)

# Output column -> path in the record, in the order the fields are looked up.
REQUIRED = {
    "employee_identifier": "employee_identifier",
    "first_name": "name.first",
    "last_name": "name.last",
    "email": "contact.email",
    "department": "assignment.department",
    "role": "assignment.role",
    "location": "assignment.location",
    "hire_timestamp": "assignment.hire_timestamp",
    "employment_type": "employment.type",
    "employment_status": "employment.status",
}
OPTIONAL = {"full_name": "name.full", "manager_employee_id": "manager_employee_id"}


def _leaf(record: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(record, "$." + path, kind)


def missing_field(record: Column, path: str) -> Column:
    """Error text when the path leads nowhere, else null. A present JSON null is a value."""
    parent, _, key = path.rpartition(".")
    absent = F.lit(f"Missing field: '{key}'")
    if parent:
        # No parent at all names the parent; a parent that is no object cannot hold the key.
        holder = _leaf(record, parent)
        absent = (
            F.when(holder.isNull(), f"Missing field: '{parent}'")
            .when(
                F.schema_of_variant(holder).startswith("OBJECT"),
                absent,
            )
            .otherwise(f"Missing field: '{parent}' is not an object")
        )
    return F.when(_leaf(record, path).isNull(), absent)


# What is read of a page: its records stay text, so a page may be larger than a VARIANT.
PAGE = "total_records long, employees array<string>, _unreadable string"
_PAGE_OPTIONS = {"columnNameOfCorruptRecord": "_unreadable"}
BAD_PAGE = "Page is not JSON with a list under 'employees'"
BAD_RECORD = "Record is not JSON"


def explode_pages(pages: DataFrame, *keep: str) -> DataFrame:
    """``record, text, fault`` of page documents ``{"employees": [...]}`` in the column ``value``.

    A page that is not JSON, or has no list under ``employees``, is one row with its text and a
    fault; so is a record that cannot be read. A page with an empty list has no rows.
    """
    page = F.from_json("value", PAGE, _PAGE_OPTIONS)
    opened = pages.select(*keep, "value", page.alias("_page"))
    usable = F.col("_page._unreadable").isNull() & F.col("_page.employees").isNotNull()

    def item(text: Column, fault: Column) -> Column:
        return F.struct(text.alias("text"), fault.alias("fault"))

    none = F.lit(None).cast("string")
    records = F.transform("_page.employees", lambda x: item(x, none))
    items = F.when(usable, records).otherwise(F.array(item(F.col("value"), F.lit(BAD_PAGE))))
    texts = opened.select(*keep, F.explode(items).alias("_item")).select(*keep, "_item.*")
    return _parsed_records(texts, *keep)


def parse_lines(lines: DataFrame, *keep: str) -> DataFrame:
    """``record, text, fault`` of JSON lines in the column ``value``, files split; blank lines go."""
    texts = lines.where(F.trim("value") != "").select(
        *keep, F.col("value").alias("text"), F.lit(None).cast("string").alias("fault")
    )
    return _parsed_records(texts, *keep)


def _parsed_records(texts: DataFrame, *keep: str) -> DataFrame:
    record = F.when(F.col("fault").isNull(), F.try_parse_json("text"))
    return texts.select(*keep, record.alias("record"), "text", "fault").withColumn(
        "fault", F.when(F.col("record").isNull(), F.coalesce("fault", F.lit(BAD_RECORD)))
    )


def expected_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, total_records``: how many records each page document says it has."""

    def scan() -> DataFrame:
        pages = spark.read.schema("total_records long").json(path, multiLine=True)
        return pages.select(file_of_scan(), "total_records")

    return read_or_empty(spark, scan, f"{FILE} string, total_records long")


def flatten_records(records: DataFrame, *keep: str) -> DataFrame:
    """Twelve text columns, and an error with the raw record where a required field is absent.

    A fault of the record or its page is the error; the raw record is then the text as it came.
    """
    record = F.col("record")
    fields = [_leaf(record, p, "string").alias(c) for c, p in REQUIRED.items()]
    fields += [
        # Optional: absent gives '', a present null stays null.
        F.when(_leaf(record, p).isNull(), "").otherwise(_leaf(record, p, "string")).alias(c)
        for c, p in OPTIONAL.items()
    ]
    error = F.coalesce("fault", *[missing_field(record, p) for p in REQUIRED.values()])
    flat = records.select(*keep, *fields, error.alias(ERROR), "record", "text")
    raw = F.when(F.col(ERROR).isNotNull(), F.coalesce(F.to_json("record"), "text", F.lit("null")))
    return flat.withColumn(RAW_RECORD, raw).drop("record", "text")


def parse_staff_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Flattened records with ordinals and errors. Store the result, then ``split_rejects`` it."""

    def scan() -> DataFrame:
        return spark.read.text(path, wholetext=not lines).select("value", file_of_scan())

    text = read_or_empty(spark, scan, f"value string, {FILE} string")
    records = parse_lines(text, FILE) if lines else explode_pages(text, FILE)
    return flatten_records(with_ordinal(records, STAFF_B_OFFSET), FILE, "ingest_ordinal")
