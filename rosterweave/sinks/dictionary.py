"""The schema of the golden table, and the data dictionary that is read off it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DataType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# How the dictionary writes types and nullability.
TYPE_NAMES = {"string": "string", "timestamp_ntz": "timestamp[ns]", "double": "double"}
NULLABLE = {True: "YES", False: "NO"}


def _column(
    name: str, meaning: str, kind: DataType | None = None, nullable: bool = True
) -> StructField:
    return StructField(name, kind or StringType(), nullable, {"comment": meaning})


#: Columns as they lie in the table: the folder column comes last.
GOLDEN_SCHEMA = StructType(
    [
        _column("employee_id", "Number of the person, behind the letters of the company", nullable=False),
        _column("source_system", "Staff master that the row was taken from", nullable=False),
        _column("first_name", "Given name with composed accents in standard case"),
        _column("last_name", "Family name with composed accents in standard case"),
        _column("email", "Mail address at work, unchanged"),
        _column("department", "Name from the department list, or the entry if it has none"),
        _column("job_title", "Position, unchanged"),
        _column("hire_date", "First day of employment", TimestampNTZType()),
        _column("country", "Where the person works"),
        _column("employment_type", "Extent and kind of the contract"),
        _column("employment_status", "Whether the person is working at present"),
        _column("manager_id", "employee_id of the superior; blank for nobody"),
        _column("first_name_raw", "Given name before it was put in standard case"),
        _column("last_name_raw", "Family name before it was put in standard case"),
        _column("source_systems", "Every source in which the id was met, by name", nullable=False),
        _column("dedup_method", "Pass that decided about the row", nullable=False),
        _column("full_name", "Given and family name, one blank between"),
        _column("tenure_years", "Length of employment up to the report date", DoubleType()),
        _column("company_origin", "Company of the staff master; names the folder", nullable=False),
    ]
)

_SAMPLE = {
    "employee_id": "AC-000417",
    "source_system": "AcquiredCo_HRIS",
    "first_name": "Zoë",
    "last_name": "MacBride",
    "full_name": "Zoë MacBride",
    "email": "zoe.macbride@b.example.com",
    "department": "Marketing",
    "job_title": "Editor",
    "hire_date": "2011-11-02",
    "country": "Iceland",
    "employment_type": "Part-Time",
    "employment_status": "On Leave",
    "manager_id": "AC-000052",
    "first_name_raw": "ZOË",
    "last_name_raw": "macbride",
    "source_systems": "acquiredco_hris,payroll",
    "dedup_method": "exact_id",
    "company_origin": "AcquiredCo",
    "tenure_years": "9.5",
}


def data_dictionary(spark: SparkSession) -> DataFrame:
    """One row per golden column, in the order of the table."""
    rows = [
        (
            field.name,
            TYPE_NAMES[field.dataType.simpleString()],
            field.metadata["comment"],
            _SAMPLE[field.name],
            NULLABLE[field.nullable],
        )
        for field in GOLDEN_SCHEMA
    ]
    return spark.createDataFrame(
        rows,
        "column_name string, data_type string, description string, example_value string, "
        "nullable string",
    )
