"""Shared by the readers: absent paths, ordinals, dead letters."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDINAL = "ingest_ordinal"
ERROR = "error"
RAW_RECORD = "raw_record"
FILE = "file"
LINES = "lines"  # how many lines of its file a CSV record takes
DEAD_LETTER_SCHEMA = "source string, raw_record string, error string"

# Staff A precedes staff B wherever both are in one table. Scan ordinals stay far below this.
STAFF_B_OFFSET = 1 << 62


def file_of_scan() -> Column:
    """The file that a row of a scan comes from."""
    return F.col("_metadata.file_path").alias(FILE)


_SMALL = 100_000  # parts of files whose places are broadcast at most


class Parsed(NamedTuple):
    """Usable rows and the dead letters of one source."""

    rows: DataFrame
    rejects: DataFrame


def absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """The scan, or an empty table with the schema when the path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if absent(error):
            return spark.createDataFrame([], schema)
        raise


def with_ordinal(df: DataFrame, offset: int = 0) -> DataFrame:
    """Unique and ascending within a file.

    The value depends on how the scan is split, so a job that joins on it stores the rows first
    (see ``rosterweave.plans.staging``).
    """
    return df.withColumn(ORDINAL, F.monotonically_increasing_id() + F.lit(offset))


def in_file_order(stored: DataFrame, offset: int = 0) -> DataFrame:
    """``stored`` with ordinals that follow the names of the files, and the rows within each.

    The ordinals it has ascend within a file only, as a scan deals files out by their size. ``stored``
    must be a stored table. A file is one part for each task that read some of it.
    """
    part = F.shiftright(F.col(ORDINAL) - F.lit(offset), 33).alias("_part")
    parts = stored.select(FILE, part).distinct()
    # One row per file and task, however long the files are.
    place = (F.row_number().over(Window.orderBy(FILE, "_part")) - 1).cast("long")
    parts = parts.withColumn("_place", place)
    if parts.count() <= _SMALL:
        parts = F.broadcast(parts)
    within = (F.col(ORDINAL) - F.lit(offset)).bitwiseAND((1 << 33) - 1)
    ordinal = F.lit(offset) + F.shiftleft("_place", 33) + within
    joined = stored.withColumn("_part", part).join(parts, [FILE, "_part"])
    return joined.withColumn(ORDINAL, ordinal).select(*stored.columns)


def split_rejects(parsed: DataFrame, source: str) -> Parsed:
    """Rows without an error, and the others as dead letters."""
    rows = parsed.where(F.col(ERROR).isNull()).drop(ERROR, RAW_RECORD, FILE, LINES)
    rejects = parsed.where(F.col(ERROR).isNotNull()).select(
        F.lit(source).alias("source"), RAW_RECORD, ERROR
    )
    return Parsed(rows, rejects)


def dead_letter_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source", "error").agg(F.count(F.lit(1)).alias("count"))


def string_columns(names: list[str]) -> str:
    return ", ".join(f"{n} string" for n in names)


