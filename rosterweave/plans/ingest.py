"""Read all sources into aligned tables and one table of dead letters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.config import BENEFITS, PAYROLL, STAFF_A, STAFF_B
from rosterweave.operators.align import align
from rosterweave.plans.staging import Stage
from rosterweave.sources.benefits_xml import expected_elements, parse_benefits_xml
from rosterweave.sources.common import (
    ERROR,
    FILE,
    LINES,
    STAFF_B_OFFSET,
    in_file_order,
    split_rejects,
)
from rosterweave.sources.csv_records import expected_lines
from rosterweave.sources.payroll import parse_payroll
from rosterweave.sources.staff_csv import parse_staff_csv
from rosterweave.sources.staff_json import expected_records, parse_staff_json


@dataclass(frozen=True)
class Sources:
    """Paths of the four sources; each may be a file, a folder or a pattern.

    ``csv_multiline`` lets quoted CSV cells hold line breaks.
    """

    staff_csv: str
    staff_json: str
    payroll: str
    benefits_xml: str
    staff_json_lines: bool = False
    payroll_format: str = "csv"
    csv_encoding: str = "UTF-8"
    csv_multiline: bool = True


class Ingested(NamedTuple):
    employees: DataFrame
    payroll: DataFrame
    benefits: DataFrame
    dead_letters: DataFrame
    report: DataFrame


def ingest_report(stored: dict[str, DataFrame], expected: dict[str, DataFrame]) -> DataFrame:
    """``source, unit, expected, accounted, rows_read, dead_letters, files, files_off`` per source.

    What a file should give is counted apart from its parsing: lines behind the header of a CSV
    file, ``total_records`` of a JSON page, start tags of an XML file. Against it stands what became
    of it: the lines, records or elements that rows and dead letters take. ``files_off`` counts the
    files where the two differ. Files that say nothing (pages without a number, JSON lines, payroll
    as a table) are read, but not compared.
    """
    made = []
    for source, parsed in stored.items():
        unit = LINES if LINES in parsed.columns else "records"
        size = F.col(LINES) if LINES in parsed.columns else F.lit(1)
        bad = F.col(ERROR).isNotNull()
        found = parsed.groupBy(FILE).agg(
            F.sum(size).alias("accounted"),
            F.count_if(~bad).alias("rows_read"),
            F.count_if(bad).alias("dead_letters"),
        )
        both = found.join(expected[source].select(FILE, "expected"), FILE, "full")
        accounted = F.coalesce("accounted", F.lit(0))
        totals = both.agg(
            F.sum("expected").cast("long").alias("expected"),
            F.sum(F.when(F.col("expected").isNotNull(), accounted)).cast("long").alias("accounted"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_read", "dead_letters")],
            F.count("*").alias("files"),
            F.count_if(F.col("expected") != accounted).alias("files_off"),
        )
        made.append(totals.select(F.lit(source).alias("source"), F.lit(unit).alias("unit"), "*"))
    return reduce(DataFrame.unionByName, made)


def _expected(spark: SparkSession, sources: Sources) -> dict[str, DataFrame]:
    silent = spark.createDataFrame([], f"{FILE} string, expected long")
    pages = silent
    if not sources.staff_json_lines:
        pages = expected_records(spark, sources.staff_json)
        pages = pages.groupBy(FILE).agg(F.sum("total_records").alias("expected"))
    paid = silent
    if sources.payroll_format == "csv":
        paid = expected_lines(spark, sources.payroll, sources.csv_encoding)
    return {
        STAFF_A: expected_lines(spark, sources.staff_csv, sources.csv_encoding),
        STAFF_B: pages,
        PAYROLL: paid,
        BENEFITS: expected_elements(spark, sources.benefits_xml),
    }


def ingest_all(spark: SparkSession, sources: Sources, stage: Stage) -> Ingested:
    """Text is parsed once: the tables are stored with their ordinals and errors, then split.

    Ordinals follow the names of the files, so of repeated ids the row of the first file is first.
    """
    csv = sources.csv_encoding, sources.csv_multiline
    parsed = {
        STAFF_A: parse_staff_csv(spark, sources.staff_csv, stage.within("staff_csv"), *csv),
        STAFF_B: parse_staff_json(spark, sources.staff_json, sources.staff_json_lines),
        PAYROLL: parse_payroll(
            spark, sources.payroll, stage.within("payroll_csv"), sources.payroll_format, *csv
        ),
        BENEFITS: parse_benefits_xml(spark, sources.benefits_xml),
    }
    stored = {source: stage(df, f"parsed_{source}") for source, df in parsed.items()}
    split = {
        source: split_rejects(in_file_order(df, STAFF_B_OFFSET if source == STAFF_B else 0), source)
        for source, df in stored.items()
    }
    return Ingested(
        align(split[STAFF_A].rows, split[STAFF_B].rows),
        split[PAYROLL].rows,
        split[BENEFITS].rows,
        reduce(DataFrame.unionByName, [part.rejects for part in split.values()]),
        stage(ingest_report(stored, _expected(spark, sources)), "ingest_report"),
    )
