"""The golden table, whole or one company (partition pruning)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_golden(spark: SparkSession, path: str, company_origin: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    if company_origin is None:
        return table
    return table.where(F.col("company_origin") == company_origin)
