"""Rows made from ranges rather than read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows_df(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A handful of driver-side rows, such as fixed parameters."""
    return spark.createDataFrame(rows, schema)


def date_range(spark: SparkSession, start: date, end: date, name: str = "date_id") -> DataFrame:
    """Every day from ``start`` to ``end``."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name))


def year_range_of(df: DataFrame, date_col: str, name: str = "date_id") -> DataFrame:
    """Every day of the calendar years ``date_col`` spans."""
    first = F.trunc(F.min(date_col), "year")
    last = F.date_sub(F.add_months(F.trunc(F.max(date_col), "year"), 12), 1)
    return df.agg(first.alias("a"), last.alias("b")).select(F.explode(F.sequence("a", "b")).alias(name))
