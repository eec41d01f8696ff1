"""Optional filters, week selectors and option lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.functions.calendar import week_start

ALL = "all"


def multi_filter(df: DataFrame, **choices: str) -> DataFrame:
    """Equality filters by column; ``'all'`` leaves that column open."""
    for column, choice in choices.items():
        if choice != ALL:
            df = df.where(F.col(column) == choice)
    return df


def for_week(df: DataFrame, week: str) -> DataFrame:
    """Rows of one week given as text; text that is no date selects nothing."""
    return df.where(F.col("week") == F.lit(week).try_cast("date"))


def latest_week(df: DataFrame) -> DataFrame:
    return df.where(F.col("week") == df.agg(F.max("week")).scalar())


def earliest_week(df: DataFrame) -> DataFrame:
    return df.where(F.col("week") == df.agg(F.min("week")).scalar())


def this_week(df: DataFrame, as_of: Column) -> DataFrame:
    return df.where(F.col("week") == week_start(as_of))


def next_week(df: DataFrame, as_of: Column) -> DataFrame:
    """Next Monday's rows, or the first week from ``as_of`` on when that week has none."""
    monday = week_start(F.date_add(as_of, 7))
    week = F.col("week")
    chosen = df.agg(F.coalesce(F.max(F.when(week == monday, week)), F.min(F.when(week >= as_of, week))))
    return df.where(week == chosen.scalar())


def next_n_weeks(df: DataFrame, as_of: Column, n: int) -> DataFrame:
    monday = week_start(F.date_add(as_of, 7))
    return df.where((F.col("week") >= monday) & (F.col("week") < F.date_add(monday, 7 * n)))


def trailing_period(
    df: DataFrame, date_col: str, weeks: int, month_col: str | None = None, newest_month: str | None = None
) -> DataFrame:
    """Rows no older than ``weeks`` weeks before the newest date (not aligned to weeks).

    For a table partitioned by the first day of the month, with its newest month known from the
    listing, the newest date is looked up in that month and only the months in reach are read.
    """
    if month_col is None or newest_month is None:
        return df.where(F.col(date_col) >= F.date_sub(df.agg(F.max(date_col)).scalar(), 7 * weeks))
    month = F.lit(newest_month).cast("date")
    newest = df.where(F.col(month_col) == month).agg(F.max(date_col))
    reached = df.where(F.col(month_col) >= F.trunc(F.date_sub(month, 7 * weeks), "month"))
    return reached.where(F.col(date_col) >= F.date_sub(newest.scalar(), 7 * weeks))


def distinct_options(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def option_lists(df: DataFrame, columns: list[str]) -> DataFrame:
    """(option, value) for the choices of several filters, from one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").distinct().orderBy("option", "value")
