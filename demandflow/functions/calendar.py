"""Weeks start on Monday and are keyed by that Monday's DATE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def week_start(day: Column | str) -> Column:
    """Monday of the week ``day`` falls in. Stays in DATE, so no time zone is involved."""
    day = F.col(day) if isinstance(day, str) else day
    return F.date_sub(day, F.weekday(day))


def week_end(day: Column | str) -> Column:
    """Sunday of the week ``day`` falls in."""
    return F.date_add(week_start(day), 6)


def with_date_parts(df: DataFrame, date_col: str = "date_id") -> DataFrame:
    """Calendar attributes of a date; ``day_of_week`` is 1 for Sunday to 7 for Saturday."""
    return df.withColumns({
        "year": F.year(date_col),
        "quarter": F.quarter(date_col),
        "month": F.month(date_col),
        "week_of_year": F.weekofyear(date_col),
        "day_of_week": F.dayofweek(date_col),
        "is_weekend": F.dayofweek(date_col).isin(1, 7),
    })


def snap_to_weeks(df: DataFrame, start: str, end: str) -> DataFrame:
    """Widen an interval to whole weeks: start back to Monday, end forward to Sunday."""
    return df.withColumns({start: week_start(start), end: week_end(end)})
