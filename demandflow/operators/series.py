"""Weekly series per product and store.

A series has one row per week, so its length is bounded by the calendar whatever the number of
sales. Sales are summed before they are shuffled; only the weekly rows meet a window.

Write the result of ``weekly_demand`` as a table before using it in several plans: it is the one
step that reads all sales, and everything below needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.functions.calendar import week_start
from demandflow.schemas import SERIES

MIN_HISTORY_WEEKS = 12
HORIZON_WEEKS = 8
# Rows are sorted by the store first: there are far more of them than products, so most comparisons end there.
STORE_FIRST = SERIES[::-1]


def weekly_demand(fact: DataFrame) -> DataFrame:
    return (
        fact.select(*SERIES, week_start("date_id").alias("week"), "quantity_sold")
        .groupBy(*SERIES, "week")
        .agg(F.sum("quantity_sold").alias("total_quantity"))
    )


def data_end(weekly: DataFrame) -> DataFrame:
    """One row: the last week with sales. Use ``.scalar()`` to put it inside another plan."""
    return weekly.agg(F.max("week").alias("data_end"))


def valid_pairs(weekly: DataFrame, min_weeks: int = MIN_HISTORY_WEEKS) -> DataFrame:
    """Series with enough weeks. A week occurs once per series, so counting rows is enough."""
    return (
        weekly.groupBy(*SERIES).agg(F.count("week").alias("week_count"))
        .where(F.col("week_count") >= min_weeks)
        .select(*SERIES)
    )


def keep_valid_pairs(weekly: DataFrame, min_weeks: int = MIN_HISTORY_WEEKS) -> DataFrame:
    """Weekly rows of the valid series; a count over the series, so no join back."""
    weeks = F.count("week").over(Window.partitionBy(*STORE_FIRST))
    return weekly.withColumn("__weeks", weeks).where(F.col("__weeks") >= min_weeks).drop("__weeks")


def trailing_average(rows: int, calendar_weeks: bool = False):
    """Mean of the previous ``rows`` rows of the series, without the current row; 0.0 for none.

    Missing weeks are skipped, not counted as zero. ``calendar_weeks`` looks back over that many
    calendar weeks instead.
    """
    series = Window.partitionBy(*STORE_FIRST)
    if calendar_weeks:
        frame = series.orderBy(F.unix_date("week")).rangeBetween(-7 * rows, -1)
    else:
        frame = series.orderBy("week").rowsBetween(-rows, -1)
    return F.coalesce(F.avg("total_quantity").over(frame), F.lit(0.0))


def rolling_features(weekly: DataFrame, calendar_weeks: bool = False) -> DataFrame:
    return weekly.withColumns({
        "rolling_4wk_avg": trailing_average(4, calendar_weeks),
        "avg_demand_last_12w": trailing_average(12, calendar_weeks),
    })


def valid_series(
    weekly: DataFrame, min_weeks: int = MIN_HISTORY_WEEKS, calendar_weeks: bool = False
) -> DataFrame:
    """Valid weekly rows with both averages and ``is_last``, from one shuffle and one sort."""
    series = Window.partitionBy(*STORE_FIRST)
    return (
        rolling_features(weekly, calendar_weeks)
        .withColumns({
            "is_last": F.lead("week").over(series.orderBy("week")).isNull(),
            "__weeks": F.count("week").over(series),
        })
        .where(F.col("__weeks") >= min_weeks)
        .drop("__weeks")
    )


def last_valid_rows(weekly: DataFrame, min_weeks: int = MIN_HISTORY_WEEKS) -> DataFrame:
    """The last row of every valid series with both averages: the ``is_last`` rows of ``valid_series``, without
    averages for the rows before. Rows are numbered from the end, and the averages are sums over the numbers."""
    numbered = weekly.withColumn("__back", F.row_number().over(Window.partitionBy(*STORE_FIRST).orderBy(F.desc("week"))))

    def average(rows: int):
        return F.coalesce(F.avg(F.when(F.col("__back").between(2, rows + 1), F.col("total_quantity"))), F.lit(0.0))

    last = numbered.groupBy(*SERIES).agg(
        F.max("week").alias("week"), average(4).alias("rolling_4wk_avg"), average(12).alias("avg_demand_last_12w"),
        F.count("week").alias("__weeks"),
    )
    return last.where(F.col("__weeks") >= min_weeks).drop("__weeks")


def last_known_rows(history: DataFrame) -> DataFrame:
    """``last_valid_rows`` of the weekly rows behind ``history``, which are all valid and have their averages: nothing is sorted, and
    where the rows of a series lie in one file only its last one is shuffled."""
    averages = [F.max_by(c, "week").alias(c) for c in ("rolling_4wk_avg", "avg_demand_last_12w")]
    return history.groupBy(*SERIES).agg(F.max("week").alias("week"), *averages)


def drop_partial_week(weekly: DataFrame, last_sale_day) -> DataFrame:
    """Leave out the last week unless its Sunday was reached."""
    return weekly.where(F.date_add("week", 6) <= last_sale_day)


def latest_per_series(features: DataFrame) -> DataFrame:
    """The newest week's averages of each series."""
    newest = F.max(F.struct("week", "avg_demand_last_12w", "rolling_4wk_avg")).alias("n")
    return features.groupBy(*SERIES).agg(newest).select(*SERIES, "n.avg_demand_last_12w", "n.rolling_4wk_avg")


def forecast_weeks(weekly: DataFrame, horizon: int = HORIZON_WEEKS) -> DataFrame:
    """The Mondays after the last week with sales; none when there are no sales."""
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return data_end(weekly).where("data_end IS NOT NULL").select("data_end", step.alias("i")).select(
        F.expr("date_add(data_end, 7 * i)").alias("week")
    )


def add_forecast_weeks(pairs: DataFrame, weekly: DataFrame, horizon: int = HORIZON_WEEKS) -> DataFrame:
    """Every pair once per forecast week. The weeks grow on the row; nothing is cross joined."""
    ends = pairs.withColumn("__end", data_end(weekly).scalar())
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return ends.withColumn("__i", step).withColumn("week", F.expr("date_add(__end, 7 * __i)")).drop("__end", "__i")
