from datetime import date, timedelta

from pyspark.sql import functions as F

from demandflow.operators import series
from demandflow.functions.calendar import week_start, with_date_parts

MONDAY = date(2025, 1, 6)
WEEKLY = "sku string, store_id string, week date, total_quantity long"


def weeks(sku, store, numbers, quantity=10):
    return [(sku, store, MONDAY + timedelta(7 * n), quantity * (i + 1)) for i, n in enumerate(numbers)]


def test_week_is_the_monday(spark):
    days = spark.createDataFrame([(MONDAY + timedelta(i),) for i in range(-1, 8)], "d date")
    got = [r[0] for r in days.orderBy("d").select(week_start("d")).collect()]
    assert got == [MONDAY - timedelta(7)] + [MONDAY] * 7 + [MONDAY + timedelta(7)]


def test_date_parts(spark):
    day = spark.createDataFrame([(date(2024, 12, 30),), (date(2025, 1, 5),)], "date_id date")
    got = [tuple(r) for r in with_date_parts(day).orderBy("date_id").collect()]
    assert got == [
        (date(2024, 12, 30), 2024, 4, 12, 1, 2, False),  # Monday of ISO week 1 of 2025
        (date(2025, 1, 5), 2025, 1, 1, 1, 1, True),
    ]


def test_weekly_demand_keeps_every_unit(spark, rows):
    fact = spark.createDataFrame(
        [("a", "1", MONDAY + timedelta(d), q) for d, q in [(0, 1), (6, 2), (7, 4), (-1, 8)]],
        "sku string, store_id string, date_id date, quantity_sold int",
    )
    assert rows(series.weekly_demand(fact), "week", "total_quantity") == [
        (MONDAY - timedelta(7), 8), (MONDAY, 3), (MONDAY + timedelta(7), 4),
    ]


def test_valid_pairs_both_forms(spark, rows):
    df = spark.createDataFrame(weeks("a", "1", range(12)) + weeks("b", "1", range(11)), WEEKLY)
    assert rows(series.valid_pairs(df)) == [("a", "1")]
    kept = series.keep_valid_pairs(df)
    assert kept.count() == 12 and kept.columns == df.columns
    assert series.keep_valid_pairs(df, 11).count() == 23


def test_averages_count_rows_not_dates(spark):
    df = spark.createDataFrame(weeks("a", "1", [0, 1, 4, 30, 31, 32]), WEEKLY)
    got = series.rolling_features(df).orderBy("week").collect()
    assert [r.rolling_4wk_avg for r in got] == [0.0, 10.0, 15.0, 20.0, 25.0, 35.0]
    assert [r.avg_demand_last_12w for r in got] == [0.0, 10.0, 15.0, 20.0, 25.0, 30.0]


def test_averages_over_calendar_weeks(spark):
    df = spark.createDataFrame(weeks("a", "1", [0, 1, 4, 30]), WEEKLY)
    got = series.rolling_features(df, calendar_weeks=True).orderBy("week").collect()
    assert [r.rolling_4wk_avg for r in got] == [0.0, 10.0, 15.0, 0.0]


def test_valid_series_marks_the_last_row(spark):
    df = spark.createDataFrame(weeks("a", "1", range(12)) + weeks("b", "1", [0]), WEEKLY)
    got = series.valid_series(df).orderBy("week").collect()
    assert [r.is_last for r in got] == [False] * 11 + [True]
    last = series.latest_per_series(series.valid_series(df)).first()
    assert (last.sku, last.avg_demand_last_12w, last.rolling_4wk_avg) == ("a", 60.0, 95.0)


def test_forecast_weeks_follow_the_newest_week_of_any_series(spark, rows):
    df = spark.createDataFrame(weeks("a", "1", range(12)) + weeks("b", "1", [20]), WEEKLY)
    ahead = [(MONDAY + timedelta(7 * n),) for n in range(21, 29)]
    assert rows(series.forecast_weeks(df)) == ahead
    keys = series.add_forecast_weeks(series.valid_pairs(df), df)
    assert rows(keys) == [("a", "1", w) for (w,) in ahead]
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_partial_week_can_be_dropped(spark):
    df = spark.createDataFrame(weeks("a", "1", range(3)), WEEKLY)
    assert series.drop_partial_week(df, F.lit(MONDAY + timedelta(14))).count() == 2
    assert series.drop_partial_week(df, F.lit(MONDAY + timedelta(20))).count() == 3


def test_empty_sales(spark):
    fact = spark.createDataFrame([], "sku string, store_id string, date_id date, quantity_sold int")
    weekly = series.weekly_demand(fact)
    assert series.valid_series(weekly).count() == 0
    assert series.forecast_weeks(weekly).count() == 0
    assert series.add_forecast_weeks(series.valid_pairs(weekly), weekly).count() == 0
