"""Row counts and run summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators.series import data_end


def layer_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count) of the given tables in one query."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_summary(weekly: DataFrame, features: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row about a run: feature rows, last week, forecast and action rows, forecast weeks."""
    feature_rows = features.agg(F.count(F.lit(1)))
    risky = F.count_if(F.col("is_stockout_risk") | F.col("is_overstock_risk"))
    return forecast.agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        risky.alias("action_rows"),
        F.array_join(F.sort_array(F.collect_set(F.date_format("week", "yyyy-MM-dd"))), ",").alias("forecast_weeks"),
    ).select(
        feature_rows.scalar().alias("feature_rows"),
        data_end(weekly).scalar().alias("data_end"),
        "forecast_rows", "action_rows", "forecast_weeks",
    )
