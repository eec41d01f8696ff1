"""Scoring, risk flags and the model's yardsticks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.functions.measures import is_overstock, is_stockout, whole_units
from demandflow.operators.asof import asof_lookup
from demandflow.operators.series import HORIZON_WEEKS
from demandflow.schemas import SERIES

# Fixed value: extra demand share at full discount in the closed-form predictor.
UPLIFT = 2.2

Predictor = Callable[[DataFrame], DataFrame]


def uplift_predictor(features: DataFrame) -> DataFrame:
    """Closed-form stand-in for a model: the 4-week average raised by the discount."""
    raw = F.col("rolling_4wk_avg") * (1 + F.lit(UPLIFT) * F.col("discount_pct_feat"))
    return features.withColumn("prediction", raw)


def lookup_for_scoring(keys: DataFrame, features: DataFrame) -> DataFrame:
    """Point-in-time features for (sku, store_id, week) keys."""
    return asof_lookup(keys, features, SERIES, "week", "week", left_unique=True)


def score(features: DataFrame, predictor: Predictor, model_version: str) -> DataFrame:
    """Forecast rows from the feature rows of the forecast weeks.

    The feature table already holds one row per key to score, so no lookup is needed when those
    rows are passed; use ``lookup_for_scoring`` for any other set of keys.
    """
    return (
        predictor(features)
        .withColumn("predicted_demand", whole_units("prediction"))
        .select(
            *SERIES, "week", "predicted_demand", "avg_demand_last_12w",
            is_stockout().alias("is_stockout_risk"),
            is_overstock().alias("is_overstock_risk"),
            F.lit(model_version).alias("model_version"),
        )
    )


def holdout_cutoff(labels: DataFrame, weeks: int = HORIZON_WEEKS) -> DataFrame:
    """One row: the first of the last ``weeks`` distinct weeks."""
    last = labels.select("week").distinct().orderBy(F.desc("week")).limit(weeks)
    return last.agg(F.min("week").alias("cutoff"))


def holdout_split(labels: DataFrame, weeks: int = HORIZON_WEEKS, cutoff: Column | None = None) -> DataFrame:
    """Labels with ``part``: ``train`` before the cutoff week, ``test`` from it on."""
    part = F.when(F.col("week") < F.col("__cutoff"), "train").otherwise("test")
    cut = labels.withColumn("__cutoff", holdout_cutoff(labels, weeks).scalar() if cutoff is None else cutoff)
    return cut.withColumn("part", part).drop("__cutoff")


def training_set(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the features known in their week; the caller drops the keys when fitting."""
    return asof_lookup(labels, features, SERIES, "week", "week", left_unique=True)


def mae(actual: str, predicted: str):
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def baseline_mae(holdout: DataFrame) -> DataFrame:
    """What the model must beat: both trailing averages as forecasts of the same rows."""
    return holdout.agg(
        F.count(F.lit(1)).alias("holdout_rows"),
        mae("total_quantity", "avg_demand_last_12w").alias("mae_naive_avg12w"),
        mae("total_quantity", "rolling_4wk_avg").alias("mae_naive_rolling4w"),
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        F.count_if("is_stockout_risk").alias("stockout"),
        F.count_if("is_overstock_risk").alias("overstock"),
    )
