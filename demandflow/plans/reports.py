"""Dashboard and app reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.functions.calendar import week_start
from demandflow.functions.measures import at_risk, promo_item, promo_scope, report_risk_type, sum_money
from demandflow.operators.dimensions import with_names
from demandflow.operators.ranking import top_k, top_k_with_ties
from demandflow.operators.selection import distinct_options, for_week, latest_week, trailing_period
from demandflow.plans.gold import SALE_MONTH

EXPLORER_WEEKS = 12
UPCOMING_PROMOS = 50

PROMO_COLUMNS = [
    "promo_id", "sku_or_category", "store_id_or_region", "discount_pct", "channel",
    "promo_start_date", "promo_end_date",
]


def risk_summary(forecast: DataFrame, last_week: str | None = None) -> DataFrame:
    """Risk counts of the furthest week. Where the forecast is partitioned by week and its last week is
    known from the listing, that partition alone is read."""
    rows = latest_week(forecast) if last_week is None else for_week(forecast, last_week)
    return rows.agg(
        F.count_if("is_stockout_risk").alias("stockout_count"), F.count_if("is_overstock_risk").alias("overstock_count")
    )


def risk_detail(forecast: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    risky = latest_week(forecast).where(at_risk())
    return with_names(risky, stores, products).select(
        "store_id", "store_name", "sku", "product_name", "category", "region",
        "predicted_demand", "avg_demand_last_12w", report_risk_type().alias("risk_type"), "week",
    )


def risk_by(detail: DataFrame, dimension: str) -> DataFrame:
    return detail.groupBy("risk_type", dimension).agg(F.count("store_id").alias("at_risk"))


def risk_total(detail: DataFrame) -> DataFrame:
    return detail.agg(F.count("store_id").alias("at_risk"))


def weekly_revenue(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Summed per store and week before the region is looked up, so the join sees few rows."""
    per_store = fact.groupBy(week_start("date_id").alias("week_start"), "store_id").agg(
        F.sum(F.round(F.col("total_revenue") * 100).cast("long")).alias("cents")
    )
    return (
        per_store.join(stores.select("store_id", "region"), "store_id")
        .groupBy("week_start", "region")
        .agg((F.sum("cents") / F.lit(100.0)).alias("weekly_revenue"))
        .orderBy("week_start", "region")
    )


def category_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    return (
        fact.join(products.select("sku", "category"), "sku")
        .groupBy("category")
        .agg(sum_money("total_revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def promo_lift(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Average quantity by category, promoted and not, in one pass over the sales."""
    kind = F.when(F.col("is_promoted") == 1, "Promoted").otherwise("Baseline")
    return (
        fact.where(F.col("is_promoted").isin(0, 1))
        .join(products.select("sku", "category"), "sku")
        .groupBy("category", kind.alias("promo_type"))
        .agg(F.avg("quantity_sold").alias("avg_qty"))
    )


def _promo_report(promos: DataFrame) -> DataFrame:
    return promos.withColumns({
        "sku_or_category": promo_item(), "store_id_or_region": promo_scope(),
    }).select(*PROMO_COLUMNS)


def active_promotions(promos: DataFrame) -> DataFrame:
    return _promo_report(promos.where("is_active")).orderBy("promo_start_date", "promo_id")


def upcoming_promotions(promos: DataFrame, k: int = UPCOMING_PROMOS) -> DataFrame:
    return top_k(_promo_report(promos.where("is_future")), k, "promo_start_date", "promo_id")


def risk_dashboard(forecast: DataFrame, stores: DataFrame, products: DataFrame, week: str) -> DataFrame:
    """At-risk rows of one week, stockouts first."""
    risky = for_week(forecast, week).where(at_risk())
    return with_names(risky, stores, products).select(
        "week", "store_name", "region", "sku", "product_name", "category", "predicted_demand",
        F.round("avg_demand_last_12w", 1).alias("avg_demand_last_12w"),
        "is_stockout_risk", "is_overstock_risk",
    ).orderBy(F.desc("is_stockout_risk"), F.desc("is_overstock_risk"), "store_name", "sku")


def week_options(forecast: DataFrame) -> DataFrame:
    return distinct_options(forecast.where(at_risk()), "week")


def explorer_options(forecast: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Store and product choices. Pairs are made distinct before the names are joined."""
    pairs = forecast.where(at_risk()).select("store_id", "sku").distinct()
    named = with_names(pairs, stores, products)
    return distinct_options(named, "store_name", "sku", "region", "product_name", "category").select(
        "store_name", "region", "sku", "product_name", "category"
    )


def forecast_explorer(
    fact: DataFrame, forecast: DataFrame, stores: DataFrame, products: DataFrame,
    store_name: str, sku: str, weeks: int = EXPLORER_WEEKS, newest_month: str | None = None,
) -> DataFrame:
    """Actual demand of the last weeks and the forecast of one product in one store, by week.

    The cut lies ``weeks`` weeks before the newest sale, so the first week may be partial. With
    ``newest_month``, ``fact`` is the table partitioned by ``SALE_MONTH`` and few of its months are read.
    """
    one_store = stores.where(F.col("store_name") == store_name)
    one_sku = F.col("sku") == sku
    actual = (
        trailing_period(fact, "date_id", weeks, SALE_MONTH if newest_month else None, newest_month).where(one_sku)
        .join(one_store.select("store_id"), "store_id")
        .groupBy("sku", "store_id", week_start("date_id").alias("week"))
        .agg(F.sum("quantity_sold").cast("double").alias("actual_demand"))
    )
    ahead = forecast.where(one_sku).select(
        "sku", "store_id", "week",
        F.col("predicted_demand").cast("double").alias("predicted_demand"),
        "avg_demand_last_12w", "is_stockout_risk", "is_overstock_risk",
    )
    both = actual.unionByName(ahead, allowMissingColumns=True)
    return with_names(both, one_store, products.where(one_sku)).select(
        F.col("week").cast("timestamp_ntz").alias("week"),
        "store_name", "region", "sku", "product_name", "category", "actual_demand",
        "predicted_demand", "avg_demand_last_12w", "is_stockout_risk", "is_overstock_risk",
    ).orderBy("week")


def explorer_headline(explorer: DataFrame) -> DataFrame:
    """The first forecast week of an explorer result with its average and flags."""
    ahead = explorer.where(F.col("predicted_demand").isNotNull())
    return top_k(ahead, 1, "week").select(
        F.date_format("week", "yyyy-MM-dd").alias("forecast_week"),
        "predicted_demand", "avg_demand_last_12w", "is_stockout_risk", "is_overstock_risk",
    )


def explorer_chart(explorer: DataFrame) -> DataFrame:
    """An explorer result as chart points: the week as text, missing numbers left missing."""
    return explorer.select(
        F.date_format("week", "yyyy-MM-dd").alias("week"),
        "actual_demand", "predicted_demand", "avg_demand_last_12w", "is_stockout_risk", "is_overstock_risk",
    ).orderBy("week")


def top_stores_stockout(forecast: DataFrame, stores: DataFrame, k: int = 5) -> DataFrame:
    """Stores with the most stockout-risk rows over all weeks; ties with the k-th stay."""
    counts = (
        forecast.where("is_stockout_risk AND store_id IS NOT NULL")
        .groupBy("store_id").agg(F.count("sku").alias("stockout_risk_skus"))
        .join(stores.select("store_id", "store_name"), "store_id")
        .select("store_id", "store_name", "stockout_risk_skus")
    )
    return top_k_with_ties(counts, k, "stockout_risk_skus")
