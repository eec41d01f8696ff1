"""The standing business questions, each as a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.functions.measures import at_risk
from demandflow.functions.calendar import week_start
from demandflow.operators.dimensions import with_region_and_category
from demandflow.operators.promotions import PromoSteps, daily_best_discount
from demandflow.operators.ranking import top_k
from demandflow.operators.selection import latest_week, next_week, this_week


def risk_pairs_by_category(forecast: DataFrame, products: DataFrame) -> DataFrame:
    """Series at stockout and at overstock risk by category, in the furthest week."""
    return (
        latest_week(forecast).join(products.select("sku", "category"), "sku")
        .groupBy("category")
        .agg(
            F.count_if("is_stockout_risk").alias("stockout_pairs"),
            F.count_if("is_overstock_risk").alias("overstock_pairs"),
        )
    )


def forecast_by_region(forecast: DataFrame, stores: DataFrame, as_of: Column) -> DataFrame:
    return (
        this_week(forecast, as_of).join(stores.select("store_id", "region"), "store_id")
        .groupBy("region").agg(F.sum("predicted_demand").alias("total_predicted_demand"))
    )


def predicted_vs_actual(
    forecast: DataFrame, weekly: DataFrame, products: DataFrame, weeks: int = 12
) -> DataFrame:
    """Mean forecast and mean weekly demand of the last weeks by category. Both sides are summed
    per product first; the category join then sees one row per product and side."""
    recent = weekly.where(F.col("week") > F.date_sub(weekly.agg(F.max("week")).scalar(), 7 * weeks))
    sides = [
        forecast.groupBy("sku").agg(
            F.sum("predicted_demand").alias("p_sum"), F.count("predicted_demand").alias("p_rows")
        ),
        recent.groupBy("sku").agg(
            F.sum("total_quantity").alias("a_sum"), F.count("total_quantity").alias("a_rows")
        ),
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return (
        both.join(products.select("sku", "category"), "sku")
        .groupBy("category")
        .agg(
            (F.sum("p_sum") / F.sum("p_rows")).alias("avg_predicted_demand"),
            (F.sum("a_sum") / F.sum("a_rows")).alias("avg_actual_demand"),
        )
    )


def top_products_forecast(forecast: DataFrame, products: DataFrame, as_of: Column, k: int = 10) -> DataFrame:
    totals = this_week(forecast, as_of).groupBy("sku").agg(F.sum("predicted_demand").alias("total_predicted_demand"))
    named = totals.join(products.select("sku", "product_name"), "sku")
    return top_k(
        named.select("sku", "product_name", "total_predicted_demand"), k, F.desc("total_predicted_demand"), "sku"
    )


def category_revenue_weekly(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_sku = fact.groupBy(week_start("date_id").alias("week_start"), "sku").agg(
        F.sum(F.round(F.col("total_revenue") * 100).cast("long")).alias("cents")
    )
    return (
        per_sku.join(products.select("sku", "category"), "sku")
        .groupBy("week_start", "category")
        .agg((F.sum("cents") / F.lit(100.0)).alias("total_revenue"))
        .orderBy("week_start", "category")
    )


def top_stores_at_risk(forecast: DataFrame, stores: DataFrame) -> DataFrame:
    """Stores by number of at-risk products in the furthest week."""
    counts = latest_week(forecast).where(at_risk()).groupBy("store_id").agg(F.count("sku").alias("at_risk_skus"))
    return (
        counts.join(stores.select("store_id", "store_name"), "store_id")
        .select("store_id", "store_name", "at_risk_skus")
        .orderBy(F.desc("at_risk_skus"), "store_id")
    )


def discount_vs_quantity(
    fact: DataFrame, promos: DataFrame | PromoSteps, stores: DataFrame, products: DataFrame, value: str = "discount_pct"
) -> DataFrame:
    """Quantity per sale by the best discount running that day. Sales are summed per product,
    store and day before promotions are looked up."""
    daily = fact.groupBy("sku", "store_id", "date_id").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("quantity_sold").alias("units")
    )
    matched = daily_best_discount(with_region_and_category(daily, stores, products), promos, "date_id", value)
    return (
        matched.groupBy(F.col("discount_float").alias("discount_pct"))
        .agg(F.sum("sales").alias("sales"), F.sum("units").alias("units"))
        .withColumn("avg_quantity", F.col("units") / F.col("sales"))
        .orderBy("discount_pct")
    )


def stores_stockout_next_week(forecast: DataFrame, stores: DataFrame, as_of: Column) -> DataFrame:
    counts = next_week(forecast, as_of).where("is_stockout_risk").groupBy("store_id", "week").agg(
        F.count("sku").alias("stockout_skus")
    )
    return (
        counts.join(stores.select("store_id", "store_name"), "store_id")
        .select("week", "store_id", "store_name", "stockout_skus")
        .orderBy(F.desc("stockout_skus"), "store_id")
    )
