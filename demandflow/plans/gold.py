"""Silver and gold tables as batch plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.functions.calendar import with_date_parts
from demandflow.functions.measures import below_list_price, revenue
from demandflow.operators.conform import CONFORM
from demandflow.operators.latest import latest_per_key
from demandflow.operators.quality import RULES, expect_or_drop
from demandflow.schemas import KEYS
from demandflow.sources.generated import year_range_of


def typed_rows(feed: str, landing: DataFrame) -> DataFrame:
    """Landing rows typed and checked."""
    return expect_or_drop(CONFORM[feed](landing), RULES[feed])


def silver(feed: str, bronze: DataFrame, sequence_by: list[str]) -> DataFrame:
    """Typed and checked rows, the newest per key."""
    return latest_per_key(typed_rows(feed, bronze), KEYS[feed], sequence_by)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("sku", "product_name", "category", "subcategory", "unit_cost", "unit_price")


def dim_store(stores: DataFrame) -> DataFrame:
    """The managers' personal data stays in silver."""
    return stores.select("store_id", "store_name", "region", "store_type")


def dim_date(fact: DataFrame) -> DataFrame:
    """Calendar of the years the sales span."""
    return with_date_parts(year_range_of(fact, "date_id"))


def fact_transactions(transactions: DataFrame, products: DataFrame) -> DataFrame:
    list_price = products.select("sku", F.col("unit_price").alias("__list_price"))
    return transactions.join(list_price, "sku", "left").select(
        "transaction_id", "sku", "store_id", F.col("transaction_date").alias("date_id"),
        "quantity_sold", "unit_price_at_sale",
        revenue().alias("total_revenue"),
        below_list_price(F.col("unit_price_at_sale"), F.col("__list_price")).alias("is_promoted"),
    )


SALE_MONTH = "sale_month"


def with_sale_month(fact: DataFrame) -> DataFrame:
    """The partition column of the sales on disk: the first day of the month."""
    return fact.withColumn(SALE_MONTH, F.trunc("date_id", "month"))


def fact_promotions(promotions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Promotions with their state on ``as_of`` (today by default)."""
    day = F.current_date() if as_of is None else as_of
    start, end = F.col("promo_start_date"), F.col("promo_end_date")
    return promotions.select(
        "promo_id", "target_sku", "target_category", "target_store_id", "target_region",
        "discount_pct", "channel", "promo_start_date", "promo_end_date",
        ((start <= day) & (end >= day)).alias("is_active"),
        (start > day).alias("is_future"),
    )
