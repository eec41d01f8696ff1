"""Landing schemas, keys and the key check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType


def _all_strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Every landing column arrives as text, in this order.
LANDING_SCHEMAS: dict[str, StructType] = {
    "transactions": _all_strings(
        "transaction_id", "sku", "store_id", "transaction_date", "quantity_sold", "unit_price_at_sale"
    ),
    "products": _all_strings("sku", "product_name", "category", "subcategory", "unit_cost", "unit_price"),
    "stores": _all_strings(
        "store_id", "store_name", "region", "store_type",
        "manager_name", "manager_email", "manager_phone", "manager_since",
    ),
    "promotions": _all_strings(
        "promo_id", "sku_or_category", "store_id_or_region", "discount_pct", "channel",
        "promo_start_date", "promo_end_date",
    ),
}

SOURCE_SYSTEMS = {
    "transactions": "pos_system",
    "products": "pos_system",
    "stores": "pos_system",
    "promotions": "promo_platform",
}

KEYS = {
    "transactions": ["transaction_id"],
    "products": ["sku"],
    "stores": ["store_id"],
    "promotions": ["promo_id"],
    "features": ["sku", "store_id", "week"],
    "forecast": ["sku", "store_id", "week"],
    "actions": ["sku", "store_id", "week"],
    "status": ["action_id"],
}

SERIES = ["sku", "store_id"]

FEATURE_INPUTS = [
    "week_of_year", "is_promoted", "discount_pct_feat", "rolling_4wk_avg", "avg_demand_last_12w",
]
FEATURE_COLUMNS = [*SERIES, "week", *FEATURE_INPUTS]


FEATURE_SCHEMA = StructType([
    StructField("sku", StringType()),
    StructField("store_id", StringType()),
    StructField("week", DateType()),
    StructField("week_of_year", IntegerType()),
    StructField("is_promoted", IntegerType()),
    StructField("discount_pct_feat", DoubleType()),
    StructField("rolling_4wk_avg", DoubleType()),
    StructField("avg_demand_last_12w", DoubleType()),
])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (partial counts first, so a hot key is cheap)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise when a key repeats or is NULL."""
    missing = df.where(" OR ".join(f"{key} IS NULL" for key in keys))
    bad = duplicate_keys(df, keys).select(*keys).unionByName(missing.select(*keys)).take(1)
    if bad:
        raise ValueError(f"key {keys} is not unique or has NULL, e.g. {bad[0].asDict()}")
    return df
