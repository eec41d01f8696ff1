"""Landing text to typed columns, one function per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from demandflow.functions.parsing import (
    category_target, parse_date, parse_number, parse_percent, region_scope, sku_target, store_scope,
)

PROMO_DATE_FORMAT = "MM/dd/yyyy"


def _stamp(df: DataFrame) -> DataFrame:
    """Carry the ingest time along as ``_updated_at`` where the feed has one."""
    return df.withColumn("_updated_at", df["_ingested_at"]) if "_ingested_at" in df.columns else df


def conform_transactions(df: DataFrame) -> DataFrame:
    return _stamp(df.withColumns({
        "transaction_date": parse_date("transaction_date"),
        "quantity_sold": parse_number("quantity_sold", "int"),
        "unit_price_at_sale": parse_number("unit_price_at_sale", "double"),
    }))


def conform_products(df: DataFrame) -> DataFrame:
    return _stamp(df.withColumns({
        "unit_cost": parse_number("unit_cost", "double"),
        "unit_price": parse_number("unit_price", "double"),
    }))


def conform_stores(df: DataFrame) -> DataFrame:
    return _stamp(df.withColumn("manager_since", parse_date("manager_since")))


def split_target(df: DataFrame) -> DataFrame:
    """A promotion names a product or a category; the other column stays NULL."""
    return df.withColumns({
        "target_sku": sku_target("sku_or_category"),
        "target_category": category_target("sku_or_category"),
    })


def split_scope(df: DataFrame) -> DataFrame:
    """A promotion covers one store or one region; the other column stays NULL."""
    return df.withColumns({
        "target_store_id": store_scope("store_id_or_region"),
        "target_region": region_scope("store_id_or_region"),
    })


def conform_promotions(df: DataFrame) -> DataFrame:
    typed = df.withColumns({
        "promo_start_date": parse_date("promo_start_date", PROMO_DATE_FORMAT),
        "promo_end_date": parse_date("promo_end_date", PROMO_DATE_FORMAT),
        "discount_pct": parse_percent("discount_pct"),
    })
    return _stamp(split_scope(split_target(typed)).drop("sku_or_category", "store_id_or_region"))


CONFORM = {
    "transactions": conform_transactions,
    "products": conform_products,
    "stores": conform_stores,
    "promotions": conform_promotions,
}
