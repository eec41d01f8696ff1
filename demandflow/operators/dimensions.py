"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Runs a small job: reads at most ``max_rows + 1`` rows and measures them as text."""
    width = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    size = df.limit(max_rows + 1).select(width.alias("b")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def checked_broadcast(df: DataFrame, **limits: int) -> DataFrame:
    """Hint a broadcast only for a table measured to be small.

    A larger table is returned without a hint: Spark then joins by shuffle, and AQE splits
    skewed keys.
    """
    return F.broadcast(df) if fits_broadcast(df, **limits) else df


def with_region_and_category(df: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of known stores and products, with ``region`` and ``category``."""
    return (
        df.join(stores.select("store_id", "region"), "store_id")
        .join(products.select("sku", "category"), "sku")
    )


def with_names(df: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of known stores and products, with the descriptive columns reports show."""
    return (
        df.join(stores.select("store_id", "store_name", "region"), "store_id")
        .join(products.select("sku", "product_name", "category"), "sku")
    )
