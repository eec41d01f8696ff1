"""Tags of tables and columns, and masked reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators.masking import apply_masks, mask_financial

MASKS = {"unit_price_at_sale": mask_financial}


def tag_report(tags: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Table tags of the given names; tags have schema_name, table_name, column_name, tag_name, tag_value."""
    return (
        tags.where(F.col("column_name").isNull() & F.col("tag_name").isin(*names))
        .select("schema_name", "table_name", "tag_name", "tag_value")
        .orderBy("schema_name", "table_name", "tag_name")
    )


def masked_transactions(transactions: DataFrame, is_member: bool) -> DataFrame:
    """Silver sales as a member, or a non-member, of the finance group sees them."""
    return apply_masks(transactions, MASKS, is_member)
