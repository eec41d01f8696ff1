"""Column masks applied when a table is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def mask_financial(value: Column, is_member: bool | Column) -> Column:
    """The value for members of the group, NULL for everyone else."""
    member = is_member if isinstance(is_member, Column) else F.lit(is_member)
    return F.when(member, value)


def register_mask_function(spark: SparkSession, name: str = "mask_financial") -> None:
    """The same mask for SQL users: ``mask_financial(column, is_member)``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value DOUBLE, is_member BOOLEAN) "
        "RETURNS DOUBLE RETURN IF(is_member, value, NULL)"
    )


def apply_masks(df: DataFrame, masks: dict, is_member: bool | Column) -> DataFrame:
    """Replace each masked column by its policy. Apply on read, never before a table is built."""
    return df.withColumns({column: policy(F.col(column), is_member) for column, policy in masks.items()})
