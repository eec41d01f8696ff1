"""Text to typed values. Text that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a product code looks like; any other target text is a category.
SKU_PATTERN = r"^[A-Z]{2}-\d{3}$"
STORE_PREFIX = "store_"


def parse_date(col: str, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict: the text must have exactly this form. ISO text is cast, which is far cheaper than
    a format parser; the pattern keeps out the looser spellings a cast would accept."""
    if fmt == "yyyy-MM-dd":
        return F.when(F.col(col).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(col).try_cast("date"))
    return F.try_to_date(F.col(col), fmt)


def parse_number(col: str, dtype: str) -> Column:
    return F.col(col).try_cast(dtype)


def parse_percent(col: str) -> Column:
    """``"20%"`` to 0.2."""
    return F.regexp_replace(col, "%", "").try_cast("double") / F.lit(100.0)


def sku_target(col: str) -> Column:
    return F.when(F.col(col).rlike(SKU_PATTERN), F.col(col))


def category_target(col: str) -> Column:
    return F.when(~F.col(col).rlike(SKU_PATTERN), F.col(col))


def store_scope(col: str) -> Column:
    return F.when(F.col(col).startswith(STORE_PREFIX), F.regexp_replace(col, f"^{STORE_PREFIX}", ""))


def region_scope(col: str) -> Column:
    return F.when(~F.col(col).startswith(STORE_PREFIX), F.col(col))
