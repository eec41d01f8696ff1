"""Row rules: a row is kept only where every rule is TRUE (NULL counts as failed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RULES: dict[str, dict[str, str]] = {
    "transactions": {
        "valid_quantity": "quantity_sold > 0",
        "valid_revenue": "unit_price_at_sale > 0",
        "valid_date": "transaction_date IS NOT NULL",
    },
    "products": {"valid_price_margin": "unit_price > unit_cost"},
    "stores": {},
    "promotions": {
        "valid_discount": "discount_pct > 0 AND discount_pct < 1",
        "valid_date_range": "promo_end_date >= promo_start_date",
    },
}


def _failed(rule: str):
    return ~F.coalesce(F.expr(rule), F.lit(False))


def _failure_counts(rules: dict[str, str]) -> list:
    return [F.count_if(_failed(rule)).alias(name) for name, rule in rules.items()]


def expect_or_drop(df: DataFrame, rules: dict[str, str], observe_as: str | Observation | None = None) -> DataFrame:
    """Drop rows that break a rule. Works on streams too.

    With ``observe_as`` the failures per rule are counted on the way through and show up in the
    query's observed metrics, without a second pass.

    Rows pass through ``inline`` of a single struct: the filter stays above it, so what the rules look
    at, parsed texts for the most part, is computed once and not again in the filter.
    """
    if not rules:
        return df
    once = df.select(F.inline(F.array(F.struct(*df.columns))))
    if observe_as:
        once = once.observe(observe_as, F.count(F.lit(1)).alias("rows"), *_failure_counts(rules))
    return once.where(reduce(lambda a, b: a & b, [F.expr(rule) for rule in rules.values()]))


def rule_violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(rule, failed_rows, total_rows) in one pass over the data."""
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), *_failure_counts(rules))
    return counts.unpivot("total_rows", list(rules), "rule", "failed_rows").select(
        "rule", "failed_rows", "total_rows"
    )
