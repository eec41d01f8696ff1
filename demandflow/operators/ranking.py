"""Top-k reports and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """First ``k`` rows. Each task keeps ``k`` rows, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(k)


def top_k_with_ties(df: DataFrame, k: int, value: str) -> DataFrame:
    """Rows ranked ``k`` or better by ``value`` descending; rows that tie with the k-th stay.

    The k-th largest value is found by a top-k and used as a threshold, so there is no global
    window. With fewer than ``k`` rows the threshold is the smallest value and all rows stay.
    """
    threshold = df.select(value).where(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(k).agg(F.min(value))
    return df.where(F.col(value) >= threshold.scalar())


def sample_rows(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The first ``n`` rows by key: a repeatable sample."""
    return top_k(df, n, *keys)
