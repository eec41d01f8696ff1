"""Newest row per key, and the batch upsert built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], sequence_by: list[str]) -> DataFrame:
    """Keep the newest row of each key, newest by ``sequence_by``.

    Equal sequences are settled by the remaining columns, so the result never depends on row
    order. It is one aggregate: each task keeps one row per key before the shuffle, so a key
    that owns a large share of the rows costs no more than any other. A NULL sequence is the
    oldest, but still kept when it is all a key has.
    """
    rest = [c for c in df.columns if c not in keys and c not in sequence_by]
    newest = F.max(F.struct(*sequence_by, *rest)).alias("__newest")
    columns = [F.col(c) if c in keys else F.col(f"__newest.{c}").alias(c) for c in df.columns]
    return df.groupBy(*keys).agg(newest).select(*columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> bool:
    """Whether a key may occur twice. Keys are counted by a number of 64 bits each, so numbers are shuffled and no rows,
    and nothing is sorted; two keys of one number count as the same, which is rare and only asks for a reduction."""
    return not df.groupBy(F.xxhash64(*keys)).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty()


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace rows of ``target`` with the same key; no row is ever deleted.

    ``updates`` must hold each key once.
    """
    untouched = target.join(updates.select(*keys), keys, "left_anti")
    return untouched.unionByName(updates)
