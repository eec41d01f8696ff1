"""Point-in-time lookup: the newest feature row at or before each row's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_lookup(
    left: DataFrame,
    features: DataFrame,
    keys: list[str],
    left_time: str,
    feature_time: str,
    left_unique: bool = False,
) -> DataFrame:
    """``left`` plus the feature columns valid at ``left_time``; NULLs where there are none yet.

    ``features`` must hold each (keys, feature_time) once. Both sides are laid on one time line
    per key and the last feature row is carried forward: one shuffle, and no pairs are formed.

    Rows that ask for the same key and time are asked once and joined back, so a key with very
    many rows is only as long as its distinct times, and AQE may split the join back. Pass
    ``left_unique=True`` when (keys, left_time) is already a key of ``left``: the rows then ride
    along and the join back is not needed.
    """
    values = [c for c in features.columns if c not in keys and c != feature_time]
    known = features.dropna(subset=[*keys, feature_time]).select(
        *keys, F.col(feature_time).alias("__time"), F.lit(0).alias("__side"),
        F.struct(*values).alias("__feature"),
    )
    if left_unique:
        payload = F.struct(*left.columns)
        asked = left.select(*keys, F.col(left_time).alias("__time"), payload.alias("__row"))
    else:
        asked = left.select(*keys, F.col(left_time).alias("__time")).distinct()
    asked = asked.withColumn("__side", F.lit(1))

    line = Window.partitionBy(*keys).orderBy("__time", "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        asked.unionByName(known, allowMissingColumns=True)
        .withColumn("__feature", F.last("__feature", ignorenulls=True).over(line))
        .where("__side = 1")
    )
    feature_columns = [F.col(f"__feature.{c}").alias(c) for c in values]
    if left_unique:
        return found.select("__row.*", *feature_columns)
    answers = found.select(*keys, F.col("__time").alias(left_time), *feature_columns)
    return left.join(answers, [*keys, left_time], "left").select(*left.columns, *values)
