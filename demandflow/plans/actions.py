"""The action list, its serving queue and the status of each action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from demandflow.functions.measures import action_risk_type, at_risk
from demandflow.operators.dimensions import BROADCAST_MAX_ROWS, with_names
from demandflow.operators.latest import latest_per_key, upsert
from demandflow.operators.ranking import top_k
from demandflow.operators.selection import ALL, earliest_week, multi_filter
from demandflow.schemas import KEYS

QUEUE_SIZE = 500
DEFAULT_STATUS = "open"

STATUS_SCHEMA = StructType([
    StructField("action_id", StringType()),
    StructField("sku", StringType()),
    StructField("store_id", StringType()),
    StructField("week", DateType()),
    StructField("status", StringType()),
    StructField("note", StringType()),
    StructField("updated_by", StringType()),
    StructField("updated_at", TimestampType()),
])

QUEUE_COLUMNS = [
    "sku", "store_id", "week", "store_name", "region", "product_name", "category",
    "predicted_demand", "avg_demand_last_12w", "risk_type", "demand_delta",
    "status", "note", "updated_by", "updated_at",
]


def action_list(forecast: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """At-risk forecast rows with names; the delta uses the average before it is rounded."""
    average = F.col("avg_demand_last_12w")
    return with_names(forecast.where(at_risk()), stores, products).select(
        "sku", "store_id", "week", "store_name", "region", "product_name", "category",
        "predicted_demand",
        F.round(average, 1).alias("avg_demand_last_12w"),
        action_risk_type().alias("risk_type"),
        F.round(F.col("predicted_demand") - average, 0).cast("int").alias("demand_delta"),
        "model_version",
    )


def status_rows(updates: DataFrame, order: list[str]) -> DataFrame:
    """Updates as status rows. One that lacks sku, store, week or status is rejected; like the
    service, an empty text counts as missing. ``order`` names the columns that say which is newer."""
    complete = " AND ".join(f"{c} <> ''" for c in ("sku", "store_id", "status")) + " AND week IS NOT NULL"
    action_id = F.concat_ws("::", "sku", "store_id", F.date_format("week", "yyyy-MM-dd"))
    rows = updates.where(complete).withColumn("action_id", action_id)
    return rows.select(*STATUS_SCHEMA.names, *[c for c in order if c not in STATUS_SCHEMA.names])


def upsert_status(current: DataFrame | None, updates: DataFrame, order: list[str]) -> DataFrame:
    """Status table after a set of updates; of several updates to one action the newest wins."""
    newest = latest_per_key(status_rows(updates, order), KEYS["status"], order).select(*STATUS_SCHEMA.names)
    return newest if current is None else upsert(current, newest, KEYS["status"])


def week_actions(actions: DataFrame, status: DataFrame) -> DataFrame:
    """All actions of the next week with their status, for counts and for the choices of filters."""
    rows = earliest_week(actions)
    found = status.select(*KEYS["actions"], "status")
    return rows.join(found, KEYS["actions"], "left").withColumn("status", F.coalesce("status", F.lit(DEFAULT_STATUS)))


def action_queue(actions: DataFrame, status: DataFrame, k: int = QUEUE_SIZE, filters: dict[str, str] | None = None) -> DataFrame:
    """The next week's actions with their status: stockouts first, then by size of the gap.

    Filters apply before the cut, so a filtered queue is as long as it can be. The status is looked
    up first only if it is filtered. Otherwise the top ``k`` is taken before the status is looked up, and the status table is cut down to
    those actions by a broadcast of their keys, so it is read once and never shuffled. It has one
    row per action, so the join cannot change the order or the number.
    """
    ranking = [
        F.desc(F.col("risk_type") == "Stockout"), F.desc(F.abs("demand_delta")), F.asc("sku"), F.asc("store_id")
    ]
    filters = dict(filters or {})
    wanted_status = filters.pop("status", ALL)
    rows = earliest_week(actions)
    if wanted_status != ALL:
        rows = week_actions(actions, status).where(F.col("status") == wanted_status).drop("status")
    top = top_k(multi_filter(rows, **filters), k, *ranking)
    wanted = top.select(*KEYS["actions"])
    current = status.select(*KEYS["actions"], "status", "note", "updated_by", "updated_at").join(
        F.broadcast(wanted) if k <= BROADCAST_MAX_ROWS else wanted, KEYS["actions"], "left_semi"
    )
    return (
        top.join(current, KEYS["actions"], "left")
        .withColumn("status", F.coalesce("status", F.lit(DEFAULT_STATUS)))
        .select(*QUEUE_COLUMNS)
        .orderBy(*ranking)
    )


def queue_counts(queue: DataFrame) -> DataFrame:
    return queue.agg(*[
        F.count_if(F.col("risk_type") == kind).alias(f"{kind.lower()}_count")
        for kind in ("Stockout", "Overstock", "Both")
    ])
