"""Landing files to bronze, bronze to silver, and the status feed.

Every flow runs until its source is drained and then stops, so a job can run the flows one after
the other. Progress lives in the checkpoint: running a flow again only reads what is new.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandflow.operators.conform import CONFORM
from demandflow.operators.quality import RULES, expect_or_drop, rule_violations
from demandflow.plans.actions import status_rows
from demandflow.schemas import KEYS, LANDING_SCHEMAS, SOURCE_SYSTEMS
from demandflow.sinks.keyed import KeyedTable
from demandflow.sinks.tables import append_stream
from demandflow.sources.landing import stream_csv, stream_parquet, stream_table, with_ingest_metadata


def landing_stream(
    spark: SparkSession, feed: str, folder: str, glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    read = stream_csv if feed == "promotions" else stream_parquet
    files = read(spark, folder, LANDING_SCHEMAS[feed], glob=glob, max_files=max_files)
    return with_ingest_metadata(files, SOURCE_SYSTEMS[feed])


def run_bronze(
    spark: SparkSession, feed: str, folder: str, path: str, checkpoint: str,
    glob: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """New landing files appended to the bronze table.

    ``max_files`` bounds the files of one micro-batch. Set it for a backfill: a failure then
    repeats one micro-batch, not the whole load.
    """
    stream = landing_stream(spark, feed, folder, glob, max_files)
    query = append_stream(stream, path, checkpoint, f"bronze_{feed}")
    query.awaitTermination()
    return query


def scd1_upsert(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Keep the newest row per key of a stream, whatever order the rows arrive in. ``prepare`` gets
    every micro-batch with its number and gives the rows to keep."""
    flow = flow_id(stream.sparkSession, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply(prepare(batch, batch_id) if prepare else batch, batch_id, flow)
        if not table.is_one_batch():
            table.compact_if_due()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def flow_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of a flow, kept in its checkpoint: a new or reset checkpoint is another flow, whose batch
    numbers start again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/flow_names")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path, uuid.uuid4().hex))
    return min(status.getPath().getName() for status in files.listStatus(path))


def silver_table(spark: SparkSession, feed: str, bronze: str, path: str) -> KeyedTable:
    schema = CONFORM[feed](spark.read.parquet(bronze)).schema
    return KeyedTable(spark, path, schema, KEYS[feed], ["_updated_at"], distinct=True)


def run_silver(
    spark: SparkSession, feed: str, bronze: str, path: str, checkpoint: str, max_files: int | None = None
) -> KeyedTable:
    """New bronze rows typed, checked and upserted.

    Rules come first, so a bad update never replaces a good row. Every micro-batch also writes how many
    rows each rule failed, see ``rule_failures``.
    """
    table, flow = silver_table(spark, feed, bronze, path), flow_id(spark, checkpoint)
    typed = CONFORM[feed](stream_table(spark, bronze, max_files))

    def counted(batch: DataFrame, batch_id: int) -> DataFrame:
        if RULES[feed]:
            write_rule_counts(batch, feed, f"{path}/rules", flow, batch_id)
        return expect_or_drop(batch, RULES[feed])

    scd1_upsert(typed, table, checkpoint, counted, name=f"silver_{feed}").awaitTermination()
    return table


def write_rule_counts(batch: DataFrame, feed: str, path: str, flow: str, batch_id: int) -> None:
    """(rule, failed_rows, total_rows) of a micro-batch, in a folder of its own: a replay writes the
    same folder again and does not count twice."""
    counts = rule_violations(batch, RULES[feed]).coalesce(1)
    counts.write.mode("overwrite").parquet(f"{path}/_flow={flow}/_batch={batch_id}")


def rule_failures(spark: SparkSession, path: str) -> DataFrame:
    """(rule, failed_rows, total_rows) over all micro-batches of all flows that fed the silver table at ``path``."""
    counts = spark.read.schema("rule string, failed_rows long, total_rows long").parquet(f"{path}/rules")
    return counts.groupBy("rule").agg(F.sum("failed_rows").alias("failed_rows"), F.sum("total_rows").alias("total_rows"))


def run_status(updates: DataFrame, path: str, checkpoint: str, order: list[str]) -> KeyedTable:
    """Status updates written back by key; readers of the table see them with the next read."""
    rows = status_rows(updates, order)
    table = KeyedTable(updates.sparkSession, path, rows.schema, KEYS["status"], order)
    scd1_upsert(rows, table, checkpoint, name="action_status").awaitTermination()
    return table
