"""Batch writers and the append-only stream writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandflow.schemas import assert_unique


# A file is the least a task can read when it is one row group, so files are kept small.
ROWS_PER_FILE = 1_000_000
# Tables of all sales are written several times on their way; zstd writes less than the default.
CODEC = "zstd"


def append_stream(stream: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Append all new rows to a parquet table, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", CODEC)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
    """Full refresh of a parquet table; returns the table read back. ``sort_by`` orders the rows of a
    partition, so that a filter on those columns skips most of its row groups."""
    if partition_by:
        # few files per partition value; AQE splits the large values over several tasks
        rebalanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
        if sort_by:
            rebalanced = rebalanced.sortWithinPartitions(*partition_by, *sort_by)
        rebalanced.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def overwrite_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions that ``df`` holds, few files each; others stay as they are."""
    rows = df.hint("rebalance", F.col(column))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """Largest value of a partition column, from the names of the folders: no file is opened."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    values = [status.getPath().getName().split("=", 1)[1] for status in found]
    return max((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), default=None)


def overwrite_table(df: DataFrame, name: str, overwrite_schema: bool = True, path: str | None = None) -> DataFrame:
    """Replace a catalog table, kept at ``path`` if given. With ``overwrite_schema=False`` the columns must
    stay the same."""
    spark = df.sparkSession
    if not overwrite_schema and spark.catalog.tableExists(name):
        before = [(f.name, f.dataType) for f in spark.read.table(name).schema]
        after = [(f.name, f.dataType) for f in df.schema]
        if before != after:
            raise ValueError(f"schema of {name} is frozen: {before} -> {after}")
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.read.table(name)


def snapshot_sync(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Full copy for serving, keyed by ``keys``.

    The copy is written first and checked as written, so the plan behind ``df`` runs once and
    the check sees exactly the rows that will be served.
    """
    return assert_unique(materialize(df, path), keys)


def write_landing(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Landing files: every value as text, parquet or CSV with a header."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    writer = text.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
    if fmt == "parquet":
        writer.option("compression", CODEC).parquet(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"landing files are parquet or csv, not {fmt!r}")
