"""Incremental and batch readers for the landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _stream(spark: SparkSession, schema: StructType, glob: str | None, max_files: int | None):
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader


def stream_parquet(
    spark: SparkSession, folder: str, schema: StructType, glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of parquet files: with a checkpoint each file is read once.

    A file overwritten under its old name is not read again; deliver it under a new name.
    """
    return _stream(spark, schema, glob, max_files).parquet(folder)


def stream_csv(
    spark: SparkSession, folder: str, schema: StructType, header: bool = True,
    glob: str | None = None, max_files: int | None = None,
) -> DataFrame:
    return _stream(spark, schema, glob, max_files).option("header", header).csv(folder)


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the rows appended to a parquet table written by an earlier stream.

    The table's own schema is used, so the reader needs no copy of it.
    """
    return _stream(spark, spark.read.parquet(path).schema, None, max_files).parquet(path)


def with_ingest_metadata(df: DataFrame, source_system: str) -> DataFrame:
    """Add where a row came from and when. Apply straight to a file read."""
    return df.withColumns({
        "_source_file": F.col("_metadata.file_path"),
        "_ingested_at": F.current_timestamp(),
        "_source_system": F.lit(source_system),
    })


def read_table(spark: SparkSession, source: str, *columns: str) -> DataFrame:
    """Table by catalog name, or parquet folder by path, with only the named columns."""
    df = spark.read.parquet(source) if "/" in source else spark.read.table(source)
    return df.select(*columns) if columns else df
