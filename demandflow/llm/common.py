"""Helpers the corpus operators share: scratch tables, packed texts, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.session import run_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, a lost executor
    costs the tasks it ran and nothing before the table."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def packed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, z): texts as zstd frames, so that a shuffle of whole texts moves less than the table."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_pack, "id bigint, z binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        z = [pack(_bytes(t)) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], ["id", "z"])


def _bytes(scalar: pa.Scalar) -> bytes:
    return scalar.as_buffer().to_pybytes() if scalar.is_valid else b""


def unpacker():
    return zstandard.ZstdDecompressor().decompress


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps in turn, until every node hangs on its smallest one: every round is two
    aggregations and two equality joins over as many rows as there are edges, so hubs are pre-aggregated or split by
    AQE and no component is ever gathered. The number of rounds follows the logarithm of the longest chain.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
    )
    while not _are_stars(now):
        both = now.union(now.select("lo", "hi"))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        # a row per edge; small-star drops those that became equal
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stored(large, "large-star")
        least = now.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = now.join(least, "hi")
        small = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stored(small.union(joined.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is the larger end of one edge or the smaller end of any number: a further round would
    change nothing."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("lo", F.lit(0), F.lit(1))
    )
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.where(F.col("up") + F.col("down") > 1).agg(F.count("*")).first()[0] == 0


def splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64, grown on demand."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


BYTE_VALUES = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = hash of values[i:j], shifted by BASE**i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out
