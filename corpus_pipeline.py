"""Raw documents to packed training sequences: five stages, each written and read again.

All stages but the last return the columns of documents and drop others. Texts may be of any length.
An empty table gives an empty result in every stage; repeated rows and null or repeated ids are kept
unless a stage says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm import language, line_dedup, mixing, ngram_join, packing
from demandflow.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay, also short ones that several share; null texts
    and texts without letters go."""
    found = language.identify(docs, language.fit(docs, F.lit(True)))
    return found.where(F.col("language.lang_pred") != language.UNKNOWN).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the largest id that holds them; n_chars follows the text.
    Null and empty texts stay as they are; rows of one id count as one document, each cleaned by itself."""
    cleaned = line_dedup.line_dedup(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays; rows with equal id and text are one
    document, an id with different texts is several, rows without an id all stay."""
    # the join names documents by one number, which ids that repeat are not
    named = docs.select(*COLUMNS).where("doc_id is not null").withColumn("row", F.xxhash64("doc_id", "text"))
    joined = ngram_join.ngram_join(named.select("row", "text"), width=5, percent=80, id_col="row")
    groups = joined.select(F.col("id").alias("row"), "component_id").distinct()
    ids = named.select("row", "doc_id").distinct().join(groups, "row")
    keep = ids.groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.row")
    kept = named.join(keep, "row", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per chosen copy; every document is chosen at least once. Weights are in the tokens that
    packing counts; null and empty texts are one token, rows without an id go by their text."""
    counted = packing.with_tokens(docs.select("doc_id", "source", "text"))
    chosen = mixing.mix(counted, tokens=F.col("tokens")).select("key", F.col("source").alias("of"))
    rows = docs.select(*COLUMNS).withColumn("key", mixing.row_key())
    same = (rows["key"] == chosen["key"]) & rows["source"].eqNullSafe(chosen["of"])
    return rows.join(chosen, same).select(*[rows[c] for c in COLUMNS])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their place in a sequence; null and empty texts are one end token."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Language models and tokens are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
