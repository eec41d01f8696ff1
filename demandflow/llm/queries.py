"""The registered queries of the corpus operators: contract columns derived from each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm import (
    alignment, embedding_dedup, fingerprint, html_content, language, line_dedup, mixing, ngram_join, packing, pii, spelling, suffix_dedup, toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, Jaccard similarity of 0.9 or more."""
    joined = ngram_join.ngram_join(_table(spark, sf_dir, "documents"), width=3, percent=90)
    return joined.withColumnRenamed("id", "doc_id")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _held_out(3, 1)
    model = language.fit(docs, ~held_out)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    return done.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *pii.digest())


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(packing.with_tokens(docs), tokens=F.col("tokens")).withColumnRenamed("key", "doc_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    held_out = _held_out(5, 0)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels, ~held_out)).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract_text(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id").drop("host")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_language": op2_language,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_fingerprint": op8_fingerprint,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_alignment": op11_alignment,
    "op12_spelling": op12_spelling,
    "op13_html": op13_html,
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, "pipeline": pipeline}
