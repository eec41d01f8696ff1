"""Line dedup: lines that many documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import ASCII_SPACE, ASCII_UPPER, stored

MIN_CHARS = 40
MIN_DOCS = 5


def line_dedup(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with shared lines taken out, and a column ``line_dedup`` (n_lines, n_dropped).

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. A key of
    ``min_chars`` code points or more that stands in ``min_docs`` documents or more loses its lines
    everywhere but in the largest document id that holds it.

    Lines are exploded with their position and hashed (two 64-bit hashes together make the key);
    documents per key are counted over distinct (key, document) with map-side partial sums, so a line in
    a third of all documents is no hot task. Only the positions to drop travel back, as one list per
    text, and the others are put together again in order, in time linear in the lines.

    Null or empty text is one empty line and stays null or empty. Rows that repeat a document id
    count as one document, each is cleaned by itself; a null id counts as one document, smaller than
    all others. Texts may be of any length; an empty table gives no rows. Other columns pass through; one
    named ``line_dedup`` is replaced.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.struct(*[F.col(c) for c in docs.columns if c not in (text_col, "line_dedup")]).alias("row"),
    )
    # an id may stand with several texts, whose lines have positions of their own
    base = base.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64("text", F.lit(1))})
    lines = base.select("id", "t1", "t2", F.posexplode(_lines(_folded("text"))).alias("pos", "key"))
    held = lines.where(F.length("key") >= min_chars).select(
        "id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2")
    )
    held = stored(held, "lines")
    owners = held.select("h1", "h2", "id").distinct()
    shared = owners.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    lost = held.join(shared, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    drops = lost.groupBy(F.col("id").alias("in_id"), "t1", "t2").agg(F.collect_set("pos").alias("drops"))

    same = F.col("id").eqNullSafe(F.col("in_id")) & (base["t1"] == drops["t1"]) & (base["t2"] == drops["t2"])
    joined = base.join(drops, same, "left").select("row", "text", "drops", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drops")
    cut = joined.withColumn("places", F.when(F.col("drops").isNotNull(), places))
    kept = F.transform("places", lambda at: F.get("lines", at))
    done = cut.select(
        "row",
        F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.struct(
            F.size("lines").cast("long").alias("n_lines"),
            F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("places")).cast("long").alias("n_dropped"),
        ).alias("line_dedup"),
    )
    columns = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c != "line_dedup"]
    return done.select(*columns, "line_dedup")


def _folded(text: str) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(ASCII_SPACE)))
