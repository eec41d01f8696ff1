"""Mixing sources to target weights: temperature, then budgeted block permutations.

A source's weight is its token share to the power of an exponent, normalised. Exponent 1 keeps the
natural mix, 0 makes all sources equal. Entropy falls and repetition falls as the exponent grows, so
both targets are met by bisection: the exponent of the target entropy, raised where a source would
be repeated more often than the limit.

Weights become rows in epochs. A source that owes 2.4 times its tokens is taken twice whole and once
for four tenths. Its documents are dealt by hash into blocks of a bounded number of documents; in the
last epoch each block is permuted and taken until its part of the budget is used up, so a source
with a third of all rows is many small windows, and no source, block or weight list is gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import stored

TOKEN_BYTES = 4
BLOCK = 4096
PROBES = 15
PASSES = 6
SEED = 17


def estimated_tokens(text: Column) -> Column:
    """Tokens of a text with its end mark, at ``TOKEN_BYTES`` bytes each."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / TOKEN_BYTES).cast("long") + 1


def find_exponent(
    sources: DataFrame, entropy_share: float | None, repetition_limit: float | None, budget: float | None
) -> float:
    """Exponent in [0, 1] for sources with a column ``tokens``.

    Each pass evaluates ``PROBES`` exponents in one aggregation over the sources and keeps the
    interval that holds the answer, so a pass is worth four halvings.
    """
    low, high = 0.0, 1.0
    total, count, largest, smallest = sources.agg(F.sum("tokens"), F.count("*"), F.max("tokens"), F.min("tokens")).first()
    if not count:
        return 1.0
    for _ in range(PASSES):
        steps = [low + (high - low) * k / (PROBES + 1) for k in range(1, PROBES + 1)]
        share = F.col("tokens") / F.lit(float(total))
        powers = [(F.pow(share, F.lit(a)), a) for a in steps]
        row = sources.agg(
            *[F.sum(p).alias(f"z{k}") for k, (p, _) in enumerate(powers)],
            *[F.sum(p * F.log(share) * a).alias(f"l{k}") for k, (p, a) in enumerate(powers)],
        ).first()
        for k, a in enumerate(steps):
            z = row[f"z{k}"]
            entropy = math.log(z) - row[f"l{k}"] / z
            size = budget if budget is not None else total * z * (largest / total) ** (1 - a)
            most = size / total * (smallest / total) ** (a - 1) / z
            # the answer is the largest exponent with enough entropy, raised until nothing repeats too often
            too_even = repetition_limit is not None and most > repetition_limit
            enough = entropy_share is None or entropy >= entropy_share * math.log(count)
            if too_even or enough and entropy_share is not None:
                low = max(low, a)
            else:
                high = a
                break
    return high


def mix(
    docs: DataFrame, entropy_share: float | None = 0.98, repetition_limit: float | None = 1.25, budget: float | None = None,
    tokens: Column | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """(key, source, copy, tokens, weight, position): one row per chosen copy of a document.

    ``entropy_share`` is the target entropy as a share of that of equal weights, ``repetition_limit``
    how often a source's tokens may be used, and wins. ``budget`` counts tokens; without one it is
    the smallest at which every source is used once in full, so no document is lost. position in
    [0, 1) spreads every source evenly over the mix: any stretch of it has the target weights.

    key is the id, or a hash of the text where the id is null; rows that share it are one document
    and are chosen together. A null source is a source of its own. Null and empty texts are one
    token; an empty table gives no rows. Other columns are ignored. Without ``tokens`` they are estimated from bytes; weights that
    hold for a tokenizer need its counts (``packing.with_tokens``).
    """
    rows = docs.select(
        row_key(id_col, text_col).alias("key"), F.col(source_col).alias("source"),
        (tokens if tokens is not None else estimated_tokens(F.col(text_col))).alias("tokens"),
    )
    held = stored(rows.groupBy("key", "source").agg(F.sum("tokens").alias("tokens")), "mix-rows")
    sources = stored(held.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "mix-sources")
    exponent = find_exponent(sources, entropy_share, repetition_limit, budget)
    total, largest = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    share = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent))
    scale = sources.agg(F.sum(share)).first()[0] or 1.0
    size = budget if budget is not None else (total or 1) * scale * ((largest or 1) / (total or 1)) ** (1 - exponent)
    weights = sources.select(
        F.col("source").alias("of"), (share / scale).alias("weight"), "docs",
        (share / scale * size / F.col("tokens")).alias("owed"),
    ).withColumn("owed", F.when(F.abs(F.col("owed") - F.round("owed")) < 1e-9, F.round("owed")).otherwise(F.col("owed")))
    dealt = held.join(weights, held["source"].eqNullSafe(weights["of"])).select(
        "key", "source", "tokens", "weight", "owed", F.floor("owed").cast("int").alias("whole"),
        F.pmod(F.xxhash64("key", F.lit(SEED)), F.ceil(F.col("docs") / block)).alias("block"),
    )
    # the part of an epoch: a block is permuted and used up to its budget; the document on the edge is
    # in with the chance of what is left for it
    in_block = Window.partitionBy("source", "block")
    before = F.sum("tokens").over(in_block.orderBy(_spread("whole"), "key").rowsBetween(Window.unboundedPreceding, -1))
    quota = F.sum("tokens").over(in_block) * (F.col("owed") - F.col("whole"))
    parts = dealt.withColumn("left", quota - F.coalesce(before, F.lit(0))).where(
        F.col("left") > _uniform(_spread(F.lit(-1))) * F.col("tokens")
    )
    chosen = dealt.where("whole > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
    chosen = chosen.unionByName(parts.withColumn("copy", F.col("whole")).drop("left"))
    place = F.col("copy") + _uniform(_spread(F.col("copy"))) * F.least(F.lit(1.0), F.col("owed") - F.col("copy"))
    return chosen.select("key", "source", "copy", "tokens", "weight", (place / F.col("owed")).alias("position"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col))


def _spread(epoch: str | Column) -> Column:
    return F.xxhash64("key", F.lit(SEED + 1), epoch)


def _uniform(h: Column) -> Column:
    return F.pmod(h, F.lit(1 << 52)) / float(1 << 52)
