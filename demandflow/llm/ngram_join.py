"""N-gram Jaccard join: prefix filters under several token orders, intersected before verification.

A document is its set of distinct word shingles. Under any order of all shingles two sets that are
similar enough share a shingle of their prefixes, so a pair is worth a look only if it does so under
each of the orders. Equal sets are one node from the start, so copies cost one row each.

1. One pass gives every document its node (hash of its set) and counts shingles per batch; the most
   frequent ones, a bounded list, go to the end of every order. The list only steers the orders:
   whatever it holds, no link is lost.
2. A second pass emits prefix shingles under two random orders. A task sends no more than about
   ``BUCKET`` rows of a shingle; buckets up to ``BUCKET`` give pairs, larger ones count as hot tokens
   of their nodes. A prefix is made longer by the number of shingles that similar sets must then
   share (``shared_least``): in each order, the buckets a pair shares plus the hot tokens it may
   share must reach that number.
3. Pairs of nodes that could reach it by hot tokens alone come from a third order, rarest shingle first, by the
   counts among hot nodes. Each bucket first links its nodes to one leader; only pairs of different
   components that could still be similar are left: by size, by their number of shared shingles, and by
   parity marks, bits of which every shingle flips one, so that two sets differ in no fewer shingles than
   their marks differ in bits.
4. Candidates are verified on whole texts, and links become components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import _bytes, connected_components, packed_texts, splitmix, stored, unpacker
from demandflow.llm.shingles import shingle_set

BUCKET = 64
FREQUENT = 50_000
SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)
MARKS = 2048
FLUSH = 600_000  # shingles held by a task, some 50 MB with what sorting them takes


def node_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def shared_least(n: int) -> int:
    """Shingles that the prefixes of similar sets must share, for the smaller set's size."""
    return 1 + n // 25


def probe_length(n: int, percent: int) -> int:
    """Prefix that meets every similar set, larger or smaller, often enough."""
    return min(n, n + (-percent * n // 100) + shared_least(n))


def index_length(n: int, percent: int) -> int:
    """Prefix that meets the probe prefix of every similar set of the same size or larger."""
    return min(n, n + (-2 * percent * n // (100 + percent)) + shared_least(n))


def _first_pass(width: int, least: int = 4) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, held, total = [], [], [], 0
            counts: list[tuple[np.ndarray, np.ndarray]] = []
            for text in batch.column(1):
                tokens = shingle_set(_bytes(text), width)
                nodes.append(node_of(tokens) if len(tokens) else None)
                sizes.append(len(tokens))
                held.append(tokens)
                total += len(tokens)
                if total > FLUSH:
                    counts.append(_frequent(held, least))
                    held, total = [], 0
            counts.append(_frequent(held, least))
            tokens, found = (np.concatenate(c) for c in zip(*counts))
            nothing = pa.nulls(len(tokens), pa.int64())
            yield _batch(
                id=pa.concat_arrays([batch.column(0), nothing]),
                node=pa.array(nodes + [None] * len(tokens), pa.int64()),
                n=pa.array(sizes + [None] * len(tokens), pa.int64()),
                token=pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(tokens.view(np.int64))]),
                found=pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(found.astype(np.int64))]),
            )

    return run


def _frequent(sets: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    tokens, found = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
    return tokens[found >= least], found[found >= least]


def _prefix_pass(width: int, percent: int, frequent: np.ndarray) -> Callable:
    """Rows (key, node, meta): key's lowest bit is the order, meta twice the set's size plus whether
    the shingle is in the index prefix. Hot tokens of a node go as minus their number."""

    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            key, node, meta = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(key, kind="stable")
            key, node, meta = key[order], node[order], meta[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[first, len(key)])
            hot = np.repeat(sizes > BUCKET, sizes)
            within = np.arange(len(key)) - np.repeat(first, sizes)
            # the bucket learns of its size by BUCKET + 1 rows, which may count twice; more is only safer
            send = ~hot | (within <= BUCKET)
            yield _batch(key=key[send], node=node[send], meta=meta[send])
            marks, found = np.unique(np.stack([node[hot], key[hot] & 1]), axis=1, return_counts=True)
            yield _batch(key=marks[1], node=marks[0], meta=-found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts, rows = [], 0
        for batch in batches:
            for text in batch.column(1):
                tokens = shingle_set(_bytes(text), width)
                n = len(tokens)
                node = node_of(tokens)
                if not n or node in seen:
                    continue
                seen.add(node)
                at = np.searchsorted(frequent, tokens)
                late = frequent[np.minimum(at, len(frequent) - 1)] == tokens if len(frequent) else np.zeros(n, bool)
                p, own = probe_length(n, percent), index_length(n, percent)
                for k, seed in enumerate(SEEDS):
                    ranks = splitmix(tokens ^ seed)
                    chosen = np.lexsort((ranks, late))[:p] if late.any() else np.argpartition(ranks, p - 1)[:p]
                    chosen = chosen[np.lexsort((ranks[chosen], late[chosen]))]
                    key = (ranks[chosen] & ~np.uint64(1) | np.uint64(k)).view(np.int64)
                    parts.append((key, np.full(p, node), 2 * n + (np.arange(p) < own)))
                    rows += p
                if rows > FLUSH:
                    yield from flush(parts)
                    parts, rows, seen = [], 0, set()
        yield from flush(parts)

    return run


def _bucket_pass(percent: int) -> Callable:
    """Rows sorted by key become (a, b, order, found, least): pairs of a small bucket, or nodes of a
    large one with b null; least is what a pair must share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_now, bucket, hot = None, {}, False
        out: list[tuple] = []

        def close() -> None:
            if not hot and len(bucket) > 1:
                rows = sorted((meta >> 1, node, meta & 1) for node, meta in bucket.items())
                for i, (n, a, own) in enumerate(rows):
                    if own:
                        for m, b, _ in rows[i + 1 :]:
                            if 100 * n < percent * m:
                                break
                            out.append((min(a, b), max(a, b), key_now & 1, 1, shared_least(n)))

        for batch in batches:
            keys, nodes, metas = (batch.column(k) for k in range(3))
            for key, node, meta in zip(keys.to_pylist(), nodes.to_pylist(), metas.to_pylist()):
                if meta < 0:
                    out.append((node, None, key & 1, -meta, None))
                    continue
                if key != key_now:
                    close()
                    key_now, bucket, hot = key, {}, False
                if hot:
                    out.append((node, None, key & 1, 1, None))
                    continue
                bucket[node] = meta
                if len(bucket) > BUCKET:
                    hot = True
                    out.extend((held, None, key & 1, 1, None) for held in bucket)
                    bucket = {}
            if len(out) > 50_000:
                yield _found(out)
                out.clear()
        close()
        yield _found(out)

    return run


def _found(rows: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 5
    return _batch(**{k: pa.array(c, pa.int64()) for k, c in zip(("a", "b", "order", "found", "least"), columns)})


def _batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _verify_pass(width: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, last, left = unpacker(), None, None
        for batch in batches:
            a, b, za, zb = (batch.column(k) for k in range(4))
            keep = []
            for k in range(batch.num_rows):
                if a[k].as_py() != last:
                    last, left = a[k].as_py(), shingle_set(unpack(_bytes(za[k])), width)
                right = shingle_set(unpack(_bytes(zb[k])), width)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _token_pass(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            for node, z in zip(batch.column(0), batch.column(1)):
                tokens = shingle_set(unpack(_bytes(z)), width).view(np.int64)
                yield _batch(node=np.full(len(tokens), node.as_py()), token=tokens, n=np.full(len(tokens), len(tokens)))

    return run


def parity_marks(tokens: np.ndarray) -> np.ndarray:
    """``MARKS`` bits as 64-bit numbers: whether an odd number of shingles falls on each."""
    odd = np.bincount((splitmix(tokens) % np.uint64(MARKS)).astype(np.int64), minlength=MARKS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _mark_pass(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            marks = [parity_marks(shingle_set(unpack(_bytes(z)), width)) for z in batch.column(1)]
            yield _batch(node=batch.column(0), marks=pa.array(marks, pa.list_(pa.int64())))

    return run


def ngram_join(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    frequent_limit: int = FREQUENT,
) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles; component_id is the smallest id reachable by links. Texts without words, null texts and
    rows with a null id link with nothing. Repeated rows are equal sets, so they link; an id with
    several texts is one row per text. Texts may be of any length; an empty table gives no rows. Other
    columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    first = stored(texts.mapInArrow(_first_pass(width), "id long, node long, n long, token long, found long"), "sets")
    sets = first.where("n is not null").select("id", "node", "n")
    nodes = sets.where("n > 0 and id is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    counted = first.where("token is not null").groupBy("token").agg(F.sum("found").alias("found"))
    top = counted.where(F.col("found") > BUCKET).orderBy(F.desc("found"), "token").limit(frequent_limit).collect()
    frequent = np.sort(np.array([r.token for r in top], np.int64).view(np.uint64))

    keyed = texts.where("id is not null").mapInArrow(_prefix_pass(width, percent, frequent), "key long, node long, meta long")
    spread = keyed.repartition(F.when(F.col("meta") < 0, F.col("node")).otherwise(F.col("key")))
    met = spread.sortWithinPartitions("key").mapInArrow(
        _bucket_pass(percent), "a long, b long, order long, found long, least long"
    )
    per_order = [F.sum(F.when(F.col("order") == k, F.col("found")).otherwise(0)) for k in range(len(SEEDS))]
    met = met.groupBy("a", "b").agg(F.array(*per_order).alias("found"), F.max("least").alias("least"))
    met = stored(met, "candidates")

    hot = met.where("b is null").select(F.col("a").alias("node"), F.col("found").alias("hot"))
    pairs = met.where("b is not null")
    none = F.array(*[F.lit(0).cast("long")] * len(SEEDS))
    for side in ("a", "b"):
        pairs = pairs.join(hot.select(F.col("node").alias(side), F.col("hot").alias(f"hot_{side}")), side, "left")
        pairs = pairs.withColumn(f"hot_{side}", F.coalesce(f"hot_{side}", none))
    enough = [
        F.col("found")[k] + F.least(F.col("hot_a")[k], F.col("hot_b")[k]) >= F.col("least") for k in range(len(SEEDS))
    ]
    pairs = stored(pairs.where(reduce(and_, enough)).select("a", "b"), "pairs")
    # the smallest partner asks for the fewest shared shingles
    fewest = 1 + F.floor(F.floor(F.col("n") * percent / 100) / 25)
    everywhere = hot.join(nodes, "node").where(reduce(and_, [F.col("hot")[k] >= fewest for k in range(len(SEEDS))])).select("node")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(everywhere).distinct().join(nodes, "node")
    packed = packed_texts(docs, id_col, text_col).join(wanted.select("node", "id"), "id")
    frames = stored(packed.mapInArrow(_own_text(width), "node long, z binary").dropDuplicates(["node"]), "texts")

    def verified(candidates: DataFrame) -> DataFrame:
        left, right = frames.toDF("a", "za"), frames.toDF("b", "zb")
        rows = candidates.join(left, "a").join(right, "b").select("a", "b", "za", "zb")
        return rows.sortWithinPartitions("a").mapInArrow(_verify_pass(width, percent), "a long, b long")

    links = stored(verified(pairs).union(_hot_links(frames, everywhere, width, percent, verified)), "links")
    reached = connected_components(links)
    labels = reached.join(nodes, "node", "left").groupBy("component").agg(F.min("id").alias("smallest"))
    by_node = nodes.join(reached.join(labels, "component").select("node", "smallest"), "node", "left")
    by_node = by_node.select("node", F.coalesce("smallest", "id").alias("smallest"))
    return sets.join(by_node, "node", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("smallest", "id")).alias("component_id")
    )


def _own_text(width: int) -> Callable:
    """(node, z) of the rows whose text is the node's; an id may stand with several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            z, node = batch.column("z"), batch.column("node")
            own = [node_of(shingle_set(unpack(_bytes(z[k])), width)) == node[k].as_py() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([node, z], ["node", "z"]).filter(pa.array(own, pa.bool_()))

    return run


def _hot_links(frames: DataFrame, hot: DataFrame, width: int, percent: int, verified: Callable) -> DataFrame:
    """Links among nodes that are hot in every order; those to leaders are given as links to the smallest node reached."""
    tokens = frames.join(hot, "node", "left_semi").mapInArrow(_token_pass(width), "node long, token long, n long")
    tokens = stored(tokens, "hot-tokens")
    df = tokens.groupBy("token").agg(F.count("*").alias("df"))
    shared = tokens.join(df.where("df > 1"), "token")
    # a node's shingles from the rarest on; those of df 1 come first and meet nothing
    ranked = shared.groupBy("node", "n").agg(
        F.count("*").alias("v"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared")
    )
    n, alone = F.col("n"), F.col("n") - F.col("v")
    probe = n - F.ceil(percent * n / 100) + 1 - alone
    own = n - F.ceil(2 * percent * n / (100 + percent)) + 1 - alone
    keyed = ranked.where(probe > 0).select(
        "node", "n", "v", F.greatest(own, F.lit(0)).alias("own"),
        F.posexplode(F.slice("shared", 1, F.least(probe, F.size("shared")).cast("int"))).alias("at", "s"),
    )
    marks = frames.join(hot, "node", "left_semi").mapInArrow(_mark_pass(width), "node long, marks array<long>")
    keyed = keyed.select("node", "n", "v", (F.col("at") < F.col("own")).alias("own"), F.col("s.token").alias("token"))
    keyed = stored(keyed.join(marks, "node"), "hot-prefixes")

    leaders = keyed.groupBy("token").agg(F.max(F.struct("v", "node", "n", "marks")).alias("leader"))
    led = keyed.join(leaders, "token").where(F.col("node") != F.col("leader.node"))
    one, other = ({c: F.col(f"{side}{c}") for c in ("n", "v", "marks")} for side in ("", "leader."))
    led = led.where(_possible(one, other, percent))
    star = led.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()
    star_links = stored(verified(star), "hot-stars")
    part = stored(connected_components(star_links), "hot-parts")
    keyed = keyed.join(part, "node", "left").withColumn("component", F.coalesce("component", "node"))
    x, y = keyed.alias("x"), keyed.alias("y")
    one, other = ({c: F.col(f"{side}.{c}") for c in ("n", "v", "marks")} for side in "xy")
    apart = (
        (F.col("x.token") == F.col("y.token")) & F.col("x.own")
        & (F.struct("x.n", "x.node") < F.struct("y.n", "y.node")) & (F.col("x.component") != F.col("y.component"))
        & _possible(one, other, percent)
    )
    rest = x.join(y, apart).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    # whoever joins links again need not find these components twice
    return part.select("node", "component").union(verified(rest.distinct()))


def _possible(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Sizes allow a link, the smaller number of shared shingles reaches the needed overlap, and the sets
    do not differ in too many of the marks."""
    n, m = a["n"], b["n"]
    differ = F.aggregate(F.zip_with(a["marks"], b["marks"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    sizes = (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * F.least(a["v"], b["v"]) >= percent * (n + m))
    return sizes & ((100 + percent) * (n + m - differ) >= 2 * percent * (n + m))
