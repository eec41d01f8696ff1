"""Embedding near-dedup with spherical-cap filters from random product codes.

A unit vector is rotated and cut into ``BLOCKS`` parts; each part has a codebook of random
directions, and every choice of one direction per part is a filter. A vector belongs to all filters
whose direction it exceeds by the cap's height. That height is the vector's own: it reaches down to its
``caps_of``-th best direction, more of them as the codebooks grow, which keeps the recall. List decoding finds them without trying all: only the best sums of the first
two parts and of the last two are combined.
Close vectors share most of their filters; pairs that share one are compared exactly.

The codebooks grow with the number of vectors (filters are a fixed multiple of it), so buckets do
not. Every table goes this way, whatever its size. Equal vectors are one row from the start. A bucket of more than ``BLOCK`` vectors is cut into
blocks and compared block by block; each task returns counts and a spanning forest, never the pairs.
A pair that shares several filters counts in the smallest one only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import connected_components, stored

BLOCKS = 4
BLOCK = 1024
FILTERS_PER_VECTOR = 8


def caps_of(books: int) -> int:
    """Directions a vector's cap takes in: with as many, pairs at cosine 0.95 meet in 0.97 of cases or
    more, from 500 to 100 million vectors (see the recall tests)."""
    return max(24, math.ceil(0.45 * books))


class CapFilters:
    def __init__(self, dim: int, vectors: int, per_vector: int | None = None, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.books = max(8, math.ceil((FILTERS_PER_VECTOR * max(1, vectors)) ** (1 / BLOCKS)))
        self.rotation = np.linalg.qr(draw.standard_normal((dim, dim)))[0]
        edges = np.linspace(0, dim, BLOCKS + 1).astype(int)
        self.parts = list(zip(edges[:-1], edges[1:]))
        self.codes = []
        for a, b in self.parts:
            # parts of short vectors may be empty or one number, which has two directions
            code = draw.standard_normal((b - a, self.books)) if b - a > 1 else np.array([[-1.0, 1.0]] if b > a else np.empty((0, 1)))
            self.codes.append(code / np.maximum(np.linalg.norm(code, axis=0), 1e-300))
        self.per_vector = min(per_vector or caps_of(self.books), math.prod(code.shape[1] for code in self.codes))

    def _halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = unit @ self.rotation
        s = [turned[:, a:b] @ code for (a, b), code in zip(self.parts, self.codes)]
        return tuple((s[k][:, :, None] + s[k + 1][:, None, :]).reshape(len(unit), -1) for k in (0, 2))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of each row."""
        out, wide = [], self.books**2
        for start in range(0, len(unit), 512):
            # the best k sums of two lists are among the best k of each
            (low, i), (high, j) = (self._best(half) for half in self._halves(unit[start : start + 512]))
            sums = (low[:, :, None] + high[:, None, :]).reshape(len(low), -1)
            best = np.argpartition(-sums, self.per_vector - 1, axis=1)[:, : self.per_vector]
            rows = np.arange(len(low))[:, None]
            number = i[rows, best // high.shape[1]] * wide + j[rows, best % high.shape[1]]
            out.extend(np.sort(number.astype(np.int64), axis=1))
        return out

    def _best(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = min(self.per_vector, sums.shape[1])
        at = np.argpartition(-sums, k - 1, axis=1)[:, :k]
        return np.take_along_axis(sums, at, axis=1), at


def _decode_pass(counts: dict[int, int], per_vector: int | None) -> Callable:
    """Filters of each vector, of its own length's books; ``counts`` has the vectors of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: tuple[int, Callable | None] = (0, None)
        for batch in batches:
            lengths = np.asarray(pc.list_value_length(batch.column(2)))
            parts = (batch.take(pa.array(np.flatnonzero(lengths == dim))) for dim in np.unique(lengths))
            for part in (p.slice(k, 2000) for p in parts for k in range(0, p.num_rows, 2000)):
                node, copies, vectors = (part.column(i) for i in range(3))
                dim = len(vectors[0])
                if made[0] != dim:
                    made = dim, CapFilters(dim, counts[dim], per_vector).decode
                unit = _unit(vectors)
                filters = made[1](unit)
                n = np.array([len(f) for f in filters])
                rows = pa.array(np.repeat(np.arange(len(n)), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), dim, np.int32)), pa.array(np.concatenate(filters)), node.take(rows), copies.take(rows), vectors.take(rows),
                     pa.array(filters, pa.list_(pa.int64())).take(rows)],
                    ["dim", "filter", "node", "copies", "vector", "filters"],
                )

    return run


def _unit(vectors: pa.Array) -> np.ndarray:
    x = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare_pass(threshold: float) -> Callable:
    """Runs of one (dim, filter, left, right) become (node, links, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if carried is not None:
                table = pa.concat_tables([carried, table]).combine_chunks()
            firsts = _starts(table)
            yield from compare(table.slice(0, firsts[-1]), firsts)
            carried = table.slice(firsts[-1])
        if carried is not None and carried.num_rows:
            yield from compare(carried, np.r_[_starts(carried), carried.num_rows])

    def _starts(table: pa.Table) -> np.ndarray:
        keys = np.stack([table.column(c).to_numpy() for c in ("dim", "filter", "left", "right")])
        return np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])

    def compare(table: pa.Table, firsts: np.ndarray) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], []]
        for a, b in zip(firsts[:-1], firsts[1:]):
            if b - a > 1:
                for k, part in enumerate(solve(table.slice(a, b - a).combine_chunks())):
                    out[k].append(part)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["node", "links", "label"])

    def solve(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own, left, right = (rows.column(c).to_numpy() for c in ("block", "left", "right"))
        node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        unit = _unit(rows.column("vector").chunk(0))
        a = np.flatnonzero(own == left[0])
        same = left[0] == right[0]
        b = a if same else np.flatnonzero(own == right[0])
        linked = unit[a] @ unit[b].T >= threshold
        if same:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        linked &= ~_earlier(rows.column("filters").chunk(0), int(rows.column("filter")[0].as_py()), a, b)
        label = node.copy()
        while True:  # smallest label along links, until nothing changes
            before = label.copy()
            big = np.iinfo(np.int64).max
            label[a] = np.minimum(label[a], np.where(linked, label[b][None, :], big).min(axis=1, initial=big))
            label[b] = np.minimum(label[b], np.where(linked, label[a][:, None], big).min(axis=0, initial=big))
            if (label == before).all():
                break
        links = np.zeros(len(node), np.int64)
        links[a] += linked @ copies[b]
        if not same:
            links[b] += linked.T @ copies[a]
        told = np.flatnonzero((links > 0) | (label != node))
        return node[told], links[told], label[told]

    def _earlier(filters: pa.Array, now: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs that also share a smaller filter."""
        values, lengths = np.asarray(filters.flatten()), np.diff(np.asarray(filters.offsets))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        small = values < now
        found, column = np.unique(values[small], return_inverse=True)
        held = np.zeros((len(lengths), len(found)), np.float32)
        held[owner[small], column] = 1
        return held[a] @ held[b].T > 0

    return run


def embedding_dedup(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
    per_vector: int | None = None, block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row: links are pairs with cosine >= ``threshold``.

    Vectors that are null, zero, or hold null or non-finite values link with nothing; so do rows with
    a null id (their component is null). Vectors link with those of their own length. Repeated rows are vectors of their own. Other columns are
    ignored; an empty table gives no rows. Found links are exact; the filters find nearly all pairs.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("id").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0)
    sizes = rows.where(usable).groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    counts = {r.dim: r.n for r in sizes.collect()}  # one row for each length
    if not counts:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    usable = F.coalesce(usable, F.lit(False))
    keyed = rows.withColumn("usable", usable).select(
        "id", "vector", F.when(F.col("usable"), F.xxhash64("vector")).alias("h1"),
        F.when(F.col("usable"), F.xxhash64(F.lit(1), "vector")).alias("h2"),
    )
    nodes = stored(
        keyed.where("h1 is not null").groupBy("h1", "h2").agg(
            F.min("id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector")
        ),
        "vectors",
    )
    kind = nodes.schema["vector"].dataType.simpleString()
    schema = f"dim int, filter long, node long, copies long, vector {kind}, filters array<long>"
    # an id with two vectors would be two nodes of one name: number nodes by hash, name them at the end
    held = stored(nodes.select("h1", "copies", "vector").mapInArrow(_decode_pass(counts, per_vector), schema), "filters")
    shared = held.groupBy("dim", "filter").agg(F.count("*").alias("held")).where("held > 1")
    sized = held.join(shared, ["dim", "filter"]).withColumn("blocks", F.ceil(F.col("held") / block).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = sized.withColumn("block", own).select("*", F.explode(others).alias("other")).select(
        "dim", "filter", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        "block", "node", "copies", "vector", "filters",
    )
    key = ["dim", "filter", "left", "right"]
    solved = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _compare_pass(threshold), "node long, links long, label long"
    )
    solved = stored(solved, "links")
    links = solved.groupBy("node").agg(F.sum("links").alias("links"))
    reached = connected_components(solved.select(F.col("node").alias("a"), F.col("label").alias("b")))
    named = nodes.select(F.col("h1").alias("node"), "h2", F.col("node").alias("id"), "copies")
    labelled = named.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    told = labelled.join(smallest, "component").join(links, "node", "left").select(
        F.col("node").alias("h1"), "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    done = keyed.join(told, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    return done.select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
