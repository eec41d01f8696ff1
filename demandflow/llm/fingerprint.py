"""Document fingerprints: a digest of quartile buckets with a bounded difference score.

Every window of five bytes gives byte triplets; each triplet is hashed into one of 128 buckets. The
digest holds, per bucket, which quarter of the bucket counts it lies in, the text's length on a log
scale, and the ratio of the quartiles. Two digests differ by the distance of their quarters (two
steps weigh more than twice one) and of the header; the sum is bounded, so likeness is a number
from 0 to 1.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import _bytes, splitmix, unpacker

BUCKETS = 128
# Pairs of places in a window that join its first byte to a triplet, each with a salt of its own.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (3, 4))
CHUNK = 1 << 20
SALTS = splitmix(np.arange(1, 3 * len(TRIPLETS) * 256 + 1, dtype=np.uint64)).astype(np.uint32).reshape(len(TRIPLETS), 3, 256)
COSTS = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])
WORST = 6 * BUCKETS
MOST_RANGES = 100_000


def counts_of(text: bytes) -> np.ndarray:
    data, total = np.frombuffer(text, np.uint8), np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data) - 4, CHUNK):
        part = data[start : start + CHUNK + 4]
        n = len(part) - 4
        for (i, j), (a, b, c) in zip(TRIPLETS, SALTS):
            mixed = (a[part[:n]] ^ b[part[i : i + n]] ^ c[part[j : j + n]]) >> np.uint32(25)
            total += np.bincount(mixed, minlength=BUCKETS)
    return total


def fingerprint(text: bytes) -> str:
    """Hex: log length, two quartile ratios, then two bits per bucket. Texts under five bytes, which
    have no triplets, are hashed whole."""
    counts = counts_of(text)
    if len(text) < 5:
        quarters = np.unpackbits(np.frombuffer(hashlib.sha256(text).digest(), np.uint8)).reshape(-1, 2)[:BUCKETS] @ [2, 1]
        q1 = q2 = 0
    else:
        order = np.sort(counts)
        low, mid, high = (int(order[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
        quarters = (counts > low).astype(int) + (counts > mid) + (counts > high)
        q1, q2 = (100 * low // high % 256, 100 * mid // high % 256) if high else (0, 0)
    length = min(0xFFFF, round(64 * math.log2(len(text) + 1)))
    bits = np.packbits(((quarters[:, None] >> np.array([1, 0])) & 1).astype(np.uint8)).tobytes()
    return f"{length:04x}{q1:02x}{q2:02x}{bits.hex()}"


def _parsed(digest: str) -> tuple[int, int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(digest[8:]), np.uint8)
    return int(digest[:4], 16), int(digest[4:6], 16), int(digest[6:8], 16), np.unpackbits(raw).reshape(-1, 2) @ [2, 1]


def likeness(one: str, other: str) -> float:
    """1 for equal digests, 0 for those that differ in everything; symmetric."""
    (na, pa_, qa, a), (nb, pb, qb, b) = _parsed(one), _parsed(other)
    header = min(abs(na - nb), 256) + min(abs(pa_ - pb), 64) + min(abs(qa - qb), 64)
    return 1.0 - (int(COSTS[a, b].sum()) + header) / (WORST + 384)


def _neighbour_pass() -> Callable:
    """Rows of one range of ids in order: each with its digest and those of its edited text."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, unpack = None, unpacker()
        for frame in frames:
            out = []
            for doc_id, z, guest in zip(frame["id"], frame["z"], frame["guest"]):
                text = unpack(z).decode()
                mark = fingerprint(text.encode())
                if held is not None:
                    out.append(solve(*held, text, mark))
                held = None if guest else (doc_id, text, mark)
            yield pd.DataFrame(out, columns=names).astype({"id": "Int64"})

    def solve(doc_id, text: str, mark: str, after: str, after_mark: str) -> tuple:
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        edited_mark = fingerprint(edited)
        return (
            doc_id, len(text), hashlib.sha256(edited).hexdigest(), mark, edited_mark,
            likeness(mark, edited_mark), likeness(mark, after_mark),
        )

    return run


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = 4000
) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text replaces the last half of a document by the start of the next one in the order of
    ids (after the last: the first). Ids are cut into ranges at sampled splitters; every range gets
    the first document of the next one as a guest, so texts are shuffled once, compressed, and no
    task sees more than its range. Null ids come first; rows with equal ids follow in the order of
    a hash of their texts; null texts are empty; a table of one row is its own neighbour, an
    empty one gives no rows. Texts may be of any length. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = min(MOST_RANGES, max(1, -(-rows.count() // range_rows)))
    steps = [k / parts for k in range(1, parts)]
    cuts = np.unique(np.array(rows.approxQuantile("id", steps, 0.2 / parts) if steps else [], np.float64))
    # one number per range: the smallest id in it
    place = rows.select("id").mapInArrow(_place_pass(cuts), "id long, bucket long")
    firsts = {r.bucket: (r.nulls, r.least) for r in place.groupBy("bucket").agg(
        F.count(F.when(F.col("id").isNull(), 1)).alias("nulls"), F.min("id").alias("least")
    ).collect()}
    dealt = rows.select("id", "text", F.xxhash64("text").alias("tie")).mapInArrow(
        _deal_pass(cuts, firsts), "bucket long, guest boolean, id long, tie long, z binary"
    )
    ordered = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", F.asc_nulls_first("id"), "tie")
    return ordered.select("id", "guest", "z").mapInPandas(
        _neighbour_pass(),
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _buckets(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Number of the range of each id; nulls are in the first."""
    known = np.asarray(ids.fill_null(np.iinfo(np.int64).min))
    return np.searchsorted(cuts, known.astype(np.float64), side="right")


def _place_pass(cuts: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(_buckets(ids, cuts))], ["id", "bucket"])

    return run


def _deal_pass(cuts: np.ndarray, firsts: dict[int, tuple]) -> Callable:
    """Every row to its range, and the first rows of a range to the one before it as guests."""
    filled = sorted(firsts)
    before = {bucket: filled[k - 1] for k, bucket in enumerate(filled)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out = []
            ids, ties = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for doc_id, text, tie, bucket in zip(ids, batch.column(1), ties, _buckets(batch.column(0), cuts).tolist()):
                z = pack(_bytes(text))
                out.append((bucket, False, doc_id, tie, z))
                nulls, least = firsts[bucket]
                if doc_id is None if nulls else doc_id == least:
                    out.append((before[bucket], True, doc_id, tie, z))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "guest", "id", "tie", "z"]
            )

    return run
