"""Exact substring dedup with a sparse suffix array.

Sorting the suffixes of every byte would move hundreds of bytes per byte of text. It is enough to
sort suffixes at anchors: in every string of ``LENGTH`` bytes the ``GRAM`` bytes with the smallest
hash (the last of equals) start at an anchor, so equal strings have equal anchors at equal places.

1. Each document gives its anchors: hash of the ``GRAM`` bytes and hash of the context, which is all
   that any string of ``LENGTH`` bytes around this anchor can hold. Equal contexts settle each other.
2. Anchors whose gram occurs again but whose context stands alone are contested. Their suffixes are
   range partitioned by leading bytes with sampled splitters; each bucket is sorted by multikey
   quicksort, forwards and backwards, and the depths shared with neighbours tell which strings occur
   twice. Rows count once per context, and no pair is ever made.
3. Suffixes of the first and the last gram of a bucket may have partners across the boundary. They
   are bucketed again by the bytes before the anchor. What a row shares with the rows next to its two
   buckets bounds what any partner elsewhere can share; the few offsets left are compared by hashes
   of ever shorter ranges of strings, so a gram that fills many buckets is no hot task.
4. What an anchor covers goes back to the documents that hold it, which drop those bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import BYTE_VALUES, _bytes, powers, prefix_hash, splitmix, stored, unpacker

LENGTH = 200
GRAM = 40
SEGMENT = 1 << 22
STEPS = (80, 20, 1)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes); memory is bounded by ``SEGMENT`` bytes of text."""
    data, found, hashes = np.frombuffer(text, np.uint8), [], []
    for start in range(0, len(data) - length + 1, SEGMENT):
        at, h = _segment_anchors(data[start : start + SEGMENT + length - 1], length, gram)
        found.append(at + start)
        hashes.append(h)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    positions, first = np.unique(np.concatenate(found), return_index=True)
    return positions, np.concatenate(hashes)[first]


def _segment_anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    n, wide = len(data) - gram + 1, length - gram + 1
    c = prefix_hash(BYTE_VALUES[data])
    h = splitmix((c[gram:] - c[:-gram]) * powers(len(data))[1][:n])
    low = np.uint64((1 << 24) - 1)
    key = np.full(-(-n // wide) * wide, ~np.uint64(0))
    key[:n] = (h & ~low) | (low - np.arange(n, dtype=np.uint64))
    blocks = key.reshape(-1, wide)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[: n - wide + 1], head[wide - 1 : n])
    chosen = least[np.r_[True, least[1:] != least[:-1]]]
    at = np.unique((low - (chosen & low)).astype(np.int64))
    return at, h[at].view(np.int64)


def context(text: bytes, at: int, length: int, gram: int) -> tuple[int, int, int]:
    """(hash, first byte, end) of what strings of ``length`` bytes around the anchor can hold."""
    lo, hi = max(0, at - (length - gram)), min(len(text), at + length)
    return xxhash.xxh3_64_intdigest(text[lo:hi], seed=(at - lo) << 20 | (hi - at)) - (1 << 63), lo, hi


def _anchor_pass(length: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, scalar in zip(batch.column(0).to_pylist(), batch.column(1)):
                text, own = _bytes(scalar), {}
                for at, h in zip(*(a.tolist() for a in anchors(text, length, gram))):
                    c = context(text, at, length, gram)[0]
                    if (h, c) in own:
                        own[h, c][1] += 1
                    else:
                        own[h, c] = [at, 1]
                out.extend((h, c, key, at, n) for (h, c), (at, n) in own.items())
            yield _rows(out, ["gram", "context", "key", "at", "n"])

    return run


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _suffix_pass(length: int, gram: int) -> Callable:
    """(gram, context, before, after): the bytes around contested anchors, ``before`` reversed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            out = []
            for z, wanted in zip(batch.column("z"), batch.column("wanted").to_pylist()):
                text = unpack(_bytes(z))
                for w in wanted:
                    c, lo, hi = context(text, w["at"], length, gram)
                    if c == w["context"]:  # else another text under the same id
                        out.append((w["gram"], c, text[lo : w["at"]][::-1], text[w["at"] : hi]))
            columns = list(zip(*out)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["gram", "context", "before", "after"]
            )

    return run


def multikey_sort(words: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of big-endian words: rows are parted by one word at a time, and
    only parts that are still equal are sorted by the next."""
    order = np.argsort(words[:, 0], kind="stable")
    part = np.cumsum(np.r_[False, words[order[1:], 0] != words[order[:-1], 0]])
    for k in range(1, words.shape[1]):
        size = np.bincount(part)
        open_ = np.flatnonzero(size[part] > 1)
        if not len(open_):
            break
        rows = order[open_]
        rows = rows[np.lexsort((words[rows, k], part[open_]))]
        order[open_] = rows
        new = np.zeros(len(order), bool)
        new[1:] = part[1:] != part[:-1]
        differs = words[order[1:], k] != words[order[:-1], k]
        part = np.cumsum(np.r_[False, new[1:] | differs & (part[1:] == part[:-1])])
    return order


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    padded = -(-width // 8) * 8
    data = np.frombuffer(b"".join(s.ljust(padded, b"\0") for s in strings), np.uint8).reshape(-1, padded)
    return data, np.array([len(s) for s in strings])


def _depths(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order, shared depth of each sorted row with the one before it, lengths."""
    data, lengths = _matrix(strings, width)
    order = multikey_sort(data.view(">u8").astype(np.uint64))
    differs = data[order[1:]] != data[order[:-1]]
    depth = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    depth = np.minimum(depth, np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    return order, np.r_[0, depth], lengths


def shared_offsets(before: list[bytes], after: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset o at which the string from o bytes before the anchor, ``length``
    long, equals the same string of another row; (length, -1) where there is none."""
    n = len(before)
    least, most = np.full(n, length), np.full(n, -1)
    forward, ahead, after_len = _depths(after, length)
    backward, behind, before_len = _depths(before, length - gram)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(length - gram + 1):
        rows = np.flatnonzero((before_len >= o) & (after_len >= length - o))
        if len(rows) < 2:
            continue
        right[forward] = np.cumsum(ahead < length - o)
        left[backward] = np.cumsum(behind < o)
        both = right[rows] * (n + 1) + left[rows]
        _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
        twice = rows[counts[inverse] > 1]
        most[twice] = o
        least[twice] = np.minimum(least[twice], o)
    return least, most


def _bucket_pass(length: int, gram: int, most_rows: int) -> Callable:
    """Rows of one range bucket: what neighbours share, and whether partners may lie across its ends."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        bucket = TaskContext.get().partitionId() << 24
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) > most_rows:  # memory stays bounded; the cut counts as a boundary
                yield solve(pd.concat(held, ignore_index=True)).assign(bucket=bucket)
                held, bucket = [], bucket + 1
        if held and sum(map(len, held)):
            yield solve(pd.concat(held, ignore_index=True)).assign(bucket=bucket)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        least, most = shared_offsets(list(rows["before"]), list(rows["after"]), length, gram)
        if "least" in rows:  # the other order has been sorted before
            least, most = np.minimum(least, rows["least"]), np.maximum(most, rows["most"])
        edge = (rows["gram"] == rows["gram"].iloc[0]) | (rows["gram"] == rows["gram"].iloc[-1])
        return rows.assign(least=least, most=most, edge=edge)

    return run


def _lcp(a: bytes, b: bytes | None) -> int:
    if b is None:
        return 0
    n = min(len(a), len(b))
    return n - -(-(int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() // 8)


def _reach(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of grams that go on in another bucket, with the most bytes of ``column`` they share with
    any row outside their own: in sorted order that is a row next to the bucket."""
    ends = rows.groupBy("gram", "bucket").agg(F.min(column).alias("first"), F.max(column).alias("last"))
    order = Window.partitionBy("gram").orderBy("first", "last")
    ends = ends.select("gram", "bucket", F.lag("last").over(order).alias("below"), F.lead("first").over(order).alias("above"))
    ends = ends.where("below is not null or above is not null")

    @F.pandas_udf("int")
    def shared(own: pd.Series, below: pd.Series, above: pd.Series) -> pd.Series:
        return pd.Series([max(_lcp(s, b), _lcp(s, a)) for s, b, a in zip(own, below, above)], dtype="int32")

    return rows.join(ends, ["gram", "bucket"]).withColumn(name, shared(column, "below", "above")).drop("bucket", "edge", "below", "above")


def _range_pass(length: int, step: int) -> Callable:
    """(gram, context, low, high, hash, asks) of ranges of offsets on a fixed grid: hashes of the
    bytes that every string of a range holds.

    Only offsets from ``low`` to ``high`` of the row can have partners elsewhere. Where the row knows
    them already they matter to others only: it does not ask, and one row of each task speaks for all
    that hold the same bytes there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int, int]] = set()
        names = ("gram", "context", "before", "after", "least", "most", "low", "high")
        for batch in batches:
            out = []
            for g, c, before, after, least, most, low, high in zip(*(batch.column(k).to_pylist() for k in names)):
                for o in range(low // step * step, high + 1, step):
                    first, last = max(o, low), min(o + step - 1, high)
                    asks = not least <= first <= last <= most
                    if not asks:
                        holds = before[:last][::-1] + after[: length - first]
                        same = (first, last, xxhash.xxh3_64_intdigest(holds))
                        if same in told:
                            continue
                        if len(told) > 1_000_000:
                            told.clear()
                        told.add(same)
                    held = before[:o][::-1] + after[: max(0, length - o - step + 1)]
                    out.append((g, c, o, xxhash.xxh3_64_intdigest(held, seed=o) - (1 << 63), first, last, int(asks)))
            yield _rows(out, ["gram", "context", "at", "hash", "low", "high", "asks"])

    return run


def _across(edges: DataFrame, length: int, gram: int, bucket_rows: int) -> DataFrame:
    """(gram, context, least, most) of rows at bucket ends.

    The rows are bucketed once more by what stands before the anchor. A partner outside both buckets
    shares no more after the anchor than the first order's neighbours and no more before it than the
    second's, which leaves few offsets; those are compared by ranges that shrink.
    """
    names = ["gram", "context", "before", "after", "least", "most"]
    strings = stored(_reach(edges, "after", "ahead"), "edges")
    parts = max(1, -(-strings.count() // (bucket_rows // 8)))
    order = ["gram", "before", "after"]
    buckets = strings.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kinds = "gram long, context long, before binary, after binary, least long, most long, ahead int, edge boolean, bucket long"
    solved = stored(buckets.mapInPandas(_bucket_pass(length, gram, bucket_rows), kinds), "reversed")
    low = F.greatest(F.lit(0), length - F.col("ahead"), length - F.octet_length("after"))
    high = F.least(F.lit(length - gram), F.col("behind"))
    both = _reach(solved, "before", "behind").select(*names, low.alias("low"), high.alias("high"))
    strings = stored(both.where("low <= high"), "open")
    ranges = strings
    for step in STEPS:
        schema = "gram long, context long, at long, hash long, low long, high long, asks long"
        hashed = stored(ranges.mapInArrow(_range_pass(length, step), schema), "ranges")
        # ranges all of whose rows know the answer go; in the end only rows that ask need one
        twice = hashed.groupBy("gram", "at", "hash").agg(F.count("*").alias("k"), F.max("asks").alias("asked"))
        twice = twice.where("k > 1 and asked = 1")
        open_ = hashed if step > 1 else hashed.where("asks = 1")
        left = open_.join(twice, ["gram", "at", "hash"]).select("gram", "context", "low", "high")
        if step > 1:
            ranges = left.join(strings.drop("low", "high"), ["gram", "context"]).select(*names, "low", "high")
    found = left.groupBy("gram", "context").agg(F.min("low").alias("least"), F.max("low").alias("most"))
    return found.union(solved.where("most >= 0").select("gram", "context", "least", "most"))


def _removal_pass(length: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            out: list[tuple] = []
            ids, covers = batch.column("id").to_pylist(), batch.column("covers").to_pylist()
            for doc_id, z, cover in zip(ids, batch.column("z"), covers):
                text = unpack(_bytes(z))
                spans = _spans(text, {(c["gram"], c["context"]): c for c in cover}, length, gram) if cover else []
                kept, last = hashlib.sha256(), 0
                for lo, hi in spans:
                    kept.update(text[last:lo])
                    last = hi
                kept.update(text[last:])
                out.append((doc_id, len(text), sum(b - a for a, b in spans), spans, kept.hexdigest()))
            columns = list(zip(*out)) or [[]] * 5
            pair = pa.list_(pa.list_(pa.int64()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pair, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([[list(s) for s in v] for v in c] if k == pair else c, k) for c, k in zip(columns, kinds)],
                ["id", "n_bytes", "n_removed", "spans", "kept_sha256"],
            )

    return run


def _spans(text: bytes, covers: dict, length: int, gram: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    found = []
    for at, h in zip(*(a.tolist() for a in anchors(text, length, gram))):
        c, lo, hi = context(text, at, length, gram)
        cover = covers.get((h, c))
        if cover is not None:
            found.append((max(lo, at - cover["back"]), min(hi, at + cover["ahead"])))
    for lo, hi in sorted(found):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 200_000
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept_sha256) per row: bytes covered by a string of ``length``
    bytes that starts anywhere else too. Spans are [first, end) in UTF-8 bytes.

    Null text is empty; texts shorter than ``length`` keep all. Every row is a document of its own,
    so repeated rows remove each other, whatever their ids; ids may be null. Texts may be of any length;
    an empty table gives no rows. Other columns are ignored.
    """
    from demandflow.llm.common import packed_texts

    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("key"), F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
    )
    schema = "gram long, context long, key long, at long, n long"
    found = stored(keyed.select("key", "text").mapInArrow(_anchor_pass(length, gram), schema), "anchors")
    grams = found.groupBy("gram").agg(
        F.sum("n").alias("total"), (F.min("context") != F.max("context")).alias("several")
    ).where("total > 1").select("gram", "several")
    again = stored(found.join(grams, "gram"), "repeated")
    classes = again.groupBy("gram", "context").agg(
        F.sum("n").alias("n"), F.max("several").alias("several"), F.min(F.struct("key", "at")).alias("first")
    )
    classes = stored(classes, "contexts")

    # contested: grams with several contexts, one of which stands alone
    alone = classes.where("several and n = 1").select("gram").distinct()
    wanted = classes.where("several").join(alone, "gram", "left_semi").groupBy(F.col("first.key").alias("id")).agg(
        F.collect_list(F.struct("gram", "context", F.col("first.at").alias("at"))).alias("wanted")
    )
    texts = packed_texts(keyed, "key", "text")
    schema = "gram long, context long, before binary, after binary"
    suffixes = texts.join(wanted, "id").mapInArrow(_suffix_pass(length, gram), schema).dropDuplicates(["gram", "context"])
    suffixes = stored(suffixes, "suffixes")
    parts = max(1, -(-suffixes.count() // (bucket_rows // 8)))
    # also where parts is 1: the stored files are dealt by hash, partners lie in different ones
    buckets = suffixes.repartitionByRange(parts, "after", "before").sortWithinPartitions("after", "before")
    solved = buckets.mapInPandas(_bucket_pass(length, gram, bucket_rows), f"{schema}, least long, most long, edge boolean, bucket long")
    solved = stored(solved, "buckets")
    inside = solved.where("most >= 0").select("gram", "context", "least", "most")
    if solved.agg(F.min("bucket") < F.max("bucket")).first()[0]:
        inside = inside.union(_across(solved.where("edge"), length, gram, bucket_rows))
    inside = inside.groupBy("gram", "context").agg(F.min("least").alias("least"), F.max("most").alias("most"))

    whole = classes.where("n > 1").select("gram", "context", F.lit(length).alias("back"), F.lit(length).alias("ahead"))
    single = classes.where("n = 1").join(inside, ["gram", "context"]).select(
        "gram", "context", F.col("most").alias("back"), (length - F.col("least")).alias("ahead")
    )
    covers = again.select("gram", "context", "key").join(whole.union(single), ["gram", "context"]).groupBy("key").agg(
        F.collect_set(F.struct("gram", "context", "back", "ahead")).alias("covers")
    )
    packed = keyed.select("key", "id", "text").mapInArrow(_pack_rows, "key long, id long, z binary")
    joined = packed.join(covers, "key", "left").select("id", "z", "covers")
    schema = "id long, n_bytes long, n_removed long, spans array<array<long>>, kept_sha256 string"
    return joined.mapInArrow(_removal_pass(length, gram), schema)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        z = pa.array([pack(_bytes(t)) for t in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z], ["key", "id", "z"])
