"""Packing: documents become token pieces, pieces become near-full sequences."""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from demandflow.llm.common import stored

CAPACITY = 2048
END_ID = 1
PIECE = 512
GROUP = 512
PIECES = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, deal bigint"

SPECIAL = "<|endoftext|>"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TokenBytes:
    """Ids of a text as little-endian 32-bit bytes, equal to those of the ``tokenizers`` file.

    The same vocabulary as ranks is several times faster; texts with a special token's string go to
    ``tokenizers``, which gives it its own id. Nothing is kept from text to text.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.whole = json_path, None

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return self._whole(text)
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json_path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_TOKENS: dict[tuple[str, str], TokenBytes] = {}


def token_bytes(json_path: str, ranks_path: str) -> TokenBytes:
    """One encoder per worker process."""
    key = (json_path, ranks_path)
    if key not in _TOKENS:
        _TOKENS[key] = TokenBytes(*key)
    return _TOKENS[key]


def cut(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, then short pieces that fit anywhere."""
    whole = n - n % capacity
    return [(s, capacity) for s in range(0, whole, capacity)] + [(s, min(piece, n - s)) for s in range(whole, n, piece)]


def pieces(
    docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None, end_id: int = END_ID,
    capacity: int = CAPACITY, piece: int = PIECE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Token pieces of every document, with the checksum of their ids; texts are read once."""
    json_path = json_path or public_path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, row = token_bytes(json_path, ranks_path), end_id.to_bytes(4, "little"), 0
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for k, text in enumerate(batch.column(1)):
                tokens = encode(text.as_py() or "") + end
                n = len(tokens) // 4
                row += 1
                for start, length in cut(n, capacity, piece):
                    crc = zlib.crc32(tokens[4 * start : 4 * (start + length)])
                    deal = xxhash.xxh3_64_intdigest(b"%d %d %d" % (ids[k] or 0, start, row)) >> 1
                    out.append((ids[k], start, length, crc, n, deal))
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["id", "start", "length", "ids_crc32", "doc_tokens", "deal"]
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PIECES)


def with_tokens(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``tokens``: what ``pieces`` counts for the text, its end token included."""
    json_path = json_path or public_path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_path("byte_bpe_50k.tiktoken")
    rows = docs.drop("tokens")
    at, names = rows.columns.index(text_col), [*rows.columns, "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(json_path, ranks_path)
        for batch in batches:
            tokens = [len(encode(text.as_py() or "")) // 4 + 1 for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], names)

    return rows.mapInArrow(run, StructType([*rows.schema, StructField("tokens", LongType())]))


def differencing(lengths: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: split items into ``ways`` sets of near-equal sums, as lists of item numbers.

    Every item starts as a partition of its own. The two partitions with the largest spread are
    merged, the fullest set of one with the emptiest of the other, until one is left. A partition
    stores only its non-empty sets, relative to its smallest set.
    """
    heap = [(-length, k, [length], [[k]]) for k, length in enumerate(lengths)]
    heapq.heapify(heap)
    fresh = len(lengths)
    while len(heap) > 1:
        _, _, sums_a, sets_a = heapq.heappop(heap)  # sums from the largest down, empty sets left out
        _, _, sums_b, sets_b = heapq.heappop(heap)
        na, nb = len(sums_a), len(sums_b)
        free = ways - na  # a's zero sets meet b's largest
        if nb <= free:
            merged = [*zip(sums_a, sets_a), *zip(sums_b, sets_b)]
        else:
            over = nb - free  # a's smallest sets meet b's smallest, in opposing order
            merged = [*zip(sums_a[: na - over], sets_a[: na - over]), *zip(sums_b[:free], sets_b[:free])]
            for k in range(over):
                merged.append((sums_a[na - over + k] + sums_b[nb - 1 - k], sets_a[na - over + k] + sets_b[nb - 1 - k]))
        merged.sort(key=lambda x: -x[0])
        base = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (base - merged[0][0], fresh, [m[0] - base for m in merged], [m[1] for m in merged]))
        fresh += 1
    return heap[0][3] if heap else []


def windows(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal sets of pieces, none above ``capacity``: one more set whenever one is too full."""
    full = [[k] for k, n in enumerate(lengths) if n == capacity]
    rest = [k for k, n in enumerate(lengths) if n != capacity]
    ways = -(-sum(lengths[k] for k in rest) // capacity)
    while rest:
        sets = [[rest[i] for i in s] for s in differencing([lengths[k] for k in rest], ways)]
        if max(sum(lengths[k] for k in s) for s in sets) <= capacity:
            return full + sets
        ways += 1
    return full


def pack(
    docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Pieces of all documents with their place: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Texts are tokenised once; only pieces of some 30 bytes are dealt by hash into groups of about
    ``group`` pieces, each packed by itself, so no task grows with the corpus. Padding per group is
    less than one sequence and what differencing leaves.

    Null and empty texts are one end token. Every row is a document of its own, also where ids
    repeat or are null. Texts may be of any length; an empty table gives no rows; other columns are
    ignored.
    """
    cut_up = stored(pieces(docs, capacity=capacity, id_col=id_col, text_col=text_col, **options), "pieces")
    groups = max(1, -(-cut_up.count() // group))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("deal", kind="stable").reset_index(drop=True)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        lengths, first = rows["length"].tolist(), int(rows["bucket"].iloc[0]) << 32
        for number, members in enumerate(windows(lengths, capacity)):
            at = 0
            for k in members:
                sequence[k], offset[k] = first + number, at
                at += lengths[k]
        return rows.assign(sequence_id=sequence, offset=offset).drop(columns=["deal", "bucket"])

    dealt = cut_up.withColumn("bucket", F.col("deal") % F.lit(groups))
    schema = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("bucket").applyInPandas(place, schema)
