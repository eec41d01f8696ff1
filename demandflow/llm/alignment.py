"""Alignment of two tokenizers: which tokens of one cover the text of which tokens of the other."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import stored
from demandflow.llm.packing import public_path

# Texts are aligned in runs of about so many characters; a longer text is cut where both tokenizers cut.
SEGMENT = 1 << 18
# Number of id pairs whose counts every task gets; counts of all others are joined.
FREQUENT = 100_000
# An id pair is a * B_SIZE + b, below 2**31.
B_SIZE = 1 << 15
# Links of a group are listed one by one up to this size, beyond it by distinct ids.
SMALL_GROUP = 64
BLOCK = 1 << 20


class Aligner:
    """Tokenizers of one worker with the byte lengths and decimal strings of their ids."""

    def __init__(self, ranks_path: str, model_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_bytes = [token for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.b_bytes = [self._piece_bytes(k) for k in range(self.b.get_piece_size())]
        self.a_length = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], np.int64)
        # "id," inside a group, "id|" after its last token of A, "id;" after that of B
        na, nb = len(self.a_bytes), len(self.b_bytes)
        self.written = [b"%d%s" % (k, end) for n, end in ((na, b","), (na, b"|"), (nb, b","), (nb, b";")) for k in range(n)]
        self.at_b = 2 * na

    def _piece_bytes(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("\u2581", " ").encode()

    def encode(self, spaced: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for a space and a text, or None where one does not give the bytes back."""
        raw, b = spaced.encode(), self.b.encode(spaced[1:])
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a = self.a.encode_to_numpy(spaced, disallowed_special=())
        return (a, np.array(b, np.int64)) if self.a_length[a].sum() == len(raw) else None


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(*paths: str) -> Aligner:
    """One per worker process."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


SAFE = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Space and text, cut before single spaces between other characters: both tokenizers cut there."""
    spaced, start = " " + text, 0
    while len(spaced) - start > size:
        cut = SAFE.search(spaced, start + size)
        if cut is None:
            break
        yield spaced[start : cut.start()]
        start = cut.start()
    yield spaced[start:]


def covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """For each token start of ``left`` the token of ``right`` that covers it, in the same document."""
    return pd.merge_asof(left, right, on="start", by="part")["token"].to_numpy()


def overlaps(a_part, a_start, b_part, b_start) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping token pairs (places in A, places in B): of two tokens that overlap, one starts in the other."""
    a = pd.DataFrame({"part": a_part, "start": a_start})
    b = pd.DataFrame({"part": b_part, "start": b_start})
    n, m = np.arange(len(a)), np.arange(len(b))
    of_a, of_b = covering(a, b.assign(token=m)), covering(b, a.assign(token=n))
    keys = np.concatenate([n * len(m) + of_a, of_b * len(m) + m])
    keys.sort(kind="stable")  # two sorted halves
    return np.divmod(keys[np.diff(keys, prepend=-1) > 0], len(m))


def groups_of(a_start, a_end, a_part, b_start, b_end, b_part) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group each token is in: a group closes where an overlapping pair ends together."""
    in_a, in_b = overlaps(a_part, a_start, b_part, b_start)
    closes = a_end[in_a] == b_end[in_b]
    return np.searchsorted(in_a[closes], np.arange(len(a_start))), np.searchsorted(in_b[closes], np.arange(len(b_start)))


def links_of(a, b, a_group, b_group, part_of_group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, id pair, number of links), distinct within a part."""
    count = len(part_of_group)
    na, nb = np.bincount(a_group, minlength=count), np.bincount(b_group, minlength=count)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    small = na * nb <= SMALL_GROUP
    rows = np.flatnonzero(small[a_group])
    times = nb[a_group[rows]]
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    left = np.repeat(rows, times)
    group = a_group[left]
    pair = a[left].astype(np.int64) * B_SIZE + b[first_b[group] + at]
    found = [_distinct(part_of_group[group], pair, np.ones(len(pair), np.int64))]
    for g in np.flatnonzero(~small):
        ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + na[g]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + nb[g]], return_counts=True)
        step = max(1, BLOCK // len(ids_b))
        for k in range(0, len(ids_a), step):
            pair = np.add.outer(ids_a[k : k + step].astype(np.int64) * B_SIZE, ids_b).ravel()
            weight = np.multiply.outer(times_a[k : k + step], times_b).ravel()
            found.append((np.full(len(pair), part_of_group[g], np.int64), pair, weight))
    return found[0] if len(found) == 1 else _distinct(*map(np.concatenate, zip(*found)))


def _distinct(part, pair, weight) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = part.astype(np.int64) << 31 | pair
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(weight[order], new) if len(new) else np.zeros(0, np.int64)
    return keys[new] >> 31, keys[new] & (2**31 - 1), sums


class Document:
    """What has been found of one document, over one or more segments."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.sha, self.pairs = hashlib.sha256(), []

    def add(self, n_a: int, n_b: int, n_groups: int, written: bytes, pair, weight) -> None:
        self.sha.update(b";" * (self.n_a > 0) + written)
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + n_groups
        self.n_links += int(weight.sum())
        if len(self.pairs) > 15:
            self.pairs = [self.merged()]
        self.pairs.append((pair, weight))

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0]
        pair, weight = map(np.concatenate, zip(*self.pairs))
        return _distinct(np.zeros(len(pair), np.int64), pair, weight)[1:]

    def row(self) -> tuple:
        if not self.n_a:
            return 0, 0, 0, 0, "", b"", b""
        pair, weight = self.merged()
        steps = np.diff(pair, prepend=0).astype("<u4").tobytes()
        return self.n_a, self.n_b, self.n_groups, self.n_links, self.sha.hexdigest(), _PACK(steps), _PACK(weight.astype("<u4").tobytes())


def _PACK(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _pairs(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4").astype(np.int64))


def _weights(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4").astype(np.int64)


def align(tools: Aligner, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
    """For each part, a document or a segment of one: n_a, n_b, n_groups, written groups, pairs, weights."""
    sizes_a, sizes_b = [len(a) for a, _ in parts], [len(b) for _, b in parts]
    a, b = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
    a_part, b_part = np.repeat(np.arange(len(parts)), sizes_a), np.repeat(np.arange(len(parts)), sizes_b)
    # both sides spell the same bytes, so places run on from part to part alike
    a_end, b_end = np.cumsum(tools.a_length[a]), np.cumsum(tools.b_length[b])
    a_group, b_group = groups_of(a_end - tools.a_length[a], a_end, a_part, b_end - tools.b_length[b], b_end, b_part)
    count = int(a_group[-1]) + 1
    per_a, per_b = np.bincount(a_group, minlength=count), np.bincount(b_group, minlength=count)
    part_of_group = a_part[np.cumsum(per_a) - 1]
    # a group's ids are written one after the other, those of A first
    last_a, last_b = np.diff(a_group, append=count) > 0, np.diff(b_group, append=count) > 0
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + (np.cumsum(per_b) - per_b)[a_group]] = a + last_a * len(tools.a_bytes)
    codes[np.arange(len(b)) + np.cumsum(per_a)[b_group]] = b + tools.at_b + last_b * len(tools.b_bytes)
    part, pair, weight = links_of(a, b, a_group, b_group, part_of_group)
    written, at, spell = codes.tolist(), 0, tools.written.__getitem__
    bounds, groups = np.searchsorted(part, np.arange(len(parts) + 1)), np.bincount(part_of_group, minlength=len(parts))
    for k, (n_a, n_b) in enumerate(zip(sizes_a, sizes_b)):
        text = b"".join(map(spell, written[at : at + n_a + n_b]))[:-1]
        at += n_a + n_b
        yield n_a, n_b, int(groups[k]), text, pair[bounds[k] : bounds[k + 1]], weight[bounds[k] : bounds[k + 1]]


ALIGNED = "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, weights binary"


def aligned(
    docs: DataFrame, ranks_path: str | None = None, model_path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", segment: int = SEGMENT,
) -> DataFrame:
    """One pass over the texts: counts, digest and the document's distinct id pairs with their links, packed."""
    paths = ranks_path or public_path("byte_bpe_50k.tiktoken"), model_path or public_path("piece_bpe_32k.model")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, waiting, held, done = aligner(*paths), [], 0, []

        def work() -> None:
            for (document, _), part in zip(waiting, align(tools, [ids for _, ids in waiting])):
                document.add(*part)
            waiting.clear()

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text, document = text.as_py(), Document()
                done.append((key.as_py(), document))
                for piece in _encoded(tools, text, segment) if text else ():
                    waiting.append((document, piece))
                    held += 4 * len(piece[0])
                    if held >= segment:
                        work()
                        held = 0
                if held == 0 and len(done) > 1 or len(done) >= 5000:
                    if waiting:
                        work()
                        held = 0
                    yield _aligned_batch(done)
                    done = []
        if waiting:
            work()
        if done:
            yield _aligned_batch(done)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(rows, ALIGNED)


def _encoded(tools: Aligner, text: str, size: int) -> list:
    """Ids of all segments of a text; none if one of them does not give its bytes back."""
    out = []
    for piece in segments(text, size):
        ids = tools.encode(piece)
        if ids is None:
            return []
        out.append(ids)
    return out


def _aligned_batch(done: list) -> pa.RecordBatch:
    columns = zip(*[(key, *document.row()) for key, document in done])
    types = [*[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary()]
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "weights"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents an id pair is linked, and whether no pair of its A id has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for packed in batch.column(0):
                held.append(_pairs(packed.as_py()).astype(np.int32))
                size += len(held[-1])
                if size > 4 * BLOCK:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    some = documents.where("n_a > 0").select("pairs").mapInArrow(partial, "pair int, n bigint")
    counts = stored(some.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.shiftright("pair", 15).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


RATED = "row bigint, sum_n bigint, sum_best bigint, rest array<int>, rest_links array<bigint>"


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, **options) -> DataFrame:
    """Alignment of every text under a byte-level BPE (A) and a sentencepiece BPE (B): id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256.

    Byte offsets where both sides end a token cut them into groups; all A-B pairs of a group are links.
    A link's count is the number of documents that link its two ids; ``count_sum`` adds them over the
    links, ``n_best`` counts links no other link of the same A id has more documents than.

    Texts are tokenised once, in runs of ``segment`` characters, so memory does not follow the length
    of a text. What is kept of a document are its distinct id pairs. The ``frequent`` commonest pairs
    (a fixed number) go to every task, the rarer ones are joined by id pair.

    Null and empty texts, and texts whose bytes a side does not give back, have no tokens: zeros and an
    empty digest. Every row is a document of its own, also where ids repeat or are null; an empty table
    gives no rows; other columns are ignored.
    """
    documents = stored(
        aligned(docs, id_col=id_col, text_col=text_col, **options).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    counts = stored(pair_counts(documents), "pairs")
    common = counts.orderBy(F.desc("n"), "pair").limit(frequent).toPandas().sort_values("pair")
    pairs, ns, best = (common[c].to_numpy() for c in ("pair", "n", "best"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, packed, links in zip(*(c.to_pylist() for c in batch.columns)):
                pair, weight = _pairs(packed), _weights(links)
                at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                known = pairs[at] == pair
                hit, times = at[known], weight[known]
                out.append((row, int((ns[hit] * times).sum()), int(times[best[hit]].sum()), pair[~known], weight[~known]))
            if out:
                columns = list(zip(*out))
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "sum_n", "sum_best", "rest", "rest_links"]
                )

    with_tokens = documents.where("n_a > 0").select("row", "pairs", "weights")
    rated = stored(with_tokens.mapInArrow(rate, RATED), "rated")
    rare = rated.select("row", F.explode(F.arrays_zip("rest", "rest_links")).alias("of"))
    rare = rare.select("row", F.col("of.rest").alias("pair"), F.col("of.rest_links").alias("links")).join(counts, "pair")
    summed = rare.select("row", (F.col("n") * F.col("links")).alias("sum_n"), F.when(F.col("best"), F.col("links")).otherwise(0).alias("sum_best"))
    totals = rated.select("row", "sum_n", "sum_best").union(summed).groupBy("row").agg(
        F.sum("sum_n").alias("count_sum"), F.sum("sum_best").alias("n_best")
    )
    shown = documents.select("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(totals, "row", "left")
    return shown.select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
