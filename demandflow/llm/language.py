"""Language ID: unigram pieces per language, summed over every segmentation of a word.

The pieces are all those of a fixed public vocabulary that are letters (in lower case), plus all single bytes, so every word has a segmentation. A language is a probability per
piece, learned by expectation maximisation. A forward pass adds up the probability of all ways to
cut a word into pieces; a text's score is the sum over its words. Words are bytes and are scored once
per distinct word of a batch, all words of a length at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import BYTE_VALUES, _bytes, powers, prefix_hash, splitmix

MOST_BYTES = 25  # the longest piece of letters there is
MARK = 32  # a word starts with a space, as in the vocabulary
LONGEST = 48  # longer words go on as another word without a mark
SAMPLE = 400
ROUNDS = 4
UNKNOWN = "und"
CHUNK = 1 << 20  # bytes scored at a time; the arrays take some fifty times as much
PORTION = 1 << 17  # bytes of the sample counted at a time on the driver
ROWS = 1000
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def vocabulary(model_path: str) -> list[bytes]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    texts = (model.id_to_piece(k) for k in range(model.vocab_size()) if not (model.is_byte(k) or model.is_control(k)))
    pieces = {t.replace("▁", " ").lower() for t in texts}
    known = {p.encode() for p in pieces if p.strip().isalpha() and " " not in p[1:]}
    return sorted({p for p in known if len(p) <= MOST_BYTES} | {bytes([b]) for b in range(256)})


class PieceTable:
    """Piece numbers by hash of their bytes; -1 where there is no such piece."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        hashes = np.array([_hash(p) for p in pieces], np.uint64)
        self.slots = np.full(1 << 18, -1, np.int32)
        self.keys = np.zeros(1 << 18, np.uint64)
        for number, h in enumerate(hashes):
            at = int(h) & (len(self.slots) - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (len(self.slots) - 1)
            self.slots[at], self.keys[at] = number, h
        runs = np.flatnonzero(np.r_[self.slots, -1] < 0)
        self.probes = int(np.diff(np.r_[-1, runs]).max())

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(len(self.slots) - 1)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int32)
        open_ = np.arange(len(hashes))
        for _ in range(self.probes):
            slots = self.slots[at]
            hit = (slots >= 0) & (self.keys[at] == hashes[open_])
            out[open_[hit]] = slots[hit]
            go_on = (slots >= 0) & ~hit
            if not go_on.any():
                break
            open_, at = open_[go_on], (at[go_on] + 1) & (len(self.slots) - 1)
        return out


def _hash(piece: bytes) -> int:
    data = np.frombuffer(piece, np.uint8)
    return int(splitmix(prefix_hash(BYTE_VALUES[data])[-1:] + np.uint64(len(piece)))[0])


def distinct_words(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(distinct words as byte matrices, one per length; number of the text and of the word of each
    word met). Words are numbered through the matrices."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = LETTER[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    marked = np.ones(len(starts), bool)
    while len(starts) and (ends - starts).max() > LONGEST:
        long_ = np.flatnonzero(ends - starts > LONGEST)
        cut = starts[long_] + LONGEST
        starts, ends, marked = np.r_[starts, cut], np.r_[ends, ends[long_]], np.r_[marked, np.zeros(len(cut), bool)]
        ends[long_] = cut
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    low = LOWER[data]
    c = prefix_hash(BYTE_VALUES[low])
    h = (c[ends] - c[starts]) * powers(len(data) + 1)[1][starts]
    key = splitmix(h + (ends - starts).astype(np.uint64) * np.uint64(2) + marked)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    length = ends[first] - starts[first]
    by_length = np.argsort(length, kind="stable")
    rank = np.empty(len(first), np.int64)
    rank[by_length] = np.arange(len(first))
    matrices = []
    for n in np.unique(length):
        rows = first[by_length[length[by_length] == n]]
        letters = low[starts[rows][:, None] + np.arange(n)]
        mark = np.where(marked[rows], MARK, 0).astype(np.uint8)[:, None]
        matrices.append(np.concatenate([mark, letters], axis=1))
    return matrices, owner, rank[inverse]


def piece_numbers(table: PieceTable, words: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, rows, piece numbers) of all pieces in words of one length. A zero at the start
    stands for no mark and is no byte of the word."""
    out, n = [], words.shape[1]
    values = BYTE_VALUES[words]
    power = powers(MOST_BYTES)[0]
    for start in range(n):
        h = np.zeros(len(words), np.uint64)
        for size in range(1, min(MOST_BYTES, n - start) + 1):
            h = h + values[:, start + size - 1] * power[size - 1]
            numbers = table.find(splitmix(h + np.uint64(size)))
            rows = np.flatnonzero(numbers >= 0)
            if len(rows):
                out.append((start, start + size, rows, numbers[rows]))
    return out


def forward(words: np.ndarray, pieces: list, chances: np.ndarray) -> np.ndarray:
    """alpha[word, position, language]: chance of all segmentations of the first bytes."""
    alpha = np.zeros((words.shape[1] + 1, len(words), chances.shape[1]))
    alpha[0] = 1.0
    alpha[1] = np.where(words[:, :1] == 0, 1.0, 0.0)
    for start, end, rows, numbers in sorted(pieces, key=lambda p: p[0]):
        if start or end > 1:
            alpha[end, rows] += alpha[start, rows] * chances[numbers]
        else:
            keep = words[rows, 0] != 0
            alpha[1, rows[keep]] += chances[numbers[keep]]
    return alpha


def expected_counts(words: np.ndarray, pieces: list, chances: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, by language; weights[word, language] counts the words."""
    alpha = forward(words, pieces, chances)
    beta = np.zeros_like(alpha)
    beta[-1] = 1.0
    counts = np.zeros_like(chances)
    scale = weights / np.maximum(alpha[-1], 1e-300)
    for start, end, rows, numbers in sorted(pieces, key=lambda p: -p[1]):
        use = chances[numbers] * beta[end, rows]
        beta[start, rows] += use
        for k in range(chances.shape[1]):
            counts[:, k] += np.bincount(numbers, alpha[start, rows, k] * use[:, k] * scale[rows, k], len(counts))
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[bytes]
    chances: np.ndarray

    def scorer(self) -> Callable[[list[bytes]], np.ndarray]:
        table = PieceTable(self.pieces)

        def score(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            """Log chances (text, language) and words per text."""
            matrices, owner, word = distinct_words(texts)
            logs = [np.log(np.maximum(forward(m, piece_numbers(table, m), self.chances)[-1], 1e-300)) for m in matrices]
            flat = np.concatenate(logs) if logs else np.zeros((0, len(self.languages)))
            total = np.stack(
                [np.bincount(owner, flat[word, k], len(texts)) for k in range(len(self.languages))], axis=1
            ) if len(owner) else np.zeros((len(texts), len(self.languages)))
            return total, np.bincount(owner, minlength=len(texts))

        return score


def portions(texts: list[bytes], size: int = PORTION) -> Iterator[list[bytes]]:
    """Texts in portions of about ``size`` bytes; longer ones are cut before a byte that is no letter, so no
    word is cut."""
    some = re.compile(rb"(?s).{1,%d}(?=[^A-Za-z\x80-\xff]|\Z)|.+?(?=[^A-Za-z\x80-\xff]|\Z)" % size)
    held, n = [], 0
    for part in (part for text in texts for part in (some.findall(text) if len(text) > size else [text])):
        if held and n + len(part) > size:
            yield held
            held, n = [], 0
        held.append(part)
        n += len(part)
    if held:
        yield held


def word_weights(texts: list[list[bytes]]) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct words as byte matrices, one per length; weights[word, language]) of each language's texts.
    Texts are read in portions: the arrays take some fifty times the bytes read at a time."""
    number: dict[bytes, int] = {}
    met = []
    for k, own in enumerate(texts):
        for portion in portions(own):
            matrices, _, word = distinct_words(portion)
            numbers = np.array([number.setdefault(w.tobytes(), len(number)) for m in matrices for w in m], np.int64)
            met.append((numbers, k, np.bincount(word, minlength=len(numbers))))
    words = sorted(number, key=lambda w: (len(w), w))
    rank = np.empty(len(words), np.int64)
    rank[[number[w] for w in words]] = np.arange(len(words))
    weights = np.zeros((len(words), max(1, len(texts))))
    for numbers, k, counts in met:
        weights[rank[numbers], k] += counts
    matrices = [np.frombuffer(b"".join(group), np.uint8).reshape(-1, n) for n, group in groupby(words, len)]
    return matrices, weights


def train(texts: dict[str, list[bytes]], pieces: list[bytes], rounds: int = ROUNDS) -> LanguageModel:
    """Expectation maximisation over the words of labelled texts."""
    languages = sorted(texts)
    table = PieceTable(pieces)
    matrices, weights = word_weights([texts[name] for name in languages])
    total = len(weights)
    found = [piece_numbers(table, m) for m in matrices]
    chances = np.full((len(pieces), max(1, len(languages))), 1.0 / len(pieces))
    for _ in range(rounds if total else 0):
        counts, at = np.zeros_like(chances), 0
        for m, p in zip(matrices, found):
            counts += expected_counts(m, p, chances, weights[at : at + len(m)])
            at += len(m)
        chances = (counts + 0.01) / (counts + 0.01).sum(axis=0)
    return LanguageModel(languages, pieces, chances)


def fit(
    docs: DataFrame, learn: Column, model_path: str | None = None, per_language: int = SAMPLE, rounds: int = ROUNDS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> LanguageModel:
    """Model from at most ``per_language`` documents of each language, those with the smallest hash of
    their id among rows where ``learn`` holds. Rows without id, text or language teach nothing."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.where(learn).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).dropna()
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id", F.lit(5)), "id")
    chosen = rows.select("id", "lang").withColumn("at", F.row_number().over(by_hash)).where(F.col("at") <= per_language)
    # at most per_language rows for each language
    sample = rows.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"], "left_semi")
    texts: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "id", "text").collect():
        texts.setdefault(row.lang, []).append(row.text.encode())
    return train(texts, vocabulary(model_path), rounds)


def _identify_pass(model: LanguageModel) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield _scored(score, batch.slice(at, ROWS))

    def _scored(score: Callable, batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores, held, size = [], [], [], 0
        for text in batch.column(1):
            held.append(_bytes(text))
            size += len(held[-1])
            if size > CHUNK:
                _decide(score, held, langs, scores)
                held, size = [], 0
        _decide(score, held, langs, scores)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"]
        )

    def _decide(score: Callable, texts: list[bytes], langs: list, scores: list) -> None:
        if not texts:
            return
        total, words = score(texts)
        # words of a text are far from independent: at most 20 of them count in full
        damped = total * np.minimum(1.0, 20.0 / np.maximum(words, 1))[:, None]
        for text, t, n in zip(texts, damped, words):
            if not n or not model.languages or not any(map(str.isalpha, text.decode())):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(t.argmax())
            langs.append(model.languages[best])
            scores.append(float(1.0 / np.exp(t - t[best]).sum()))

    return run


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``language`` (lang_pred, score), one pass without a shuffle.

    lang_pred is a learned language and score its share among all of them; null texts and texts
    without letters are ``und`` with score 0, and so is all if nothing was learned. Rows pass through
    one by one, so repeated rows and ids do not matter, and texts of any length are scored whole; of
    equally likely languages the first by name is taken. An empty table gives no rows; a column named
    ``language`` is replaced.
    """
    row = F.struct(*[c for c in docs.columns if c != "language"])
    kind = docs.drop("language").schema.simpleString()
    out = docs.select(row.alias("row"), F.col(text_col).alias("text")).mapInArrow(
        _identify_pass(model), f"row {kind}, lang_pred string, score double"
    )
    return out.select("row.*", F.struct("lang_pred", "score").alias("language"))
