"""Toxicity: a linear-chain conditional random field tags toxic words, its marginals score texts.

Tags are 0 and 1. A word's features are itself and its first four, five and six letters; only
features that lean to toxic documents have a weight, all other words share one bias. Tokens are
labelled from the labelled documents: a word of a toxic document is toxic if one of its features is
met nearly only in toxic ones. Training maximises the likelihood of tags on short stretches around
such words and on stretches of clean text.

Between words with features the chain only mixes, so forward-backward steps over each gap with a
power of one matrix: marginals are those of the whole chain, at the cost of the few words that matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import splitmix
from demandflow.llm.shingles import shingle_set

WORD = re.compile(r"[^\W_]+")
PREFIXES = (4, 5, 6)
SAMPLE = 1500
FEATURES = 2000
SUPPORT = 0.01
STRETCH = 5
GAPS = 2048
CACHE = 300_000
COPY_SEEDS = (1, 2, 3)
COPY = 0.8
PER_TEXT = 12


def features(word: str) -> list[str]:
    return ["=" + word, *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


@dataclass
class ToxicityModel:
    """Log weights: per feature and bias for tag 1, transitions[from, to]; scale and shift calibrate."""

    weights: dict[str, float]
    bias: float
    transitions: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def tagger(self) -> Callable[[str], list[tuple[int, int, float]]]:
        step = np.exp(self.transitions)
        neutral = step * np.array([1.0, np.exp(self.bias)])
        gaps = [np.eye(2)]
        for _ in range(GAPS):  # beyond, the chain has forgotten where it came from
            nxt = gaps[-1] @ neutral
            gaps.append(nxt / nxt.sum())
        known: dict[str, float] = {}

        def tag(text: str) -> list[tuple[int, int, float]]:
            """(start, end, chance of tag 1) of the words with features."""
            if len(known) > CACHE:
                known.clear()
            low = text.lower()
            words = WORD.findall(low)
            held = list(map(known.get, words))
            if None in held:
                for k, w in enumerate(held):
                    if w is None:
                        held[k] = known[words[k]] = sum(self.weights.get(f, 0.0) for f in features(words[k]))
            if not any(held):
                return []
            # places are those of the text itself, where lower case has as many characters
            places = WORD.finditer(low if len(low) == len(text) else text)
            found = [(k, m.start(), m.end(), w) for k, (m, w) in enumerate(zip(places, held)) if w]
            count = len(words)
            if not found:
                return []
            return [(a, b, p) for (_, a, b, _), p in zip(found, marginals([f[0] for f in found], [f[3] for f in found], count))]

        def marginals(at: list[int], weights: list[float], count: int) -> list[float]:
            here = [np.array([1.0, np.exp(min(50.0, self.bias + w))]) for w in weights]
            ahead, last, vector = [], -1, None
            for k, emission in zip(at, here):
                if vector is None:  # the first word of a text has no transition into it
                    vector = np.ones(2) if k == 0 else (np.array([1.0, np.exp(self.bias)]) @ gaps[min(k - 1, GAPS)]) @ step
                else:
                    vector = (vector @ gaps[min(k - last - 1, GAPS)]) @ step
                vector = vector * emission
                vector = vector / vector.sum()
                ahead.append(vector)
                last = k
            out, back = [], gaps[min(count - 1 - last, GAPS)].sum(axis=1)
            for i in range(len(at) - 1, -1, -1):
                both = ahead[i] * back
                out.append(float(both[1] / both.sum()))
                if i:
                    back = gaps[min(at[i] - at[i - 1] - 1, GAPS)] @ (step @ (here[i] * back))
                    back = back / back.sum()
            return out[::-1]

        return tag

    def score(self, chances: list[float]) -> float:
        """Chance that a text is toxic: that any word is, calibrated on the labelled texts."""
        clean = float(np.sum(np.log1p(-np.minimum(chances, 1 - 1e-12)))) if chances else 0.0
        any_ = min(1 - 1e-9, max(1e-9, -np.expm1(clean)))
        return float(1.0 / (1.0 + np.exp(-(self.scale * np.log(any_ / (1 - any_)) + self.shift))))


def _apart(texts: list[str]) -> list[int]:
    """One text of each group of copies, exact or near, so that what copies share is counted once.
    Equal marks only propose a copy; texts that merely share a passage all stay."""
    seen: list[dict[int, list[int]]] = [{} for _ in COPY_SEEDS]
    out: dict[int, np.ndarray] = {}
    for k, text in enumerate(texts):
        shingles = shingle_set(text.encode(), 3)
        marks = [int(splitmix(shingles ^ np.uint64(seed)).min()) if len(shingles) else 0 for seed in COPY_SEEDS]
        proposed = {at for mark, held in zip(marks, seen) for at in held.get(mark, ())}
        if any(_similar(shingles, out[at]) for at in proposed):
            continue
        out[k] = shingles
        for mark, held in zip(marks, seen):
            held.setdefault(mark, []).append(k)
    return list(out)


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of ``COPY`` or more; sets without shingles are equal."""
    if min(len(a), len(b)) < COPY * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b))
    return both >= COPY * (len(a) + len(b) - both)


def lean_features(texts: list[str], toxic: list[bool], most: int = FEATURES) -> tuple[dict[str, float], set[str]]:
    """(features that lean to toxic texts with their log odds, those met nearly only in toxic ones)."""
    counts = (Counter(), Counter())
    for text, label in zip(texts, toxic):
        counts[label].update({f for word in set(WORD.findall(text.lower())) for f in features(word)})
    n_toxic, n_clean = max(1, sum(toxic)), max(1, len(toxic) - sum(toxic))
    odds = {
        f: float(np.log((n + 0.5) / n_toxic) - np.log((counts[False][f] + 0.5) / n_clean))
        for f, n in counts[True].items() if n >= max(5, SUPPORT * n_toxic)
    }
    lean = sorted((f for f in odds if odds[f] > 2.0), key=lambda f: (-odds[f] * counts[True][f] ** 0.5, f))[:most]
    sure = {f for f in lean if counts[True][f] >= 8 and counts[False][f] * n_toxic * 20 <= counts[True][f] * n_clean}
    return {f: odds[f] for f in lean}, sure


def train(texts: list[str], toxic: list[bool], rounds: int = 100, most: int = FEATURES) -> ToxicityModel:
    """Weights by gradient ascent (Adam) on the penalised likelihood of tagged stretches."""
    start = np.array([[0.0, -3.0], [0.0, -3.0]])
    if not any(toxic):
        return ToxicityModel({}, -5.0, start, 1.0, -5.0)
    apart = _apart(texts)
    texts, toxic = [texts[k] for k in apart], [toxic[k] for k in apart]
    odds, sure = lean_features(texts, toxic, most)
    number = {f: k for k, f in enumerate(odds)}
    rows, tags = _stretches(texts, toxic, number, sure)
    weights, bias, transitions = np.zeros(len(number)), -3.0, np.zeros((2, 2))
    slots = np.array([[[w[k] if k < len(w) else len(number) for k in range(4)] for w in r] for r in rows])
    y = np.array(tags)
    moments = [np.zeros(len(number) + 5) for _ in range(2)]
    for t in range(1, rounds + 1):
        g_w, g_b, g_t = _gradient(slots, y, np.r_[weights, 0.0], bias, transitions)
        g = np.concatenate([g_w[:-1] - 0.02 * weights, [g_b], (g_t - 0.02 * transitions).ravel()])
        moments = [0.9 * moments[0] + 0.1 * g, 0.99 * moments[1] + 0.01 * g * g]
        move = 0.1 * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
        weights, bias, transitions = weights + move[:-5], bias + move[-5], transitions + move[-4:].reshape(2, 2)
    kept = {f: float(weights[k]) for f, k in number.items() if abs(weights[k]) > 1e-3}
    model = ToxicityModel(kept, float(bias), transitions)
    _calibrate(model, texts, toxic)
    return model


def _stretches(texts: list[str], toxic: list[bool], number: dict, sure: set) -> tuple[list, list]:
    """Feature numbers and tags of stretches of equal length; the middle word has features, or comes
    from a text without any. A text gives ``PER_TEXT`` at most, drawn by hash from all its places."""
    rows, tags = [], []
    for text, label in zip(texts, toxic):
        found = [features(w) for w in WORD.findall(text.lower())]
        held = [[number[f] for f in fs if f in number] for fs in found]
        tagged = [int(label and any(f in sure for f in fs)) for fs in found]
        places = np.array([k for k, h in enumerate(held) if h], np.uint64)
        drawn = np.argsort(splitmix(places + np.uint64(zlib.crc32(text.encode()))))[:PER_TEXT]
        middles = sorted(places[drawn].astype(int).tolist()) or ([len(held) // 2] if held else [])
        for k in middles:
            lo, hi = k - STRETCH, k + STRETCH + 1
            left, right = max(0, -lo), max(0, hi - len(held))
            rows.append([[]] * left + held[max(0, lo) : hi] + [[]] * right)
            tags.append([0] * left + tagged[max(0, lo) : hi] + [0] * right)
    return rows, tags


def _gradient(slots: np.ndarray, y: np.ndarray, weights: np.ndarray, bias: float, transitions: np.ndarray) -> tuple:
    """Gradient of the log likelihood, by forward-backward over all stretches at once."""
    n, length, _ = slots.shape
    emission = np.stack([np.zeros((n, length)), bias + weights[slots].sum(axis=2)], axis=2)
    alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    alpha[:, 0] = emission[:, 0]
    for t in range(1, length):
        alpha[:, t] = emission[:, t] + np.logaddexp.reduce(alpha[:, t - 1, :, None] + transitions, axis=1)
    for t in range(length - 2, -1, -1):
        beta[:, t] = np.logaddexp.reduce(transitions + (emission[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    chance = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None])
    error = y - chance
    g_w = np.bincount(slots.ravel(), np.repeat(error.ravel(), slots.shape[2]), len(weights))
    g_t = np.zeros((2, 2))
    for t in range(1, length):
        pair = np.exp(
            alpha[:, t - 1, :, None] + transitions + (emission[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
        )
        g_t -= pair.sum(axis=0)
        np.add.at(g_t, (y[:, t - 1], y[:, t]), 1.0)
    return g_w, error.sum(), g_t


def _calibrate(model: ToxicityModel, texts: list[str], toxic: list[bool]) -> None:
    """Scale and shift of the log odds by logistic regression (Newton steps)."""
    tag, y = model.tagger(), np.array(toxic, float)
    raw = np.array([model.score([p for _, _, p in tag(t)]) for t in texts])
    x = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], axis=1)
    beta = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ beta))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(h, x.T @ (y - p) - 1e-3 * beta)
    if beta[0] > 0:
        model.scale, model.shift = float(beta[0]), float(beta[1])


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = SAMPLE, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel:
    """Model from at most ``per_class`` toxic and twice as many clean labelled documents, those with
    the smallest hash of their id among label rows where ``learn`` holds. Rows without id or label
    teach nothing; of labels that disagree the largest counts."""
    known = labels.where(learn).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg((F.max("label") > 0).alias("label"))
    by_hash = (F.xxhash64("id", F.lit(11)), "id")
    toxic, clean = (known.where(F.col("label") == kind).orderBy(*by_hash).limit(n) for kind, n in ((True, per_class), (False, 2 * per_class)))
    chosen = toxic.union(clean)
    # at most 3 * per_class rows
    sample = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    rows = sample.orderBy("id", "text").collect()
    return train([r.text for r in rows], [r.label for r in rows])


def _score_pass(model: ToxicityModel, threshold: float) -> Callable:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = model.tagger()
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                tagged = tag(text.as_py() or "")
                scores.append(model.score([p for _, _, p in tagged]))
                spans.append([{"start": a, "end": b, "chance": p} for a, b, p in tagged if p >= threshold])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["id", "score", "spans"]
            )

    return run


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, spans) per row: chance that a text is toxic, and the words tagged toxic with their
    place in code points. Null and empty texts have no spans and the score of a text without any
    toxic word. Rows are scored one by one and whole, without a shuffle; an empty table gives no rows;
    other columns are ignored."""
    schema = "id long, score double, spans array<struct<start: long, end: long, chance: double>>"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_score_pass(model, threshold), schema)
