"""Models and mixing against enumeration, and the pipeline's stages on odd tables."""

import itertools
import math
import random

import corpus_pipeline
import numpy as np
import pytest
from demandflow.llm import language, mixing, toxicity
from hypothesis import given, settings
from hypothesis import strategies as st

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, key string, component_id int"


def segmentations(word, pieces):
    if not word:
        return [[]]
    return [[word[:k], *rest] for k in range(1, len(word) + 1) if word[:k] in pieces for rest in segmentations(word[k:], pieces)]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abc ", min_size=1, max_size=4).filter(lambda p: " " not in p[1:]), max_size=25), st.text("abc", min_size=1, max_size=9), st.integers(0, 9))
def test_forward_is_the_sum_over_all_segmentations(extra, word, seed):
    pieces = sorted({p.encode() for p in extra} | {bytes([b]) for b in b" abc"})
    chances = np.random.default_rng(seed).random((len(pieces), 2))
    words = language.distinct_words([word.encode()])[0][0]
    got = language.forward(words, language.piece_numbers(language.PieceTable(pieces), words), chances)[-1][0]
    number = {p: k for k, p in enumerate(pieces)}
    want = sum(np.prod([chances[number[p]] for p in cut], axis=0) for cut in segmentations(b" " + word.encode(), number))
    assert np.allclose(got, want, rtol=1e-9)


def test_all_pieces_of_the_vocabulary_take_part():
    import public_tokenizers

    pieces = language.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, pieces)) == language.MOST_BYTES and len(set(pieces)) == len(pieces)
    long_piece = max((p for p in pieces if p.startswith(b" ")), key=len)
    words = language.distinct_words([long_piece[1:]])[0][0]
    found = {(a, b) for a, b, rows, _ in language.piece_numbers(language.PieceTable(pieces), words) if len(rows)}
    assert (0, len(long_piece)) in found


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["vile", "vilest", "plain", "so", "word"]), min_size=1, max_size=8), st.integers(0, 9))
def test_marginals_are_those_of_all_tag_sequences(words, seed):
    draw = np.random.default_rng(seed)
    model = toxicity.ToxicityModel({"=vile": 2.5, "^vile": 0.7, "=so": -1.2}, float(draw.normal()), draw.normal(size=(2, 2)))
    got = {start: p for start, _, p in model.tagger()(" ".join(words))}
    emission = [[1.0, math.exp(model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(w)))] for w in words]
    total, ones = 0.0, [0.0] * len(words)
    for tags in itertools.product((0, 1), repeat=len(words)):
        weight = math.prod(e[t] for e, t in zip(emission, tags)) * math.prod(math.exp(model.transitions[a, b]) for a, b in zip(tags, tags[1:]))
        total += weight
        for k, t in enumerate(tags):
            ones[k] += weight * t
    starts = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]]).tolist()
    want = {s: o / total for s, w, o in zip(starts, words, ones) if any(f in model.weights for f in toxicity.features(w))}
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in got)


def tempered(tokens, goal):
    """Weights of the largest exponent whose entropy reaches the goal, by plain bisection."""
    shares = [t / sum(tokens.values()) for t in tokens.values()]

    def weights(a):
        z = sum(s**a for s in shares)
        return [s**a / z for s in shares]

    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        low, high = (a, high) if -sum(w * math.log(w) for w in weights(a)) >= goal * math.log(len(shares)) else (low, a)
    return dict(zip(tokens, weights(low)))


def test_mixing_weights_and_copies_against_plain_python(spark):
    draw = random.Random(6)
    tokens = {"a": 60_000, "b": 9_000, None: 2_500}
    rows = []
    for source, want in tokens.items():
        have = 0
        while have < want:
            n = min(draw.randint(1, 60), want - have)
            rows.append((len(rows), source, n))
            have += n
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long").selectExpr("*", "'' AS text")
    out = mixing.mix(docs, entropy_share=0.8, repetition_limit=None, budget=143_000.0, tokens=docs["n"], block=50).collect()
    want = tempered(tokens, 0.8)
    assert {r.source for r in out} == set(tokens)
    assert all(abs(r.weight - want[r.source]) < 1e-6 for r in out)
    taken, copies = {}, {}
    for r in out:
        taken[r.source] = taken.get(r.source, 0) + r.tokens
        copies.setdefault((r.source, r.key), set()).add(r.copy)
    for source, have in tokens.items():
        owed = want[source] * 143_000 / have  # epochs of the source
        assert abs(taken[source] / (want[source] * 143_000) - 1) < 0.02
        counts = {len(c) for (s, _), c in copies.items() if s == source} | ({0} if owed < 1 else set())
        assert counts <= {math.floor(owed), math.floor(owed) + 1}
    assert all(c == set(range(len(c))) for c in copies.values())


def odd_rows():
    words = " ".join(f"word{j}" for j in range(60))
    rows = [(1, "the house and the tree " + words, "en", "a", 1), (1, "the house and the tree " + words, "en", "a", 1), (2, None, None, None, None),
            (None, "the tree " + words[::-1], "en", None, 1), (3, "", "en", "a", 0), (4, "the cat sat on the mat " * 60_000, "en", "b", 1),
            (5, "der Baum und das Haus", "de", "b", 1)]
    return [(*r, "x", 7, "k", 3) for r in rows]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, name, stage):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    out = stage(spark, docs, "/nowhere")
    assert "doc_id" in out.columns and (name == "packing" or out.columns == corpus_pipeline.COLUMNS)
    kept = [(r.doc_id, None if name == "packing" else r.text) for r in out.collect()]
    ids = {k for k, _ in kept}
    if name == "language_id":
        assert len(kept) == 5 and {2, 3}.isdisjoint(ids)
    elif name == "line_dedup":
        assert len(kept) == 7
    elif name == "near_duplicates":
        assert len(kept) == 6 and sum(k == 1 for k, _ in kept) == 1
    else:
        assert ids == {1, 2, 3, 4, 5, None} or name == "mixing" and {1, 3, 4, 5} <= ids
    assert all(len(t) == 23 * 60_000 for k, t in kept if k == 4 and t)
    assert stage(spark, docs.limit(0), "/nowhere").count() == 0
