"""Language, toxicity, mixing and the pipeline."""

import math
import random

import corpus_pipeline
from demandflow.llm import language, mixing, packing, toxicity
from demandflow.llm.queries import _held_out, op2_language, op9_mixing, op10_toxicity
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def test_forward_sums_all_segmentations():
    pieces = sorted({b" a", b"ab", b"b", b"a", b" ", b" ab"})
    model = language.train({"x": [b"ab ab"]}, pieces, rounds=0)
    words = language.distinct_words([b"ab"])[0][0]
    total = language.forward(words, language.piece_numbers(language.PieceTable(pieces), words), model.chances)[-1][0, 0]
    p = 1 / len(pieces)
    assert math.isclose(total, p + 2 * p**2 + p**3)  # " ab"; " a|b", " |ab"; " |a|b"


def test_language_held_out_accuracy_and_odd_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = [r for r in op2_language(spark, FOLDER).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) > 0.95 * len(rows)
    docs = spark.createDataFrame([(1, None, "x", "q"), (2, "12 34 …", "x", "q"), (3, "the " * 50_000, "x", "q")], "doc_id long, text string, row string, language string")
    model = language.train({"en": [b"the cat and the dog"], "de": [b"der hund und die katze"]}, language.vocabulary(public()))
    got = {r.doc_id: (r.language.lang_pred, r.row) for r in language.identify(docs, model).collect()}
    assert got == {1: ("und", "x"), 2: ("und", "x"), 3: ("en", "x")}
    assert language.fit(docs.withColumn("lang", F.lit(None).cast("string")), _held_out(3, 1)).languages == []
    assert language.identify(docs.limit(0), model).count() == 0


def public():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in op10_toxicity(spark, FOLDER).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.93 * len(rows)


def test_toxic_spans(spark):
    draw = random.Random(4)
    clean = [" ".join(f"w{draw.randrange(500)}" for _ in range(60)) for _ in range(200)]
    bad = [t + " vile " + t[:50] + " viler" for t in clean[:60]]
    model = toxicity.train(clean[60:] + bad, [False] * 140 + [True] * 60)
    docs = spark.createDataFrame([(1, "w1 w2 vile w3", 1), (2, "w1 w2 w3", 1), (3, None, 1), (None, "", 1), (4, "w1 " * 100_000 + "vile", 1)], "doc_id long, text string, score int")
    got = {r.id: (r.score >= 0.5, [(s.start, s.end) for s in r.spans]) for r in toxicity.score_toxicity(docs, model).collect()}
    assert got == {1: (True, [(6, 10)]), 2: (False, []), 3: (False, []), None: (False, []), 4: (True, [(300_000, 300_004)])}
    assert toxicity.train(["a b"], [False]).tagger()("a b") == []


def test_toxicity_learns_from_whole_texts_and_drops_only_copies():
    rows, _ = toxicity._stretches(["a " * 200 + "b " * 200], [True], {"=a": 0, "=b": 1}, {"=a"})
    assert len(rows) == toxicity.PER_TEXT and {f for r in rows for w in r for f in w} == {0, 1}
    passage = " ".join(f"license{j}" for j in range(100))
    texts = [passage + "".join(f" own{k}x{j}" for j in range(60)) for k in range(6)]
    assert toxicity._apart([*texts, texts[2], texts[3] + " end", "", ""]) == [*range(6), 8]


def test_mixing(spark):
    rows = [(k, "a" if k % 3 else ("b" if k % 2 else None), "x" * (10 + k % 90), 0.0) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, weight double")
    out = mixing.mix(docs, entropy_share=0.97, repetition_limit=3.0, block=100).collect()
    tokens, counts = {}, {}
    for r in out:
        tokens[r.source] = tokens.get(r.source, 0) + r.tokens
        counts[r.key] = counts.get(r.key, 0) + 1
    total = sum(tokens.values())
    weights = {r.source: r.weight for r in out}
    assert set(counts) == set(range(6000)) and max(counts.values()) <= 3
    assert all(abs(tokens[s] / total - w) < 0.01 for s, w in weights.items())
    entropy = -sum(w * math.log(w) for w in weights.values())
    assert abs(entropy - 0.97 * math.log(3)) < 1e-3 and all(0 <= r.position < 1 for r in out)
    limited = mixing.mix(docs, entropy_share=1.0, repetition_limit=1.5).groupBy("source").agg(F.sum("tokens")).collect()
    have = {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum(mixing.estimated_tokens(F.col("text")))).collect()}
    assert max(r[1] / have[r[0]] for r in limited) < 1.52
    odd = spark.createDataFrame([(None, None, None), (1, "s", ""), (1, "s", "")], "doc_id long, source string, text string")
    assert mixing.mix(odd).count() == 2 and mixing.mix(odd.limit(0)).count() == 0


def test_mixing_counts_tokens_of_packing(spark, tmp_path):
    draw = random.Random(8)
    texts = [("words", " ".join(draw.choice(["the", "house", "international", "document"]) for _ in range(60))) for _ in range(400)]
    texts += [("digits", " ".join(str(draw.randrange(10**9)) for _ in range(20))) for _ in range(100)]
    texts += [("kana", "".join(chr(draw.randrange(0x3041, 0x3097)) for _ in range(60))) for _ in range(100)] + [("kana", None), ("kana", "")]
    rows = [(k, t, "en", s, 1) for k, (s, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {r.id: r.doc_tokens for r in packing.pieces(docs).collect()}
    out = op9_mixing(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(want) and all(r.tokens == want[r.doc_id] for r in out)
    weights, tokens = {r.source: r.weight for r in out}, {}
    for r in corpus_pipeline.mixing_stage(spark, docs, FOLDER).collect():
        tokens[r.source] = tokens.get(r.source, 0) + want[r.doc_id]
    assert all(abs(n / sum(tokens.values()) - weights[s]) < 0.01 for s, n in tokens.items())


def test_pipeline_stages(spark):
    line = "A line of more than forty characters that many documents share"
    body = lambda k: " ".join(f"word{k}x{j}" for j in range(60))
    rows = [(k, f"the house and the tree {body(k)}\n{line}", "en", f"s{k % 3}", 1) for k in range(12)]
    rows += [(20, rows[0][1] + " end", "en", "s0", 1), (21, None, "en", "s0", 1), (22, "123 456", None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(spark.createDataFrame([(90, "der Baum und das Haus " * 9, "de", None, 1)], docs.schema))
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.stored(stage(spark, kept, FOLDER), "test")
        ids = sorted({r.doc_id for r in kept.select("doc_id").collect()})
        if name != "packing":
            assert kept.columns == corpus_pipeline.COLUMNS
        expected = [*range(12), 20, 90] if name in ("language_id", "line_dedup") else [*range(12), 90]
        assert ids == expected, name
        if name == "line_dedup":
            assert kept.where(F.col("text").contains(line)).select("doc_id").collect() == [(11,)] or kept.where(F.col("text").contains(line)).count() == 2


def test_pipeline_loses_no_clean_document(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    # one word that three languages share, and no text says more about it
    rows = [(10 * k + n, f"{word} alpha", lang, "s", 1) for k in range(3) for n, (lang, word) in enumerate([("en", "tree"), ("de", "baum"), ("fr", "arbre")])]
    docs = spark.createDataFrame([*rows, (90, "alpha", "en", "s", 1), (91, "12 34", "en", "s", 1)], schema)
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, FOLDER).collect()}
    assert kept == {r[0] for r in rows} | {90}

    text = lambda name: " ".join(f"{name}{j}" for j in range(60))
    rows = [(5, text("a")), (5, text("b")), (5, text("a")), (5, None), (5, ""), (3, text("b") + " end"), (7, text("a") + " end"), (8, text("c")), (None, text("c")), (None, text("c"))]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], schema)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).collect()]
    want = [(5, text("a")), (5, None), (5, ""), (3, text("b") + " end"), (8, text("c")), (None, text("c")), (None, text("c"))]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_language_sample_is_counted_in_portions(monkeypatch):
    """Words and weights are those of one count over all texts, whatever is read at a time."""
    rng = random.Random(3)
    texts = [
        [" ".join(rng.choice(["the", "Cat", "naïve", "x" * 130, "a-b"]) for _ in range(rng.randrange(300))).encode() for _ in range(9)],
        [b"", b"z" * 700 + b" end", "über 12 Über".encode()],
    ]
    expected: dict[tuple, float] = {}
    for k, own in enumerate(texts):
        matrices, _, word = language.distinct_words(own)
        names = [w.tobytes() for m in matrices for w in m]
        for at in word:
            expected[names[at], k] = expected.get((names[at], k), 0) + 1
    sizes = []
    inner = language.distinct_words
    monkeypatch.setattr(language, "distinct_words", lambda some: sizes.append(sum(map(len, some))) or inner(some))
    for size in (50, 1000, 1 << 20):
        monkeypatch.setattr(language.portions, "__defaults__", (size,))
        sizes.clear()
        matrices, weights = language.word_weights(texts)
        names = [w.tobytes() for m in matrices for w in m]
        assert {(w, k): weights[at, k] for at, w in enumerate(names) for k in (0, 1) if weights[at, k]} == expected
        assert max(sizes) <= max(size, 701)  # no word is cut
    empty = language.word_weights([[], [b""]])
    assert empty[0] == [] and empty[1].shape == (0, 2)
