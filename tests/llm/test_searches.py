"""Suffix dedup, embedding dedup, personal data and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from demandflow.llm import embedding_dedup as embedding_module
from demandflow.llm import fingerprint, pii
from demandflow.llm.embedding_dedup import embedding_dedup
from demandflow.llm.suffix_dedup import suffix_dedup


def removed(texts, length=200):
    held = [(t or "").encode() for t in texts]
    counts = {}
    for text in held:
        for k in range(len(text) - length + 1):
            counts[text[k : k + length]] = counts.get(text[k : k + length], 0) + 1
    out = []
    for text in held:
        gone = [False] * len(text)
        for k in range(len(text) - length + 1):
            if counts[text[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = [k for k in range(len(text)) if gone[k] and not (k and gone[k - 1])]
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((len(text), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket_rows", [200_000, 40])
def test_suffix_dedup(spark, bucket_rows):
    draw = random.Random(bucket_rows)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(draw.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(draw.randint(25, 70)) for _ in range(4)]
    texts = [text(draw.randint(0, 40)) + draw.choice(passages) + text(draw.randint(0, 40)) for _ in range(60)]
    near = passages[0] + passages[1]
    texts += [near[:k] + "X" + near[k:] for k in range(0, len(near), 23)] + ["ab " * 300, None, "", texts[0], texts[0]]
    docs = spark.createDataFrame([(k if k != 3 else None, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, gram int")
    rows = suffix_dedup(docs, bucket_rows=bucket_rows).collect()
    got = {r.id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in rows}
    assert [got[k if k != 3 else None] for k in range(len(texts))] == removed(texts)
    assert suffix_dedup(docs.limit(0)).count() == 0


def test_suffix_dedup_one_bucket_of_several_files(spark):
    draw = random.Random(11)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    # every text has its own surroundings, so all contexts of a passage differ and fall in any file
    passages = [text(draw.randint(200, 330)) for _ in range(20)]
    texts = [text(draw.randint(150, 250)) + p + text(draw.randint(150, 250)) for p in passages for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in suffix_dedup(docs).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert [got[k] for k in range(len(texts))] == removed(texts)


def test_embedding_dedup(spark):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((30, 32))
    x = np.concatenate([c + 0.15 * draw.standard_normal((20, 32)) for c in centres] + [draw.standard_normal((300, 32))]).astype("float32")
    x[7] = x[8]
    odd = [None, [0.0] * 32, [float("nan")] * 32, [1.0, None] + [0.0] * 30, [1.0] * 5]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(2000 + k, v, 1) for k, v in enumerate(odd)] + [(None, x[0].tolist(), 1)]
    got = {r.id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int"), block=64).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[k].n_links for k in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.97 * want.sum()
    assert got[7].component_id == got[8].component_id and all(r.kept == (r.id == r.component_id) for r in got.values() if r.id is not None)
    assert all((got[2000 + k].n_links, got[2000 + k].component_id, got[2000 + k].kept) == (0, 2000 + k, True) for k in range(len(odd)))
    assert (got[None].component_id, got[None].kept) == (None, False)
    assert embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_dedup_of_mixed_lengths(spark):
    draw = np.random.default_rng(9)
    vectors = []
    for dim, groups in ((32, 20), (48, 6), (7, 4), (2, 3), (1, 2)):
        for centre in draw.standard_normal((groups, dim)):
            vectors += [(centre + 0.1 * draw.standard_normal(dim)).astype("float32") for _ in range(5)]
    vectors += [vectors[-1], vectors[110], vectors[110]]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    got = {r.id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    unit = [v.astype(float) / np.linalg.norm(v.astype(float)) for v in vectors]
    want = [sum(len(u) == len(v) and u @ v >= 0.95 for u in unit) - 1 for v in unit]
    for dim in (1, 2, 7, 32, 48):
        found = [(got[k].n_links, want[k]) for k in range(len(unit)) if len(unit[k]) == dim]
        assert all(f <= w for f, w in found) and sum(f for f, _ in found) >= (0.97 if dim > 7 else 0.85) * sum(w for _, w in found) > 0, dim
    assert got[110].n_links >= 2 and got[len(rows) - 1].component_id == got[110].component_id <= 110


def test_embedding_dedup_of_five_thousand_vectors(spark):
    draw = np.random.default_rng(21)
    centres = draw.standard_normal((700, 64))
    x = np.concatenate([np.repeat(centres, 5, axis=0) + 0.16 * draw.standard_normal((3500, 64)), draw.standard_normal((1500, 64))]).astype("float32")
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = {r.id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    want, found = linked.sum(axis=1) - 1, np.array([got[k].n_links for k in range(len(x))])
    assert want.sum() > 3000 and (found <= want).all() and found.sum() >= 0.99 * want.sum()


@pytest.mark.parametrize("dim, vectors", [(64, 500), (64, 50_000), (64, 1_000_000), (64, 100_000_000), (384, 100_000_000)])
def test_pairs_at_the_threshold_share_a_cap(dim, vectors):
    """Planted pairs at cosine 0.95 exactly, with the books of so many vectors."""
    draw = np.random.default_rng(3)
    a, r = draw.standard_normal((2, 200, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r -= (r * a).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * r / np.linalg.norm(r, axis=1, keepdims=True)
    caps = embedding_module.CapFilters(dim, vectors)
    met = [len(np.intersect1d(x, y)) > 0 for x, y in zip(caps.decode(a), caps.decode(b))]
    assert np.mean(met) >= 0.95


BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in BRUTE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    draw = random.Random(1)
    parts = ["a@b.co", "@", ".", "x.y", "1.2.3.4", "300.1.1.1", "001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+", " ", "-", "77", "é", "\n"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 12)))
        assert sorted(pii.base_spans(text)) == brute_spans(text), text


def test_added_spans_and_scores(spark):
    text = "bank account GB82 WEST 1234 5698 7654 32, social security ssn 123-45-6789"
    assert [(s.kind, text[s.start : s.end]) for s in pii.find(text)] == [("iban", "GB82 WEST 1234 5698 7654 32"), ("national", "123-45-6789")]
    assert not [s for s in pii.find("GB82 WEST 1234 5698 7654 33") if s.kind == "iban"]
    assert pii.find("part order 123-45-6789") == []
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "1" * 200_000 + "@" * 100_000, 1), (None, "me@x.org", 1)], "doc_id long, text string, spans int")
    got = {(r.doc_id, r.n_email, r.spans) for r in pii.find_pii(docs).select("id", *pii.digest()).withColumnRenamed("id", "doc_id").collect()}
    assert got == {(1, 0, ""), (2, 0, ""), (None, 1, "email:0:8")}


def test_fingerprints(spark):
    draw = random.Random(2)
    texts = {k * 3: "".join(draw.choice("abcdefé ") for _ in range(draw.randint(0, 300))) for k in range(50)}
    texts[6], texts[9], texts[12] = "", "abc", "x" * 100_000
    docs = spark.createDataFrame([(k, t, True) for k, t in texts.items()], "doc_id long, text string, guest boolean")
    got = {r.id: r for r in fingerprint.fingerprints(docs, range_rows=7).collect()}
    ids = sorted(texts)
    for k, i in enumerate(ids):
        text, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks = [fingerprint.fingerprint(t.encode()) for t in (text, edited, after)]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert [got[i].fingerprint, got[i].edited_fingerprint] == marks[:2]
        assert got[i].near_edited == fingerprint.likeness(*marks[:2]) and got[i].near_next == fingerprint.likeness(marks[0], marks[2])
    odd = spark.createDataFrame([(None, "a"), (None, None), (1, "b"), (1, "b")], "doc_id long, text string")
    assert fingerprint.fingerprints(odd).count() == 4 and fingerprint.fingerprints(odd.limit(0)).count() == 0
    assert fingerprint.fingerprints(odd.limit(1)).first().near_next == 1.0
