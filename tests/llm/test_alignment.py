import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandflow.llm import alignment, packing, queries

A = Tokenizer.from_file(packing.public_path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=packing.public_path("piece_bpe_32k.model"))

ODD = [
    "The  quick\n\nbrown fox", "日本語のテキスト", "a▁b", "<|endoftext|> and <s> </s> <0x41>", "é é €", " leading", "trailing  ",
    "x" * 3000, "\t\ttabs", "=" * 500, "don't I'll", "\x00nul", "emoji 👩‍👩‍👧", "   ", "\n", "1234567890 12.5%", "a\x85b\xa0c",
]


def byte_level():
    """Characters of the byte-level alphabet and the bytes they stand for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


LEVEL = byte_level()


def tokens(text):
    """(id, start, end) of both sides, or None."""
    a = [(k, bytes(LEVEL[c] for c in A.id_to_token(k))) for k in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for k in B.encode(text):
        piece = B.id_to_piece(k)
        b.append((k, bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and B.is_byte(k) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return None
    sides = []
    for side in (a, b):
        at, out = 0, []
        for k, t in side:
            out.append((k, at, at + len(t)))
            at += len(t)
        sides.append(out)
    return sides


def by_hand(docs):
    links, shown = [], []
    for _, text in docs:
        sides = tokens(text) if text else None
        if not sides:
            links.append(Counter())
            shown.append((0, 0, 0, ""))
            continue
        a, b = sides
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        found, parts, low = Counter(), [], 0
        for cut in cuts:
            ga = [k for k, s, e in a if low <= s and e <= cut]
            gb = [k for k, s, e in b if low <= s and e <= cut]
            found.update((x, y) for x in ga for y in gb)
            parts.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            low = cut
        links.append(found)
        shown.append((len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    counts = Counter(pair for found in links for pair in found)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted(
        (key, *s[:3], sum(f.values()), sum(m for p, m in f.items() if counts[p] == best[p[0]]), sum(m * counts[p] for p, m in f.items()), s[3])
        for (key, _), f, s in zip(docs, links, shown)
    )


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df, key):
    return sorted(tuple(r) for r in df.select(key, *COLUMNS).collect())


def made(count, seed=1):
    draw = random.Random(seed)
    stems = ["the", "of", "réunion", "tionst", "Zürich", "12.5", "x-ray", "日本", "erhaea", "don't", "\n", "  ", "==", "Ünïcode"]
    return [(k, " ".join(draw.choices(stems, k=draw.randint(1, 60)))) for k in range(count)]


@pytest.mark.parametrize("frequent, segment", [(100_000, 1 << 18), (3, 40), (1, 1)])
def test_alignment_equals_plain_python(spark, frequent, segment):
    docs = [*enumerate(ODD), *[(100 + k, t) for k, t in made(40)], (7, None), (7, ""), (7, "again"), (7, "again")]
    rows = spark.createDataFrame([(k, t, 5, "x", 9) for k, t in docs], "doc_id long, text string, n_a long, pair string, row int")
    assert got(alignment.align_tokens(rows, frequent=frequent, segment=segment), "id") == by_hand(docs)


def test_registered_query_equals_plain_python(spark, tmp_path):
    docs = made(150, 2)
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert got(queries.op11_alignment(spark, str(tmp_path)), "doc_id") == by_hand(docs)


def test_nothing_at_all(spark):
    assert got(alignment.align_tokens(spark.createDataFrame([], "doc_id long, text string")), "id") == []
    empty = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert alignment.align_tokens(empty).select("n_a", "count_sum", "groups_sha256").distinct().collect() == [(0, 0, "")]


def test_a_long_text_in_segments_is_one_document(spark):
    text = " ".join(t for _, t in made(400, 3))
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert got(alignment.align_tokens(rows, segment=500), "id") == by_hand([(1, text)])


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60), st.integers(1, 20))
def test_segments_are_encoded_like_the_whole(text, size):
    pieces = list(alignment.segments(text, size))
    assert "".join(pieces) == " " + text
    a = [k for p in pieces for k in A.encode(p, add_special_tokens=False).ids]
    b = [k for p in pieces for k in B.encode(p[1:])]
    assert a == A.encode(" " + text, add_special_tokens=False).ids and b == B.encode(text)


def test_large_groups_list_distinct_ids():
    part, pair, weight = alignment.links_of(
        np.array([1, 2] * 50), np.array([3, 4, 5] * 40), np.zeros(100, int), np.zeros(120, int), np.array([0])
    )
    assert dict(zip(pair, weight)) == {a * alignment.B_SIZE + b: 50 * 40 for a in (1, 2) for b in (3, 4, 5)}
