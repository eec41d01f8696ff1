import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandflow.llm import packing

ODD = [
    "a  b\n\n c \x1c\x1d d\x85e\xa0f '  's 'll I'LL", "<|endoftext|> x", "日本語 ½²³ ªº – “quote” …  €5", " x   y",
    "\t\t a", "x \n", "  ", "'s's", "٣٤ x", "é́", "don't I'll x' s", "a b   c", "x \n b \n\n c", "a" * 5000,
]


def encoder():
    return packing.token_bytes(packing.public_path("byte_bpe_50k.json"), packing.public_path("byte_bpe_50k.tiktoken"))


def ids(text):
    whole = Tokenizer.from_file(packing.public_path("byte_bpe_50k.json"))
    return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_equal_the_public_tokenizer():
    for text in ODD:
        assert encoder()(text) == ids(text), text


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2100, exclude_categories=["Cs"]), max_size=40))
def test_ids_of_any_text(text):
    assert encoder()(text) == ids(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=60))
def test_windows_hold_every_piece_once(lengths):
    sets = packing.windows(lengths)
    assert sorted(k for s in sets for k in s) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in s) <= 2048 for s in sets)


def test_windows_are_nearly_full():
    draw = random.Random(3)
    lengths = [n for _ in range(600) for _, n in packing.cut(draw.randint(1, 6000))]
    assert sum(lengths) > 0.97 * 2048 * len(packing.windows(lengths))


def test_pack(spark):
    texts = [(1, "hello world " * 900), (2, None), (3, ""), (3, ""), (None, "no id"), (4, "word " * 30_000)]
    docs = spark.createDataFrame([(k, t, 7, 8) for k, t in texts], "doc_id long, text string, start int, bucket int")
    rows = packing.pack(docs).collect()
    assert sum(r.length for r in rows) == sum(len(ids(t or "")) // 4 + 1 for _, t in texts)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    tokens = ids("hello world " * 900) + (1).to_bytes(4, "little")
    for r in (r for r in rows if r.id == 1):
        assert r.doc_tokens == len(tokens) // 4
        assert r.ids_crc32 == zlib.crc32(tokens[4 * r.start : 4 * (r.start + r.length)])
    assert packing.pack(spark.createDataFrame([], docs.schema)).count() == 0
