import random
import re

import numpy as np
import pytest

from demandflow.llm import common
from demandflow.llm import ngram_join as operator
from demandflow.llm.ngram_join import ngram_join


def sets_of(text, width):
    words = re.findall(r"[^ \t-\r]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute(texts, width, percent):
    sets = {k: sets_of(t, width) for k, t in texts}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(k for k in sets if sets[k])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((k, len(sets[k]), find(k)) for k in sets)


def corpus(seed, n=150):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [draw.choice(words) for _ in range(90)]
    out = []
    for k in range(n):
        if k % 3:  # a large group of near copies, many of them just below or above the threshold
            text = list(base)
            for _ in range(draw.randint(0, 5)):
                text[draw.randrange(len(text))] = draw.choice(words)
        else:
            text = [draw.choice(words) for _ in range(draw.randint(0, 60))] + base[:10]
        out.append((k, " ".join(text)))
    return out


@pytest.mark.parametrize("bucket, width, percent", [(64, 3, 90), (4, 3, 90), (4, 5, 80), (1000, 5, 80)])
def test_links_equal_brute_force(spark, monkeypatch, bucket, width, percent):
    monkeypatch.setattr(operator, "BUCKET", bucket)
    texts = corpus(bucket)
    got = ngram_join(spark.createDataFrame(texts, "doc_id long, text string"), width, percent)
    assert sorted(tuple(r) for r in got.collect()) == brute(texts, width, percent)


def test_odd_rows(spark):
    long_text = " ".join(f"v{k}" for k in range(60_000))
    texts = [(9, "one two"), (4, "ONE  two"), (5, None), (6, ""), (7, " \n"), (None, "one two"), (8, long_text), (2, long_text), (2, long_text)]
    docs = spark.createDataFrame([(k, t, 1, "n") for k, t in texts], "doc_id long, text string, node int, n string")
    got = sorted((tuple(r) for r in ngram_join(docs).collect()), key=repr)
    want = [(9, 1, 4), (4, 1, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (None, 1, None), (8, 59_996, 2), (2, 59_996, 2), (2, 59_996, 2)]
    assert got == sorted(want, key=repr)
    assert ngram_join(docs.limit(0)).count() == 0


def test_marks_differ_in_no_more_bits_than_the_sets_in_shingles():
    draw = np.random.default_rng(2)
    for _ in range(50):
        common, a, b = (draw.integers(0, 2**63, draw.integers(0, 3000), dtype=np.uint64) for _ in range(3))
        x, y = operator.parity_marks(np.r_[common, a]), operator.parity_marks(np.r_[common, b])
        assert len(x) * 64 == operator.MARKS
        assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b)


def _union_find(edges):
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)

    def top(x):
        return x if root[x] == x else top(root[x])

    return {(x, top(x)) for x in root}


def test_components_take_no_round_once_all_nodes_hang_on_their_smallest(spark, monkeypatch):
    rng = random.Random(7)
    stars = [(k, k % 5) for k in range(5, 60)] + [(k % 5, k) for k in range(60, 90)] + [(3, 3)] * 2
    chain = [(k, k + 1) for k in range(100, 140)]
    loose = [tuple(rng.sample(range(200, 300), 2)) for _ in range(70)]
    for edges, rounds in ((stars, 0), (stars * 3, 0), ([(1, 2), (2, 3)], 1), (stars + chain + loose, None), ([], 0)):
        labels = []
        monkeypatch.setattr(common, "stored", lambda df, label, keep=labels: (keep.append(label), df.localCheckpoint())[1])
        found = common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert len(found) == len(set(found))
        assert {tuple(r) for r in found} == _union_find([e for e in edges if e[0] != e[1]])
        assert rounds is None or labels == ["edges"] + ["large-star", "small-star"] * rounds
