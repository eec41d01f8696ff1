import random
from datetime import date, timedelta

import pytest

from demandflow.operators.asof import asof_lookup

DAY = date(2025, 1, 6)
LEFT = "id int, k string, d date"
RIGHT = "k string, week date, v int, w string"


def lookup(spark, left, right, unique):
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    out = asof_lookup(l, r, ["k"], "d", "week", left_unique=unique)
    assert out.columns == ["id", "k", "d", "v", "w"]
    return sorted((tuple(x) for x in out.collect()), key=repr)


@pytest.mark.parametrize("unique", [True, False])
def test_before_at_between_and_after(spark, unique):
    right = [("a", DAY, 1, "x"), ("a", DAY + timedelta(7), 2, None), ("b", DAY, 9, "z")]
    left = [(i, "a", DAY + timedelta(n)) for i, n in enumerate([-1, 0, 3, 7, 99])]
    left += [(5, "c", DAY), (6, None, DAY), (7, "a", None)]
    got = {r[0]: r[3:] for r in lookup(spark, left, right, unique)}
    none = (None, None)
    assert got == {0: none, 1: (1, "x"), 2: (1, "x"), 3: (2, None), 4: (2, None), 5: none, 6: none, 7: none}


@pytest.mark.parametrize("unique", [True, False])
def test_equals_search_per_row(spark, unique):
    rng = random.Random(3)
    keys = ["a", "b", "c"]
    right = [(k, DAY + timedelta(n), rng.randrange(99), "s") for k in keys for n in rng.sample(range(60), 15)]
    if unique:
        left = [(i, *kd) for i, kd in enumerate(sorted({(rng.choice(keys), DAY + timedelta(rng.randrange(70))) for _ in range(90)}))]
    else:
        # one key owns more than a third of the rows, and many rows share a day
        left = [(i, rng.choice(keys + ["a"] * 3), DAY + timedelta(rng.randrange(20))) for i in range(400)]
    want = []
    for i, k, d in left:
        known = max((r for r in right if r[0] == k and r[1] <= d), key=lambda r: r[1], default=(None,) * 4)
        want.append((i, k, d, known[2], known[3]))
    assert lookup(spark, left, right, unique) == sorted(want, key=repr)


def test_no_features(spark):
    assert lookup(spark, [(1, "a", DAY)], [], False) == [(1, "a", DAY, None, None)]
    assert lookup(spark, [(1, "a", DAY)], [], True) == [(1, "a", DAY, None, None)]
