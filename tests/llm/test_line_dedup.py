import hashlib
import time

from pyspark.sql import functions as F

from demandflow.llm.line_dedup import line_dedup

LONG = "This line is shared by several documents of the set"
SCHEMA = "doc_id long, text string, line_dedup string, id string"


def clean(spark, texts, **options):
    docs = spark.createDataFrame([(k, t, "x", "y") for k, t in texts], SCHEMA)
    rows = line_dedup(docs, **options).select("doc_id", "text", "line_dedup.n_lines", "line_dedup.n_dropped", "id").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_shared_lines_stay_in_the_largest_id(spark):
    texts = [(k, f"own {k}\n  {LONG.upper() if k % 2 else LONG}\t\n{LONG}") for k in range(6)]
    got = {r[0]: r for r in clean(spark, texts)}
    assert got[5][1] == texts[5][1] and got[5][3] == 0
    for k in range(5):
        assert got[k] == (k, f"own {k}", 3, 2, "y")


def test_short_lines_and_few_documents_stay(spark):
    assert all(r[3] == 0 for r in clean(spark, [(k, LONG) for k in range(4)]))
    assert all(r[3] == 0 for r in clean(spark, [(k, "short line") for k in range(9)]))


def test_nulls_empty_repeats(spark):
    texts = [(1, None), (2, ""), (None, LONG), (3, LONG), (3, LONG), (4, LONG), (5, LONG), (6, LONG + "\n")]
    got = clean(spark, texts)
    assert (1, None, 1, 0, "y") in got and (2, "", 1, 0, "y") in got
    # ids null, 3, 4, 5, 6 hold the line; the repeated row of 3 counts once and both are cleaned
    assert [r for r in got if r[0] == 3] == [(3, "", 1, 1, "y")] * 2
    assert (None, "", 1, 1, "y") in got and (6, LONG + "\n", 2, 0, "y") in got
    assert line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_columns_expressions(spark):
    docs = spark.createDataFrame([(k, LONG, "x", "y") for k in range(9)], SCHEMA)
    plan = line_dedup(docs).withColumn("h", F.sha2("text", 256))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Cartesian" not in plan


def test_long_text(spark):
    text = "\n".join(f"{LONG} {k % 7}" for k in range(20_000))
    got = clean(spark, [(k, text) for k in range(5)])
    assert [r[3] for r in got] == [20_000] * 4 + [0]
    assert hashlib.sha256(got[4][1].encode()).hexdigest() == hashlib.sha256(text.encode()).hexdigest()


def test_long_texts_of_shared_lines(spark):
    """Forty thousand lines that five documents share, and one of their own."""
    lines = [f"shared line number {j} of more than forty characters" for j in range(40_000)]
    texts = [(k, "\n".join([*lines[:20_000], f"own {k}", *lines[20_000:]])) for k in range(5)]
    started = time.time()
    got = {r[0]: r for r in clean(spark, texts)}
    assert all(got[k][1:4] == (f"own {k}", 40_001, 40_000) for k in range(4)) and got[4][1:4] == (texts[4][1], 40_001, 0)
    assert time.time() - started < 60


def test_an_id_with_several_texts(spark):
    shared = [(k, LONG) for k in range(10, 16)]
    texts = [*shared, (1, f"a\n{LONG}\nb"), (1, f"{LONG}\nc"), (1, f"{LONG}\nc"), (1, None)]
    got = [(r[1], r[2], r[3]) for r in clean(spark, texts) if r[0] == 1]
    assert sorted(got, key=repr) == sorted([("a\nb", 3, 1), ("c", 2, 1), ("c", 2, 1), (None, 1, 0)], key=repr)
