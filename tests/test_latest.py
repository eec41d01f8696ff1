import random
import time
from datetime import datetime

from pyspark.sql import functions as F

from demandflow.operators.latest import latest_per_key, upsert
from demandflow.sinks.keyed import ARRIVAL, KeyedTable
from demandflow.sources.landing import stream_table
from demandflow.streaming.flows import scd1_upsert


def test_newest_wins_whatever_the_order(spark, rows):
    df = spark.createDataFrame([("a", 2, "new"), ("a", 1, "old"), ("b", 5, "only")], "k string, seq int, v string")
    assert rows(latest_per_key(df, ["k"], ["seq"])) == [("a", 2, "new"), ("b", 5, "only")]


def test_equal_sequences_have_one_winner(spark, rows):
    data = [("a", 1, "x", 3), ("a", 1, "y", 1), ("a", 1, "y", 2)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, seq int, v string, w int").repartition(3)
        assert rows(latest_per_key(df, ["k"], ["seq"])) == [("a", 1, "y", 2)]


def test_null_sequence_is_oldest_but_kept(spark, rows):
    df = spark.createDataFrame([("a", None, "lost"), ("a", 1, "kept"), ("b", None, "only")], "k string, seq int, v string")
    assert rows(latest_per_key(df, ["k"], ["seq"])) == [("a", 1, "kept"), ("b", None, "only")]


def test_null_values_survive(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, seq int, v string")
    assert rows(latest_per_key(df, ["k"], ["seq"])) == [("a", 2, None)]


def test_upsert_replaces_adds_and_never_deletes(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    updates = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert rows(upsert(target, updates, ["k"])) == [("a", 1), ("b", 2), ("c", 2)]


def test_keyed_table_equals_one_big_reduction(spark, rows, tmp_path):
    """Random out-of-order batches, a replay and two compactions, against plain Python."""
    rng = random.Random(7)
    schema = spark.createDataFrame([], "k string, seq int, v int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"])
    best: dict[str, tuple] = {}
    for batch_id in range(6):
        batch = [(f"k{rng.randrange(30)}", rng.randrange(50), rng.randrange(1000)) for _ in range(40)]
        table.apply(spark.createDataFrame(batch, schema), batch_id)
        table.apply(spark.createDataFrame([("replay", 0, 0)], schema), batch_id)  # same id: ignored
        for k, seq, v in batch:
            best[k] = max(best.get(k, (-1, -1)), (seq, v))
        if batch_id in (2, 4):
            table.compact()
        assert rows(table.read()) == sorted(((k, s, v) for k, (s, v) in best.items()))
    table.vacuum()
    assert table._base()[1] == {"direct": 4} and table._changes(table._base()[1]) == [("direct", 5)]
    assert len(list((tmp_path / "t/base").iterdir())) == 1
    assert [p.name for p in (tmp_path / "t/changes/_flow=direct").iterdir()] == ["_batch=5"]
    assert rows(table.read()) == sorted(((k, s, v) for k, (s, v) in best.items()))


def test_unfinished_batch_is_not_seen_and_is_overwritten(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "k string, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"])
    table.apply(spark.createDataFrame([("a", 1)], schema), 0)
    table.apply(spark.createDataFrame([("a", 9), ("b", 9)], schema), 1)
    (tmp_path / "t" / "changes" / "_flow=direct" / "_batch=1" / "_SUCCESS").unlink()
    assert rows(table.read()) == [("a", 1)]
    table.apply(spark.createDataFrame([("a", 2)], schema), 1)
    assert rows(table.read()) == [("a", 2)]


def test_arrival_order_for_tables_without_a_sequence(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "k string, v int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], [ARRIVAL])
    assert rows(table.read()) == []
    for batch_id, value in enumerate([5, 9, 1]):
        table.apply(spark.createDataFrame([("a", value), (f"b{value}", value)], schema), batch_id)
        if batch_id == 1:
            table.compact()
    assert rows(table.read()) == [("a", 1), ("b1", 1), ("b5", 5), ("b9", 9)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows on one key: at most one of them per task leaves the map side."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"),
        F.lit(datetime(2024, 1, 1)).alias("v"),
    )
    out = latest_per_key(df.repartition(8), ["k"], ["seq"])
    assert out.count() == 20_001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") >= 1


def test_a_missing_key_is_one_key(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "k string, j int, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k", "j"], ["seq"])
    for seq in (1, 2):
        table.apply(spark.createDataFrame([(None, 1, seq), ("a", None, seq)], schema), seq)
        table.compact() if seq == 1 else None
    assert rows(table.read()) == [(None, 1, 2), ("a", None, 2)]


def test_compaction_waits_for_enough_changes(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "k int, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"])
    assert not table.compact_if_due(min_bytes=1)  # nothing there yet
    table.apply(spark.range(50_000).selectExpr("int(id) k", "0 seq"), 0)
    assert not table.compact_if_due() and table.compact_if_due(min_bytes=1)
    table.apply(spark.range(10).selectExpr("int(id) k", "1 seq"), 1)
    assert not table.compact_if_due(min_bytes=1)  # few changes on a large base
    assert table._base()[1] == {"direct": 0} and table._changes({"direct": 0}) == [("direct", 1)] and table.read().where("seq = 1").count() == 10
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2  # the base is matched with the changed keys in place
    table.apply(spark.range(50_000).selectExpr("int(id) k", "2 seq"), 2)
    assert table.compact_if_due(min_bytes=1) and table._base()[1] == {"direct": 2}
    assert table.read().where("seq = 2").count() == 50_000


def test_flows_number_their_own_batches(spark, tmp_path, rows):
    schema = "k string, v int"
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k"], [ARRIVAL])
    table.apply(spark.createDataFrame([("a", 1)], schema), 0, "one")
    table.apply(spark.createDataFrame([("a", 9), ("b", 5)], schema), 0, "two")
    table.apply(spark.createDataFrame([("a", 7)], schema), 0, "one")  # replay: skipped
    assert rows(table.read()) == [("a", 9), ("b", 5)]
    table.compact()
    table.vacuum()
    table.apply(spark.createDataFrame([("b", 6)], schema), 0, "two")  # replay after compaction: skipped
    table.apply(spark.createDataFrame([("b", 8)], schema), 0, "three")
    assert rows(table.read()) == [("a", 9), ("b", 8)]


def test_flows_that_write_at_the_same_moment(spark, tmp_path, rows, monkeypatch):
    """Both flows look at the table before either has written; neither loses a row."""
    schema = "k string, v int"
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k"], [ARRIVAL])
    table.apply(spark.createDataFrame([("z", 0)], schema), 0, "one")
    seen = table._changes({})
    monkeypatch.setattr(table, "_changes", lambda folded: seen)
    monkeypatch.setattr(time, "time_ns", lambda: 10**18)  # and at the same time
    table.apply(spark.createDataFrame([("a", 1), ("b", 1)], schema), 1, "one")
    table.apply(spark.createDataFrame([("b", 9), ("c", 9)], schema), 0, "two")
    monkeypatch.undo()
    assert rows(table.read()) == [("a", 1), ("b", 9), ("c", 9), ("z", 0)]


def test_a_batch_that_ends_after_a_compaction_stays(spark, tmp_path, rows):
    """It began first, so its number and time are smaller than those of what the base holds."""
    schema = "k string, v int"
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k"], ["v"])
    table.apply(spark.createDataFrame([("late", 1)], schema), 0, "slow")
    marker = tmp_path / "t/changes/_flow=slow/_batch=0/_SUCCESS"
    content = marker.read_bytes()
    marker.unlink()
    table.apply(spark.createDataFrame([("a", 1)], schema), 0, "fast")
    table.compact()
    marker.write_bytes(content)
    assert rows(table.read()) == [("a", 1), ("late", 1)]
    table.vacuum()
    table.compact()
    table.vacuum()
    assert rows(table.read()) == [("a", 1), ("late", 1)] and table._base()[1] == {"fast": 0, "slow": 0}
    assert not table.apply(spark.createDataFrame([("late", 5)], schema), 0, "slow")


def test_one_batch_is_the_table_and_many_changes_are_reduced_in_one_shuffle(spark, rows, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "k int, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"])
    table.apply(spark.range(1000).selectExpr("int(id) k", "0 seq"), 0)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and table.read().count() == 1000
    table.apply(spark.range(10).selectExpr("int(id) k", "1 seq"), 1)
    few = rows(table.read())
    assert len(few) == 1000 and few[:10] == [(k, 1) for k in range(10)] and few[10] == (10, 0)
    for compacted in (False, True):
        if compacted:
            table.compact()
            table.apply(spark.range(5).selectExpr("int(id) k", "2 seq"), 2)
        want = rows(table.read())
        monkeypatch.setattr("demandflow.sinks.keyed.FEW_BYTES", 0)
        plan = table.read()._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in plan and rows(table.read()) == want
        monkeypatch.undo()


def test_more_than_a_few_changes_leave_most_of_the_base_unshuffled(spark, rows, tmp_path, monkeypatch):
    """Beyond what is matched by keys, marks of the changed keys choose the base rows that are reduced."""
    schema = spark.createDataFrame([], "k string, j int, seq int, v int").schema
    rng = random.Random(11)
    for compacted in (False, True):
        table = KeyedTable(spark, str(tmp_path / f"t{compacted}"), schema, ["k", "j"], ["seq"])
        base = [(f"k{n}", None if n % 7 == 0 else n, rng.randrange(9), n) for n in range(4_000)] + [(None, 1, 0, -1)]
        table.apply(spark.createDataFrame(base, schema), 0)
        if compacted:
            table.compact()
        changes = [(k, j, rng.randrange(9), v + 1) for k, j, _, v in base if v % 9 == 0] + [("new", 0, 1, 1), (None, 1, 3, -2)]
        table.apply(spark.createDataFrame(changes, schema), 1)
        best: dict[tuple, tuple] = {}
        for k, j, seq, v in base + changes:
            best[k, j] = max(best.get((k, j), (-1, -9)), (seq, v))
        expected = {(k, j, s, v) for (k, j), (s, v) in best.items()}
        assert {tuple(r) for r in table.read().collect()} == expected
        monkeypatch.setattr("demandflow.sinks.keyed.FEW_BYTES", 0)
        monkeypatch.setattr("demandflow.sinks.keyed.MARK_FROM_BYTES", 0)
        read = table.read()
        found = [tuple(r) for r in read.collect()]
        assert len(found) == len(expected) and set(found) == expected
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan and "BroadcastHashJoin" in plan
        marked = table._marked(spark.createDataFrame(base, schema), spark.createDataFrame(changes, schema))
        assert 400 < marked.where("__marked").count() < 500
        monkeypatch.setattr("demandflow.sinks.keyed.MARK_SHARE", 0.0)
        assert {tuple(r) for r in table.read().collect()} == expected  # all reduced together
        monkeypatch.undo()


def test_a_single_batch_of_a_flow_is_not_copied(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(KeyedTable, "compact_if_due", lambda table: asked.append(table._changes({})))
    spark.range(10).write.parquet(f"{tmp_path}/in")
    table = KeyedTable(spark, f"{tmp_path}/t", spark.range(0).schema, ["id"], [])
    for _ in range(2):
        scd1_upsert(stream_table(spark, f"{tmp_path}/in"), table, f"{tmp_path}/checkpoint").awaitTermination()
        spark.range(5, 20).write.mode("append").parquet(f"{tmp_path}/in")
    assert [len(changes) for changes in asked] == [2] and table.read().count() == 20


def test_a_batch_of_distinct_keys_is_written_as_it_is(spark, rows, tmp_path, monkeypatch):
    """No reduction where no key repeats; a key twice, a NULL key too, is reduced as ever."""
    schema = spark.createDataFrame([], "k string, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"], distinct=True)
    monkeypatch.setattr("demandflow.sinks.keyed.latest_per_key", None)
    assert table.apply(spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], schema), 0)
    assert rows(table.read()) == [(None, 1), ("a", 1), ("b", 1)]
    monkeypatch.undo()
    assert table.apply(spark.createDataFrame([("a", 2), ("a", 4), ("a", 3), (None, 5), (None, 4)], schema), 1)
    assert rows(table.read()) == [(None, 5), ("a", 4), ("b", 1)]
    assert not table.apply(spark.createDataFrame([("a", 9)], schema), 1)


def test_a_batch_whose_keys_are_not_checked_yet_is_not_read(spark, rows, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "k string, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"], distinct=True)
    table.apply(spark.createDataFrame([("a", 1)], schema), 0)
    seen = []
    monkeypatch.setattr("demandflow.sinks.keyed.repeated_keys", lambda df, keys: seen.append((df.count(), rows(table.read()))))
    table.apply(spark.createDataFrame([("b", 1), ("c", 1)], schema), 1)
    assert seen == [(2, [("a", 1)])] and rows(table.read()) == [("a", 1), ("b", 1), ("c", 1)]


def test_the_largest_batch_counts_as_the_base_that_is_not_there(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, seq int").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["seq"])
    table.apply(spark.range(50_000).selectExpr("int(id) k", "0 seq"), 0)
    table.apply(spark.range(10).selectExpr("int(id) k", "1 seq"), 1)
    assert not table.compact_if_due(min_bytes=1)  # it would copy 50,000 rows for 10
    assert table.read().where("seq = 1").count() == 10 and table.read().count() == 50_000
    table.apply(spark.range(50_000).selectExpr("int(id) k", "2 seq"), 2)
    assert table.compact_if_due(min_bytes=1) and table.read().where("seq = 2").count() == 50_000
