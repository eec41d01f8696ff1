import random
from datetime import date, datetime

from pyspark.sql import functions as F

from demandflow.operators.conform import conform_transactions
from demandflow.operators.latest import latest_per_key
from demandflow.plans.actions import STATUS_SCHEMA
from demandflow.schemas import LANDING_SCHEMAS
from demandflow.sinks.keyed import KeyedTable
from demandflow.sinks.tables import append_stream, materialize, overwrite_table, snapshot_sync, write_landing
from demandflow.sources.landing import read_table, stream_csv, stream_parquet, stream_table, with_ingest_metadata
from demandflow.streaming.flows import (
    rule_failures, run_bronze, run_silver, run_status, scd1_upsert, write_rule_counts,
)

import pytest


def sales(spark, *data):
    return spark.createDataFrame([(i, "EL-001", "1001", "2024-03-04", q, p) for i, q, p in data], LANDING_SCHEMAS["transactions"])


class Place:
    """Folders of one flow."""

    def __init__(self, root, feed="transactions"):
        self.landing, self.bronze, self.silver = f"{root}/landing", f"{root}/bronze", f"{root}/silver"
        self.feed, self.checkpoints = feed, (f"{root}/c1", f"{root}/c2")

    def run(self, spark, glob=None):
        run_bronze(spark, self.feed, self.landing, self.bronze, self.checkpoints[0], glob)
        return run_silver(spark, self.feed, self.bronze, self.silver, self.checkpoints[1])


def test_landing_to_silver_with_redelivery_and_corrections(spark, tmp_path, rows):
    place = Place(tmp_path)
    write_landing(sales(spark, ("t1", "2", "3.0"), ("t2", "x", "3.0"), ("t3", "1", "1.0")), f"{place.landing}/a")
    place.landing += "/*"
    silver = place.run(spark)
    assert rows(silver.read(), "transaction_id", "quantity_sold") == [("t1", 2), ("t3", 1)]
    assert rows(rule_failures(spark, place.silver)) == [("valid_date", 0, 3), ("valid_quantity", 1, 3), ("valid_revenue", 0, 3)]
    bronze = read_table(spark, place.bronze)
    assert bronze.count() == 3 and bronze.where("_source_system = 'pos_system' AND _source_file LIKE '%landing%'").count() == 3

    silver = place.run(spark)  # nothing new
    assert read_table(spark, place.bronze).count() == 3

    root = place.landing.removesuffix("/*")
    write_landing(sales(spark, ("t1", "2", "3.0"), ("t2", "x", "3.0"), ("t3", "1", "1.0")), f"{root}/b")
    silver = place.run(spark)  # delivered again under new names: bronze grows, silver does not
    assert read_table(spark, place.bronze).count() == 6
    assert rows(silver.read(), "transaction_id", "quantity_sold") == [("t1", 2), ("t3", 1)]

    write_landing(sales(spark, ("t1", "7", "3.0"), ("t3", "0", "1.0"), ("t4", "4", "1.0")), f"{root}/c")
    silver = place.run(spark)  # a good update wins, a bad one does not replace a good row
    assert rows(silver.read(), "transaction_id", "quantity_sold") == [("t1", 7), ("t3", 1), ("t4", 4)]
    assert rows(rule_failures(spark, place.silver)) == [("valid_date", 0, 9), ("valid_quantity", 3, 9), ("valid_revenue", 0, 9)]


def test_promotions_from_csv_by_glob(spark, tmp_path, rows):
    place = Place(tmp_path, "promotions")
    promo = ("P1", "EL-001", "store_1001", "20%", "both", "01/06/2025", "01/12/2025")
    write_landing(spark.createDataFrame([promo], LANDING_SCHEMAS["promotions"]), place.landing, "csv")
    (tmp_path / "landing" / "notes.txt").write_text("not,a,promotion\n1,2,3\n")
    silver = place.run(spark, glob="*.csv")
    assert rows(silver.read(), "promo_id", "target_sku", "target_store_id", "discount_pct") == [("P1", "EL-001", "1001", 0.2)]


def test_dimensions_flow_too(spark, tmp_path):
    for feed, row in (
        ("products", ("EL-001", "n", "c", "s", "1.00", "2.00")),
        ("stores", ("1001", "n", "r", "t", "m", "e", "p", "2015-01-01")),
    ):
        place = Place(tmp_path / feed, feed)
        write_landing(spark.createDataFrame([row], LANDING_SCHEMAS[feed]), place.landing)
        assert place.run(spark).read().count() == 1


def test_stream_in_many_batches_equals_batch(spark, tmp_path, rows):
    """Out-of-order versions spread over files, one file per micro-batch."""
    rng = random.Random(1)
    schema = "k string, seq int, v int"
    everything = []
    for i in range(5):
        part = [(f"k{rng.randrange(15)}", rng.randrange(40), rng.randrange(9)) for _ in range(30)]
        everything += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files=1)
    table = KeyedTable(spark, str(tmp_path / "t"), stream.schema, ["k"], ["seq"])
    scd1_upsert(stream, table, str(tmp_path / "c")).awaitTermination()
    assert [batch for _, batch in table._changes({})] == [0, 1, 2, 3, 4]
    whole = spark.createDataFrame(everything, schema)
    assert rows(table.read()) == rows(latest_per_key(whole, ["k"], ["seq"]))


def test_csv_header_and_chained_streams(spark, tmp_path):
    write_landing(spark.createDataFrame([("a", 1)], "k string, v int"), str(tmp_path / "in"), "csv")
    schema = spark.createDataFrame([], "k string, v string").schema
    stream = with_ingest_metadata(stream_csv(spark, str(tmp_path / "in"), schema, glob="*.csv"), "sys")
    append_stream(stream, str(tmp_path / "b"), str(tmp_path / "c1")).awaitTermination()
    again = stream_table(spark, str(tmp_path / "b")).select("k", "v", "_source_system")
    append_stream(again, str(tmp_path / "d"), str(tmp_path / "c2")).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "d")).collect()] == [("a", "1", "sys")]


def test_status_updates_are_seen_by_the_next_read(spark, tmp_path):
    schema = "sku string, store_id string, week date, status string, note string, updated_by string, updated_at timestamp, seq long"
    feed = str(tmp_path / "in")

    def send(*updates):
        data = [("a", "1", date(2025, 1, 6), status, None, "me", datetime(2025, 1, 7, hour), seq) for status, hour, seq in updates]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(feed)
        stream = stream_parquet(spark, feed, spark.createDataFrame([], schema).schema)
        return run_status(stream, str(tmp_path / "t"), str(tmp_path / "c"), ["updated_at", "seq"]).read()

    first = send(("acknowledged", 3, 1), (None, 9, 2))
    assert [(r.action_id, r.status) for r in first.collect()] == [("a::1::2025-01-06", "acknowledged")]
    assert set(STATUS_SCHEMA.names) <= set(first.columns)
    assert [r.status for r in send(("open", 1, 3)).collect()] == ["acknowledged"]  # older, arrives later
    assert [r.status for r in send(("resolved", 4, 4)).collect()] == ["resolved"]


def test_landing_values_are_text(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, date(2024, 1, 2))], "a int, b double, c date")
    write_landing(df, str(tmp_path / "p"))
    got = spark.read.parquet(str(tmp_path / "p"))
    assert {t for _, t in got.dtypes} == {"string"} and tuple(got.first()) == ("1", "2.5", "2024-01-02")
    with pytest.raises(ValueError):
        write_landing(df, str(tmp_path / "q"), "orc")


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    part = materialize(df, str(tmp_path / "m"), partition_by=["k"])
    assert part.columns == ["k", "v"] and part.where("k = 'a'").count() == 1
    assert overwrite_table(df, "gold_t").count() == 2
    assert overwrite_table(df.withColumn("w", F.lit(1)), "gold_t").columns == ["k", "v", "w"]
    with pytest.raises(ValueError, match="frozen"):
        overwrite_table(df, "gold_t", overwrite_schema=False)
    assert read_table(spark, "gold_t", "v").columns == ["v"]
    assert snapshot_sync(df, str(tmp_path / "s"), ["k"]).count() == 2
    with pytest.raises(ValueError, match="not unique"):
        snapshot_sync(df.union(df), str(tmp_path / "s2"), ["k"])


def test_two_checkpoints_and_a_reset_one_feed_one_table(spark, tmp_path, rows):
    schema = "k string, seq int, v int"
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k"], ["seq"])
    for number, data in enumerate([[("a", 1, 1)], [("a", 2, 9), ("b", 1, 5)], [("c", 1, 3)]]):
        folder = str(tmp_path / f"in{number}")
        spark.createDataFrame(data, schema).write.parquet(folder)
        stream = stream_parquet(spark, folder, spark.createDataFrame([], schema).schema)
        scd1_upsert(stream, table, str(tmp_path / f"c{number}")).awaitTermination()
    assert rows(table.read()) == [("a", 2, 9), ("b", 1, 5), ("c", 1, 3)]


def test_rule_counts_of_more_than_a_hundred_batches(spark, tmp_path, rows):
    """One landing file per micro-batch; Spark itself remembers the last hundred only."""
    place = Place(tmp_path)
    data = [(f"t{i}", "x" if i % 3 == 0 else "2", "1.0") for i in range(600)]
    sales(spark, *data).write.parquet(place.landing)
    run_bronze(spark, "transactions", place.landing, place.bronze, place.checkpoints[0])
    landed = spark.read.parquet(place.bronze).repartition(140, "transaction_id")
    landed.write.mode("overwrite").parquet(f"{tmp_path}/many")
    run_silver(spark, "transactions", f"{tmp_path}/many", place.silver, place.checkpoints[1], max_files=1)
    assert spark.read.parquet(f"{place.silver}/rules").select("_flow", "_batch").distinct().count() > 100
    failed = sum(quantity == "x" for _, quantity, _ in data)
    assert rows(rule_failures(spark, place.silver)) == [("valid_date", 0, 600), ("valid_quantity", failed, 600), ("valid_revenue", 0, 600)]


def test_a_replayed_batch_counts_once(spark, tmp_path, rows):
    batch = conform_transactions(sales(spark, ("t1", "0", "1.0"), ("t2", "1", "1.0")))
    for flow, number in (("a", 0), ("a", 0), ("b", 0), ("a", 1)):
        write_rule_counts(batch, "transactions", f"{tmp_path}/rules", flow, number)
    assert rows(rule_failures(spark, str(tmp_path)), "rule", "failed_rows", "total_rows")[1] == ("valid_quantity", 3, 6)


def test_landing_and_bronze_files_are_small(spark, tmp_path, monkeypatch):
    """One task writes several files, so that readers are not bound to its number of rows."""
    monkeypatch.setattr("demandflow.sinks.tables.ROWS_PER_FILE", 100)
    sales = spark.range(0, 950, 1, 1).select(*[F.col("id").cast("string").alias(c) for c in LANDING_SCHEMAS["transactions"].names])
    write_landing(sales, str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").glob("*.parquet"))) == 10
    run_bronze(spark, "transactions", str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "checkpoint"))
    found = list((tmp_path / "bronze").glob("*.parquet"))
    assert len(found) >= 10 and spark.read.parquet(str(tmp_path / "bronze")).count() == 950
