"""One key holding a third or more of the rows: results stay whole, with and without broadcasts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from demandflow.operators.asof import asof_lookup
from demandflow.operators.series import valid_pairs, weekly_demand
from demandflow.plans import questions, reports

ROWS = 60_000
FIRST = date(2024, 1, 1)


@pytest.fixture(scope="module")
def fact(spark):
    """Every third sale is the same product in the same store on the same day."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, ROWS, numPartitions=8).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(hot, "S0").otherwise(F.concat(F.lit("S"), F.col("id") % 7)).alias("sku"),
        F.when(hot, "1").otherwise((F.col("id") % 5 + 1).cast("string")).alias("store_id"),
        F.when(hot, F.lit(FIRST)).otherwise(F.date_add(F.lit(FIRST), (F.floor(F.col("id") / 35) % 140).cast("int"))).alias("date_id"),
        F.lit(2).alias("quantity_sold"), F.lit(1.1).alias("total_revenue"), F.lit(0).alias("is_promoted"),
    )


@pytest.fixture(params=["10485760", "-1"], ids=["broadcast", "shuffle"])
def joins(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_every_unit_is_counted(fact, joins):
    weekly = weekly_demand(fact)
    assert weekly.agg(F.sum("total_quantity")).first()[0] == 2 * ROWS
    assert valid_pairs(weekly).count() == 35


def test_every_sale_gets_its_features(spark, fact, joins):
    known = spark.createDataFrame([("S0", "1", FIRST, 7)], "sku string, store_id string, week date, v int")
    out = asof_lookup(fact, known, ["sku", "store_id"], "date_id", "week")
    assert out.count() == ROWS
    assert out.where("v = 7").count() == fact.where("sku = 'S0' AND store_id = '1'").count() > ROWS / 3


def test_reports_are_whole(spark, fact, joins):
    stores = spark.createDataFrame([(str(i), f"n{i}", "N") for i in range(1, 6)], "store_id string, store_name string, region string")
    products = spark.createDataFrame([(f"S{i}", f"p{i}", "C") for i in range(7)], "sku string, product_name string, category string")
    promos = spark.createDataFrame(
        [("S0", None, "1", None, 0.5, FIRST, FIRST)],
        "target_sku string, target_category string, target_store_id string, target_region string, discount_pct double, "
        "promo_start_date date, promo_end_date date",
    )
    total = reports.weekly_revenue(fact, stores).agg(F.sum("weekly_revenue")).first()[0]
    assert total == pytest.approx(1.1 * ROWS)
    by_discount = {r.discount_pct: r.sales for r in questions.discount_vs_quantity(fact, promos, stores, products).collect()}
    hot = fact.where((F.col("sku") == "S0") & (F.col("store_id") == "1") & (F.col("date_id") == F.lit(FIRST))).count()
    assert by_discount == {0.0: ROWS - hot, 0.5: hot} and hot >= ROWS / 3
