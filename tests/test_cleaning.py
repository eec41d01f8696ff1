from datetime import date

import pytest

from demandflow.operators.conform import (
    conform_products, conform_promotions, conform_stores, conform_transactions, split_scope, split_target,
)
from demandflow.operators.quality import RULES, expect_or_drop, rule_violations
from demandflow.plans.gold import typed_rows
from demandflow.schemas import LANDING_SCHEMAS, assert_unique, duplicate_keys


def sale(id, day="2024-03-04", qty="2", price="3.50"):
    return (id, "EL-001", "1001", day, qty, price)


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            sale("good"), sale("bad date", day="2024-13-01"), sale("loose date", day="2024-3-4"),
            sale("long date", day="2024-03-04 10:00:00"), sale("no such day", day="2024-02-30"),
            sale("bad qty", qty="x"), sale("null qty", qty=None), sale("zero qty", qty="0"),
            sale("fraction", qty="3.0"), sale("negative price", price="-1.00"), sale("no price", price=None),
        ],
        LANDING_SCHEMAS["transactions"],
    )


def test_transactions_are_typed_and_unreadable_text_is_null(sales):
    typed = {r.transaction_id: r for r in conform_transactions(sales).collect()}
    assert typed["good"].transaction_date == date(2024, 3, 4)
    assert typed["good"].quantity_sold == 2 and typed["good"].unit_price_at_sale == 3.5
    for bad in ("bad date", "loose date", "long date", "no such day"):
        assert typed[bad].transaction_date is None, bad
    assert typed["bad qty"].quantity_sold is None and typed["fraction"].quantity_sold is None


def test_rows_that_break_or_cannot_answer_a_rule_are_dropped(sales):
    assert [r.transaction_id for r in typed_rows("transactions", sales).collect()] == ["good"]


def test_violations_are_counted_per_rule(sales, rows):
    counted = rule_violations(conform_transactions(sales), RULES["transactions"])
    assert rows(counted) == [("valid_date", 4, 11), ("valid_quantity", 4, 11), ("valid_revenue", 2, 11)]


def test_observed_failures_match(spark, sales):
    from pyspark.sql import Observation

    seen = Observation("q")
    typed = conform_transactions(sales)
    kept = expect_or_drop(typed, RULES["transactions"], observe_as=seen)
    assert kept.count() == 1
    assert seen.get == {"rows": 11, "valid_quantity": 4, "valid_revenue": 2, "valid_date": 4}


def test_product_rule_is_strict_and_null_fails(spark):
    products = spark.createDataFrame(
        [("a", "n", "c", "s", cost, price) for cost, price in [("5.00", "5.00"), ("4.99", "5.00"), (None, "5.00")]],
        LANDING_SCHEMAS["products"],
    )
    assert [r.unit_cost for r in typed_rows("products", products).collect()] == [4.99]
    assert dict(conform_products(products).dtypes)["unit_price"] == "double"


def test_store_date(spark):
    stores = spark.createDataFrame([("1", "n", "r", "t", "m", "e", "p", "2015-01-31")], LANDING_SCHEMAS["stores"])
    assert conform_stores(stores).first().manager_since == date(2015, 1, 31)


def promo(id, target="EL-001", scope="store_1001", discount="20%", start="01/06/2025", end="01/12/2025"):
    return (id, target, scope, discount, "both", start, end)


def test_promotions_are_typed_and_checked(spark):
    promos = spark.createDataFrame(
        [
            promo("ok"), promo("zero", discount="0%"), promo("all", discount="100%"), promo("text", discount="x%"),
            promo("inverted", start="01/12/2025", end="01/06/2025"), promo("iso", start="2025-01-06"),
            promo("one day", start="01/06/2025", end="01/06/2025"),
        ],
        LANDING_SCHEMAS["promotions"],
    )
    typed = conform_promotions(promos)
    ok = typed.where("promo_id = 'ok'").first()
    assert (ok.discount_pct, ok.promo_start_date, ok.promo_end_date) == (0.2, date(2025, 1, 6), date(2025, 1, 12))
    assert "sku_or_category" not in typed.columns and "store_id_or_region" not in typed.columns
    assert sorted(r.promo_id for r in typed_rows("promotions", promos).collect()) == ["ok", "one day"]


def test_target_and_scope_split(spark, rows):
    promos = spark.createDataFrame(
        [
            promo("1", "EL-001", "store_1001"), promo("2", "Electronics", "North"), promo("3", "el-001", "Store_1"),
            promo("4", "ELX-001", "store_"), promo("5", None, None),
        ],
        LANDING_SCHEMAS["promotions"],
    )
    assert rows(split_target(promos), "promo_id", "target_sku", "target_category") == [
        ("1", "EL-001", None), ("2", None, "Electronics"), ("3", None, "el-001"), ("4", None, "ELX-001"),
        ("5", None, None),
    ]
    assert rows(split_scope(promos), "promo_id", "target_store_id", "target_region") == [
        ("1", "1001", None), ("2", None, "North"), ("3", None, "Store_1"), ("4", "", None), ("5", None, None),
    ]


def test_key_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    assert assert_unique(df, ["k", "v"]) is df
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(df, ["k"])
    with pytest.raises(ValueError, match="NULL"):
        assert_unique(spark.createDataFrame([(None,)], "k string"), ["k"])
