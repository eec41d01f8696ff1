from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandflow.operators import selection
from demandflow.operators.dimensions import checked_broadcast, fits_broadcast
from demandflow.operators.ranking import sample_rows, top_k_with_ties
from demandflow.plans import actions, bound, governance, questions, reports, summaries
from demandflow.operators.masking import register_mask_function
from demandflow.plans.gold import SALE_MONTH, fact_transactions, with_sale_month
from demandflow.sinks.tables import materialize, newest_partition

W1, W2, W3 = date(2025, 1, 6), date(2025, 1, 13), date(2025, 1, 20)
FORECAST = (
    "sku string, store_id string, week date, predicted_demand int, avg_demand_last_12w double, "
    "is_stockout_risk boolean, is_overstock_risk boolean, model_version string"
)


@pytest.fixture
def forecast(spark):
    return spark.createDataFrame(
        [
            ("a", "1", W1, 20, 10.04, True, False, "m"), ("b", "1", W1, 1, 10.0, False, True, "m"),
            ("a", "2", W1, 10, 10.0, False, False, "m"), ("a", "1", W2, 20, 10.0, True, False, "m"),
            ("a", "2", W2, 21, 10.0, True, False, "m"), ("b", "2", W2, 2, 10.0, False, True, "m"),
        ],
        FORECAST,
    )


@pytest.fixture
def stores(spark):
    return spark.createDataFrame([("1", "One", "N"), ("2", "Two", "S")], "store_id string, store_name string, region string")


@pytest.fixture
def products(spark):
    return spark.createDataFrame([("a", "A", "X", 2.0), ("b", "B", "Y", 3.0)], "sku string, product_name string, category string, unit_price double")


def test_risk_summary_uses_the_furthest_week(forecast):
    assert tuple(reports.risk_summary(forecast).first()) == (2, 1)
    assert tuple(reports.risk_summary(forecast.limit(0)).first()) == (0, 0)


def test_risk_detail_and_widgets(forecast, stores, products, rows):
    detail = reports.risk_detail(forecast, stores, products)
    assert rows(detail, "store_id", "sku", "risk_type") == [
        ("1", "a", "Stockout"), ("2", "a", "Stockout"), ("2", "b", "Overstock"),
    ]
    assert rows(reports.risk_by(detail, "region")) == [("Overstock", "S", 1), ("Stockout", "N", 1), ("Stockout", "S", 1)]
    assert reports.risk_total(detail).first()[0] == 3


def test_dashboard_week_and_order(forecast, stores, products):
    got = reports.risk_dashboard(forecast, stores, products, "2025-01-06").collect()
    assert [(r.sku, r.avg_demand_last_12w) for r in got] == [("a", 10.0), ("b", 10.0)]
    assert reports.risk_dashboard(forecast, stores, products, "__none__").count() == 0


def test_null_flags_follow_three_valued_logic(spark, stores, products):
    df = spark.createDataFrame(
        [("a", "1", W1, 1, 1.0, None, True, "m"), ("b", "1", W1, 1, 1.0, None, False, "m")], FORECAST
    )
    assert reports.week_options(df).count() == 1
    assert [r.sku for r in reports.risk_detail(df, stores, products).collect()] == ["a"]


def test_week_selectors(forecast):
    def weeks(df):
        return sorted({r.week for r in df.collect()})

    assert weeks(selection.latest_week(forecast)) == [W2] and weeks(selection.earliest_week(forecast)) == [W1]
    thursday = F.lit(W1 + timedelta(3))
    assert weeks(selection.this_week(forecast, thursday)) == [W1]
    assert weeks(selection.next_week(forecast, thursday)) == [W2]
    # the week after has no rows: first week from that day on, or nothing
    assert weeks(selection.next_week(forecast, F.lit(W1 - timedelta(20)))) == [W1]
    assert weeks(selection.next_week(forecast, F.lit(W3))) == []
    assert weeks(selection.next_n_weeks(forecast, F.lit(W1 - timedelta(3)), 1)) == [W1]
    assert weeks(selection.next_n_weeks(forecast, F.lit(W1 - timedelta(3)), 2)) == [W1, W2]


def test_options_and_filters(forecast, stores, products, rows):
    assert [r[0] for r in reports.week_options(forecast).collect()] == [W1, W2]
    options = reports.explorer_options(forecast, stores, products).collect()
    assert [(r.store_name, r.sku) for r in options] == [("One", "a"), ("One", "b"), ("Two", "a"), ("Two", "b")]
    assert selection.multi_filter(forecast, sku="a", store_id="all").count() == 4
    assert rows(selection.option_lists(forecast, ["sku", "store_id"])) == [
        ("sku", "a"), ("sku", "b"), ("store_id", "1"), ("store_id", "2"),
    ]


FACT = "transaction_id string, sku string, store_id string, date_id date, quantity_sold int, total_revenue double, is_promoted int"


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [
            ("1", "a", "1", W1 - timedelta(100), 1, 2.0, 0), ("2", "a", "1", W1 - timedelta(84), 2, 4.0, 1),
            ("3", "a", "1", W1 - timedelta(1), 3, 6.0, 1), ("4", "a", "1", W1, 4, 8.0, 0), ("5", "b", "2", W1, 5, 15.0, 0),
        ],
        FACT,
    )


def test_explorer_cut_is_not_aligned_to_weeks(fact, forecast, stores, products):
    explorer = reports.forecast_explorer(fact, forecast, stores, products, "One", "a")
    got = [(r.week.date(), r.actual_demand, r.predicted_demand) for r in explorer.collect()]
    assert [g[0] for g in got] == sorted(g[0] for g in got)
    assert set(got) == {
        (W1 - timedelta(84), 2.0, None), (W1 - timedelta(7), 3.0, None), (W1, 4.0, None),
        (W1, None, 20.0), (W2, None, 20.0),
    }
    head = reports.explorer_headline(explorer).first()
    assert (head.forecast_week, head.predicted_demand, head.is_stockout_risk) == ("2025-01-06", 20.0, True)
    assert reports.forecast_explorer(fact, forecast, stores, products, "__none__", "a").count() == 0


def test_promo_lift_equals_two_branches(fact, products, rows):
    branches = [
        fact.where(f"is_promoted = {flag}").join(products, "sku").groupBy("category")
        .agg(F.avg("quantity_sold").alias("avg_qty")).select("category", F.lit(name).alias("promo_type"), "avg_qty")
        for flag, name in ((1, "Promoted"), (0, "Baseline"))
    ]
    assert rows(reports.promo_lift(fact, products)) == rows(branches[0].union(branches[1]))


def test_revenue_reports(fact, stores, products, rows):
    assert rows(reports.category_revenue(fact, products)) == [("X", 20.0), ("Y", 15.0)]
    assert rows(reports.weekly_revenue(fact, stores).where(F.col("week_start") == W1)) == [(W1, "N", 8.0), (W1, "S", 15.0)]
    assert rows(questions.category_revenue_weekly(fact, products).where(F.col("week_start") == W1)) == [
        (W1, "X", 8.0), (W1, "Y", 15.0),
    ]


def test_ties_with_the_last_place_stay(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1), ("e", None)], "k string, n int")
    assert rows(top_k_with_ties(df, 2, "n")) == [("a", 5), ("b", 3), ("c", 3)]
    assert top_k_with_ties(df, 9, "n").count() == 4 and top_k_with_ties(df.limit(0), 2, "n").count() == 0
    assert [r.k for r in sample_rows(df, 2, ["k"]).collect()] == ["a", "b"]


def test_top_stores(forecast, stores, rows):
    assert rows(reports.top_stores_stockout(forecast, stores, 1)) == [("1", "One", 2)]
    assert rows(questions.top_stores_at_risk(forecast, stores)) == [("1", "One", 1), ("2", "Two", 2)]


def test_questions(forecast, fact, stores, products, rows):
    day = F.lit(W1)
    assert rows(questions.forecast_by_region(forecast, stores, day)) == [("N", 21), ("S", 10)]
    assert rows(questions.top_products_forecast(forecast, products, day, 1)) == [("a", "A", 30)]
    assert rows(questions.risk_pairs_by_category(forecast, products)) == [("X", 2, 0), ("Y", 0, 1)]
    assert rows(questions.stores_stockout_next_week(forecast, stores, day)) == [(W2, "1", "One", 1), (W2, "2", "Two", 1)]


def status(spark, *data):
    rows = [("a", store, week, state, None, "me", datetime(2025, 1, 7, hour), hour) for store, week, state, hour in data]
    return spark.createDataFrame(
        rows, "sku string, store_id string, week date, status string, note string, updated_by string, updated_at timestamp, seq long"
    )


ORDER = ["updated_at", "seq"]


def test_status_upsert(spark, rows):
    first = actions.upsert_status(None, status(spark, ("1", W1, "open", 1), ("1", W1, "resolved", 3), ("1", None, "open", 4), ("1", W2, None, 5), ("", W2, "open", 5)), ORDER)
    assert rows(first, "action_id", "status") == [("a::1::2025-01-06", "resolved")]
    second = actions.upsert_status(first, status(spark, ("1", W1, "open", 9), ("2", W1, "acknowledged", 9)), ORDER)
    assert rows(second, "action_id", "status") == [("a::1::2025-01-06", "open"), ("a::2::2025-01-06", "acknowledged")]


def test_action_list_and_queue(spark, forecast, stores, products):
    listed = actions.action_list(forecast, stores, products)
    first = listed.where("sku = 'a' AND store_id = '1' AND week = '2025-01-06'").first()
    assert (first.risk_type, first.demand_delta, first.avg_demand_last_12w) == ("Stockout", 10, 10.0)
    current = actions.upsert_status(None, status(spark, ("1", W1, "resolved", 1)), ORDER)
    queue = actions.action_queue(listed, current).collect()
    assert [(r.sku, r.risk_type, r.status) for r in queue] == [("a", "Stockout", "resolved"), ("b", "Overstock", "open")]
    assert tuple(actions.queue_counts(actions.action_queue(listed, current)).first()) == (1, 1, 0)
    assert actions.action_queue(listed, current, k=1).count() == 1


def test_run_summary_and_counts(forecast, fact, rows):
    weekly = fact.select("sku", "store_id", F.lit(W1).alias("week"), F.lit(1).alias("total_quantity"))
    got = summaries.run_summary(weekly, weekly, forecast).first()
    assert tuple(got) == (5, W1, 6, 5, "2025-01-06,2025-01-13")
    assert rows(summaries.layer_counts({("gold", "a"): fact, ("gold", "b"): forecast})) == [("gold", "a", 5), ("gold", "b", 6)]


def test_broadcast_only_for_measured_small_tables(spark):
    small, large = spark.range(10), spark.range(10_000)
    assert fits_broadcast(small, max_rows=10) and not fits_broadcast(large, max_rows=10)
    assert not fits_broadcast(small, max_bytes=20)
    assert checked_broadcast(large, max_rows=10) is large
    assert fits_broadcast(small.limit(0))


def test_mask_and_what_follows_from_it(spark, products):
    sales = spark.createDataFrame(
        [("1", "a", "1", W1, 3, 1.5)],
        "transaction_id string, sku string, store_id string, transaction_date date, quantity_sold int, unit_price_at_sale double",
    )
    seen = [fact_transactions(governance.masked_transactions(sales, m), products).first() for m in (True, False)]
    assert (seen[0].unit_price_at_sale, seen[0].total_revenue, seen[0].is_promoted) == (1.5, 4.5, 1)
    assert (seen[1].unit_price_at_sale, seen[1].total_revenue, seen[1].is_promoted) == (None, None, 0)
    register_mask_function(spark)
    assert tuple(spark.sql("SELECT mask_financial(2D, true), mask_financial(2D, false)").first()) == (2.0, None)


def test_tags(spark):
    rows = [("g", "b", None, "layer", "x"), ("g", "b", "c", "layer", "x"), ("g", "a", None, "layer", "y"), ("g", "a", None, "owner", "z")]
    tags = spark.createDataFrame(rows, "schema_name string, table_name string, column_name string, tag_name string, tag_value string")
    assert [tuple(r) for r in governance.tag_report(tags, ("layer",)).collect()] == [("g", "a", "layer", "y"), ("g", "b", "layer", "x")]


@pytest.fixture
def on_disk(spark, tmp_path):
    """A year of sales by month and a forecast of three weeks, as tables."""
    days = spark.range(366 * 4).selectExpr(
        "concat('t', id) AS transaction_id", "IF(id % 2 = 0, 'a', 'b') AS sku", "IF(id % 4 < 2, '1', '2') AS store_id",
        "date_add(DATE'2024-01-01', CAST(id / 4 AS INT)) AS date_id", "CAST(id % 5 AS INT) AS quantity_sold",
    )
    fact = materialize(with_sale_month(days), str(tmp_path / "fact"), [SALE_MONTH], sort_by=["store_id", "sku"])
    ahead = spark.createDataFrame(
        [(sku, store, week, 5, 4.0, sku == "a", sku == "b", "m") for sku in "ab" for store in "12" for week in (W1, W2, W3)], FORECAST
    )
    return fact, materialize(ahead, str(tmp_path / "forecast"), ["week"]), str(tmp_path)


def scans(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]


def test_explorer_reads_the_months_in_reach(spark, on_disk, stores, products):
    fact, forecast, folder = on_disk
    newest = newest_partition(spark, f"{folder}/fact", SALE_MONTH)
    assert newest == "2024-12-01"
    pruned = reports.forecast_explorer(fact, forecast, stores, products, "One", "a", newest_month=newest)
    whole = reports.forecast_explorer(fact.drop(SALE_MONTH), forecast, stores, products, "One", "a")
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, whole.collect()))
    of_sales = [line for line in scans(pruned) if "date_id" in line]
    assert of_sales and all("sale_month#" in line.split("PartitionFilters", 1)[1] for line in of_sales)
    assert any("EqualTo(sku,a)" in line for line in of_sales)


def test_risk_summary_reads_one_week(spark, on_disk):
    _, forecast, folder = on_disk
    week = newest_partition(spark, f"{folder}/forecast", "week")
    assert week == str(W3) and newest_partition(spark, f"{folder}/nothing", "week") is None
    one = reports.risk_summary(forecast, week)
    assert tuple(one.first()) == tuple(reports.risk_summary(forecast).first()) == (2, 2)
    assert all("2025-01-20" in line or "20108" in line for line in scans(one)) and len(scans(one)) >= 1


def test_bind_parameters_give_the_reports(spark, on_disk, stores, products):
    fact, forecast, folder = on_disk
    tables = dict(forecast=forecast, stores=stores, products=products)
    same = reports.risk_dashboard(forecast, stores, products, str(W2))
    assert list(map(tuple, bound.risk_dashboard(spark, tables, week=str(W2)).collect())) == list(map(tuple, same.collect()))
    assert bound.risk_dashboard(spark, tables).count() == 0
    assert bound.risk_dashboard(spark, tables, week="2025-01-13' OR '1' = '1").count() == 0
    newest = newest_partition(spark, f"{folder}/fact", SALE_MONTH)
    tables["fact"] = fact
    found = bound.forecast_explorer(spark, tables, store_name="One", sku="a", newest_month=newest)
    want = reports.forecast_explorer(fact, forecast, stores, products, "One", "a", newest_month=newest)
    assert list(map(tuple, found.orderBy("week", "actual_demand").collect())) == list(map(tuple, want.orderBy("week", "actual_demand").collect()))
    assert all("sale_month#" in line.split("PartitionFilters", 1)[1] for line in scans(found) if "date_id" in line)
    assert bound.forecast_explorer(spark, tables, store_name="One", newest_month=newest).count() == 0
    assert bound.forecast_explorer(spark, tables, store_name="One' --", sku="a", newest_month=newest).count() == 0
