import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandflow.operators import series
from demandflow.operators.promotions import PromoSteps, discount_steps, lookup_discounts
from demandflow.plans import features, forecast, gold
from demandflow.plans.actions import action_list
from demandflow.schemas import FEATURE_COLUMNS, KEYS, assert_unique

MONDAY = date(2024, 1, 1)
LAST_MONDAY = MONDAY + timedelta(7 * 29)
TODAY = LAST_MONDAY + timedelta(7)


@pytest.fixture(scope="module")
def world(spark):
    """20 series over 30 weeks, some with gaps and two too short, and promotions of every kind."""
    rng = random.Random(5)
    skus = [(f"EL-00{i}", f"p{i}", "Electronics" if i < 3 else "Home") for i in range(1, 6)]
    stores = [(f"100{i}", f"s{i}", "North" if i < 3 else "South") for i in range(1, 5)]
    sales = []
    for sku, _, _ in skus:
        for store, _, _ in stores:
            short = (sku, store) in {("EL-001", "1001"), ("EL-002", "1002")}
            for week in range(30):
                if (short and week > 5) or (not short and week < 29 and rng.random() < 0.15):
                    continue
                for _ in range(rng.randrange(1, 4)):
                    day = MONDAY + timedelta(7 * week + (0 if week == 29 else rng.randrange(7)))
                    sales.append((sku, store, day, rng.randrange(1, 9)))
    promos = []
    for i in range(40):
        start = MONDAY + timedelta(rng.randrange(270))
        promos.append((
            f"P{i}",
            *rng.choice([(rng.choice(skus)[0], None), (None, rng.choice(["Electronics", "Home"]))]),
            *rng.choice([(rng.choice(stores)[0], None), (None, rng.choice(["North", "South"]))]),
            rng.choice([0.1, 0.2, 0.4]), "both", start, start + timedelta(rng.randrange(30)),
        ))
    made = {
        "fact": spark.createDataFrame(sales, "sku string, store_id string, date_id date, quantity_sold int"),
        "products": spark.createDataFrame(skus, "sku string, product_name string, category string"),
        "stores": spark.createDataFrame(stores, "store_id string, store_name string, region string"),
        "promos": gold.fact_promotions(
            spark.createDataFrame(
                promos,
                "promo_id string, target_sku string, target_category string, target_store_id string, "
                "target_region string, discount_pct double, channel string, promo_start_date date, promo_end_date date",
            ),
            F.lit(TODAY),
        ),
    }
    made["weekly"] = series.weekly_demand(made["fact"])
    return made


def build(world, rows):
    return features.build_features(world["weekly"], world["promos"], world["stores"], world["products"], rows)


def collect(df):
    return sorted(tuple(r) for r in df.select(*FEATURE_COLUMNS).collect())


def test_one_pass_is_history_plus_future(world):
    history, future, both = (collect(build(world, r)) for r in ("history", "future", "all"))
    assert sorted(history + future) == both
    assert len(future) == 18 * 8 and len({r[:2] for r in history}) == 18


def test_keys_are_unique_and_forecast_weeks_follow(world):
    both = assert_unique(build(world, "all"), KEYS["features"])
    assert both.columns == FEATURE_COLUMNS
    weeks = sorted({r.week for r in build(world, "future").collect()})
    assert weeks == [LAST_MONDAY + timedelta(7 * i) for i in range(1, 9)]


def test_history_against_the_promotion_operator(world):
    """The two-sided lookup gives what past promotions alone and all promotions alone give."""
    described = world["weekly"].join(world["stores"], "store_id").join(world["products"], "sku")
    past = features.add_promo_features(described, features.past_promos(world["promos"]))
    want = {(r.sku, r.store_id, r.week): r.discount_pct_feat for r in past.collect()}
    history = build(world, "history").collect()
    assert all(want[r.sku, r.store_id, r.week] == r.discount_pct_feat for r in history)
    assert all((r.is_promoted == 1) == (r.discount_pct_feat > 0) for r in history)
    assert any(r.is_promoted for r in build(world, "future").collect())


def test_forecast_rows_carry_the_last_history_row(world):
    last = {}
    for r in build(world, "history").collect():
        key = (r.sku, r.store_id)
        if key not in last or r.week > last[key].week:
            last[key] = r
    for r in build(world, "future").collect():
        carried = last[r.sku, r.store_id]
        assert (r.rolling_4wk_avg, r.avg_demand_last_12w) == (carried.rolling_4wk_avg, carried.avg_demand_last_12w)


def test_score_keys_are_the_future_feature_keys(world):
    keys = series.add_forecast_weeks(series.valid_pairs(world["weekly"]), world["weekly"])
    future = build(world, "future")
    assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, future.select(*keys.columns).collect()))
    looked_up = forecast.lookup_for_scoring(keys, build(world, "all"))
    assert collect(looked_up) == collect(future)


def test_unknown_store_or_product_is_left_out(world):
    known = world["stores"].where("store_id <> '1003'")
    out = features.build_features(world["weekly"], world["promos"], known, world["products"], "all")
    assert out.where("store_id = '1003'").count() == 0 and out.count() > 0


def test_forecast_and_action_list_invariants(world):
    predicted = forecast.score(build(world, "future"), forecast.uplift_predictor, "m1").cache()
    assert predicted.count() == 18 * 8
    assert predicted.where("is_stockout_risk AND is_overstock_risk").count() == 0
    actions = action_list(predicted, world["stores"], world["products"]).collect()
    assert len(actions) == predicted.where("is_stockout_risk OR is_overstock_risk").count() > 0
    assert {a.risk_type for a in actions} <= {"Stockout", "Overstock"}
    predicted.unpersist()


def test_merge_keeps_rows_of_earlier_runs(world, spark):
    first = build(world, "all")
    later = first.where("week > '2024-03-01'").withColumn("rolling_4wk_avg", F.lit(-1.0))
    merged = features.upsert_features(first, later)
    assert merged.count() == first.count()
    assert merged.where("rolling_4wk_avg = -1").count() == later.count()
    assert features.upsert_features(None, first) is first


def test_runs_are_merged_on_disk(world, spark, tmp_path):
    path = str(tmp_path / "features")
    first = build(world, "all")
    again = first.where("week > '2024-03-01' AND sku <> 'EL-003'").withColumn("rolling_4wk_avg", F.lit(-1.0))
    assert collect(features.merge_features(path, first)) == collect(first)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "features").rglob("week=2024-02-*/*.parquet")}
    merged = features.merge_features(path, again)
    assert collect(merged) == collect(features.upsert_features(first, again))
    assert untouched and untouched == {f: f.stat().st_mtime_ns for f in (tmp_path / "features").rglob("week=2024-02-*/*.parquet")}
    assert_unique(merged, KEYS["features"])
    assert collect(features.merge_features(path, again.limit(0))) == collect(merged)


def test_holdout_split_and_training_set(world):
    labels = features.labels(world["weekly"], series.valid_pairs(world["weekly"]))
    split = forecast.holdout_split(labels)
    weeks = sorted({r.week for r in split.where("part = 'test'").collect()})
    assert len(weeks) == 8 and max(r.week for r in split.where("part = 'train'").collect()) < weeks[0]
    known = forecast.training_set(split, build(world, "all"))
    assert known.count() == labels.count() and known.where("rolling_4wk_avg IS NULL").count() == 0
    later = labels.withColumn("week", F.date_add("week", 3))  # between two feature rows: the earlier one
    assert forecast.training_set(later, build(world, "all")).where("rolling_4wk_avg IS NULL").count() == 0


def test_no_sales_no_promotions(world, spark):
    none = spark.createDataFrame([], world["weekly"].schema)
    empty = features.build_features(none, world["promos"], world["stores"], world["products"])
    assert empty.count() == 0 and empty.columns == FEATURE_COLUMNS
    no_promos = world["promos"].limit(0)
    out = features.build_features(world["weekly"], no_promos, world["stores"], world["products"])
    assert out.where("discount_pct_feat <> 0 OR is_promoted <> 0").count() == 0 and out.count() > 0


def test_plan_has_two_weekly_shuffles_and_no_pairs(world, spark):
    """Sales are shuffled by series and week, then by series; lookups are equality joins."""
    plan = build(world, "all")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("rows", ["history", "future", "all"])
def test_same_result_without_any_broadcast(world, spark, rows):
    want = collect(build(world, rows))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert collect(build(world, rows)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_last_rows_equal_those_of_all_averages(spark, world, rows):
    """Without an average for every row: the last row of a series is numbered from the end."""
    weekly = world["weekly"]
    columns = ["sku", "store_id", "week", "rolling_4wk_avg", "avg_demand_last_12w"]
    for least in (1, 12, 25):
        want = rows(series.valid_series(weekly, least).where("is_last"), *columns)
        assert rows(series.last_valid_rows(weekly, least), *columns) == want != []
    plan = series.last_valid_rows(weekly)._jdf.queryExecution().executedPlan().toString()
    assert "row_number()" in plan and "avg(total_quantity" not in plan


def test_forecast_weeks_are_looked_up_before_they_are_multiplied(world, rows):
    future = build(world, "future")
    end = world["weekly"].agg(F.max("week")).first()[0]
    assert rows(future) == rows(build(world, "all").where(F.col("week") > F.lit(end))) != []
    # only what leads to the answer is multiplied: the plan reads from the top, joins with the steps come below
    plan = future._jdf.queryExecution().optimizedPlan().toString()
    rows_side = plan.split("Join LeftOuter")[0]
    assert "explode(" in rows_side


def test_training_rows_are_the_labels_with_what_was_known(spark, world, rows):
    weekly = world["weekly"].unionByName(
        world["weekly"].where("sku = 'EL-003'").withColumn("store_id", F.lit("unknown")).distinct()
    ).unionByName(world["weekly"].where("sku = 'EL-003' AND store_id = '1003'").withColumn("store_id", F.lit(None).cast("string")))
    args = (world["promos"], world["stores"], world["products"])
    once = weekly.groupBy("sku", "store_id", "week").agg(F.sum("total_quantity").alias("total_quantity")).localCheckpoint()
    known = features.labels(once, series.valid_pairs(once))
    want = forecast.training_set(known, features.build_features(once, *args))
    got = features.labelled_history(once, *args)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    assert got.where("rolling_4wk_avg IS NULL").count() > 0 and got.where("is_promoted = 1").count() > 0
    cutoff = forecast.holdout_cutoff(got).first()["cutoff"]
    assert rows(forecast.holdout_split(got, cutoff=F.lit(cutoff))) == rows(forecast.holdout_split(want))


def test_training_rows_are_not_moved_again_to_meet_the_discounts_of_stores(spark, world, rows):
    """Products listed twice, in two categories or without one, a store without region, and steps of every size."""
    products = world["products"].unionByName(spark.createDataFrame(
        [("EL-001", "p", "Home"), ("EL-004", "p", "Home"), ("EL-005", "p", None), (None, "p", "Home")], world["products"].schema
    ))
    stores = world["stores"].where("store_id <> '1004'").unionByName(spark.createDataFrame([("1004", "s", None)], world["stores"].schema))
    steps = discount_steps(world["promos"], features.FEATURE_DISCOUNTS).localCheckpoint()
    weekly = world["weekly"].localCheckpoint()
    valid = series.valid_series(weekly).drop("is_last")
    described = valid.join(stores.select("store_id", "region"), "store_id", "left").join(products.select("sku", "category"), "sku", "left")
    want = rows(lookup_discounts(described, PromoSteps(steps), "week", 7, ["past_discount"]).select("sku", "store_id", "week", F.coalesce("past_discount", F.lit(0.0))))
    for sizes in ((False, False), (False, True), (True, True)):
        got = features.labelled_history(weekly, PromoSteps(steps, *sizes), stores, products)
        assert rows(got, "sku", "store_id", "week", "discount_pct_feat") == want
    # the one shuffle of the weekly rows is that of their series
    plan = features.labelled_history(weekly, PromoSteps(steps, False, True), stores, products)._jdf.queryExecution().executedPlan().toString()
    assert "__span" in plan and not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "__span" in line]


def test_last_rows_of_a_history_lead_to_the_same_forecast_weeks(spark, world, rows):
    weekly = world["weekly"].unionByName(world["weekly"].where("sku = 'EL-003'").withColumn("store_id", F.lit("unknown")).distinct())
    weekly = weekly.groupBy("sku", "store_id", "week").agg(F.sum("total_quantity").alias("total_quantity")).localCheckpoint()
    twice = world["products"].unionByName(world["products"].where("sku = 'EL-002'"))
    args = (world["promos"], world["stores"], twice)
    last = series.last_known_rows(features.labelled_history(weekly, *args).localCheckpoint())
    got = features.build_features(weekly, *args, "future", last=last)
    assert rows(got) == rows(features.build_features(weekly, *args, "future")) != []
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan and "Window" not in plan
