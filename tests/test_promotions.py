import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandflow.functions.calendar import snap_to_weeks
from demandflow.operators.promotions import (
    SPAN_DAYS, PromoSteps, daily_best_discount, discount_steps, explode_promos, measured, promo_phase_counts,
)
from demandflow.plans.features import add_promo_features, past_promos
from demandflow.plans.gold import fact_promotions

PROMO = (
    "target_sku string, target_category string, target_store_id string, target_region string, "
    "discount_pct double, promo_start_date date, promo_end_date date"
)
ROW = "sku string, store_id string, week date, region string, category string"
MONDAY = date(2025, 1, 6)


def promo(sku=None, category=None, store=None, region=None, discount=0.1, start=MONDAY, end=MONDAY):
    return (sku, category, store, region, discount, start, end)


def one_row(spark, week=MONDAY):
    return spark.createDataFrame([("S", "1", week, "R", "C")], ROW)


@pytest.mark.parametrize(
    "start, end, hit",
    [
        (MONDAY - timedelta(7), MONDAY, 1),  # ends on the Monday
        (MONDAY + timedelta(6), MONDAY + timedelta(20), 1),  # starts on the Sunday
        (MONDAY - timedelta(7), MONDAY - timedelta(1), 0),
        (MONDAY + timedelta(7), MONDAY + timedelta(9), 0),
        (MONDAY + timedelta(2), MONDAY + timedelta(3), 1),  # inside the week
        (MONDAY + timedelta(3), MONDAY + timedelta(2), 0),  # inverted: ignored, no error
        (MONDAY - timedelta(400), MONDAY + timedelta(400), 1),
    ],
)
def test_overlap_end_points(spark, start, end, hit):
    promos = spark.createDataFrame([promo(sku="S", store="1", start=start, end=end)], PROMO)
    assert add_promo_features(one_row(spark), promos).first().is_promoted == hit


def test_best_discount_one_row(spark):
    promos = spark.createDataFrame(
        [promo(sku="S", store="1", discount=0.1), promo(category="C", region="R", discount=0.3)], PROMO
    )
    out = add_promo_features(one_row(spark), promos).collect()
    assert [(r.discount_pct_feat, r.is_promoted) for r in out] == [(0.3, 1)]


def test_null_targets_match_nothing(spark):
    promos = spark.createDataFrame([promo(store="1"), promo(sku="S"), promo()], PROMO)
    out = add_promo_features(one_row(spark), promos).first()
    assert (out.discount_pct_feat, out.is_promoted) == (0.0, 0)


def test_no_promotions(spark):
    out = add_promo_features(one_row(spark), spark.createDataFrame([], PROMO)).first()
    assert (out.discount_pct_feat, out.is_promoted) == (0.0, 0)


@pytest.mark.parametrize("grain", ["week", "day"])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_equals_pair_by_pair_matching(spark, grain, broadcast):
    """Random rows and promotions, any mix of targets, against testing every pair; once with
    broadcast lookups and once with shuffled ones."""
    rng = random.Random(11)
    days = 7 if grain == "week" else 1

    def maybe(values):
        return rng.choice([None, rng.choice(values)])

    skus, stores, regions, categories = ["a", "b", "c"], ["1", "2", "3"], ["N", "S"], ["X", "Y"]
    promos, data = [], []
    for _ in range(60):
        start = MONDAY + timedelta(rng.randrange(60))
        promos.append((
            maybe(skus), maybe(categories), maybe(stores), maybe(regions), rng.randrange(1, 9) / 10,
            start, start + timedelta(rng.randrange(-2, 25)),
        ))
    for i in range(300):
        first = MONDAY + timedelta(7 * rng.randrange(9) if grain == "week" else rng.randrange(60))
        data.append((rng.choice(skus), rng.choice(stores), first, rng.choice(regions), rng.choice(categories)))
    data = sorted(set(data))

    def matches(row, p):
        sku, store, first, region, category = row
        in_time = p[6] >= p[5] and p[5] <= first + timedelta(days - 1) and p[6] >= first
        return in_time and (p[2] == store or p[3] == region) and (p[0] == sku or p[1] == category)

    want = sorted((*r, max([p[4] for p in promos if matches(r, p)], default=0.0)) for r in data)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows, offers = spark.createDataFrame(data, ROW), spark.createDataFrame(promos, PROMO)
        if grain == "week":
            out = add_promo_features(rows, offers)
            got = sorted(tuple(r) for r in out.select(*rows.columns, "discount_pct_feat").collect())
        else:
            out = daily_best_discount(rows, offers, "week")
            got = sorted(tuple(r) for r in out.select(*rows.columns, "discount_float").collect())
            assert all((r.is_promoted == 1) == (r.discount_float > 0) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert got == want
    assert sum(w[-1] > 0 for w in want) > 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_duplicate_rows_are_not_merged_or_multiplied(spark):
    row = ("S", "1", MONDAY, "R", "C")
    promos = spark.createDataFrame([promo(sku="S", store="1"), promo(sku="S", region="R")], PROMO)
    assert add_promo_features(spark.createDataFrame([row, row], ROW), promos).count() == 2


def test_state_flags_and_phases(spark):
    promos = spark.createDataFrame(
        [
            ("past", None, None, None, None, 0.1, "both", MONDAY - timedelta(9), MONDAY - timedelta(1)),
            ("last day", None, None, None, None, 0.1, "both", MONDAY - timedelta(9), MONDAY),
            ("first day", None, None, None, None, 0.1, "both", MONDAY, MONDAY + timedelta(3)),
            ("future", None, None, None, None, 0.1, "both", MONDAY + timedelta(1), MONDAY + timedelta(3)),
            ("no start", None, None, None, None, 0.1, "both", None, MONDAY + timedelta(3)),
        ],
        "promo_id string, target_sku string, target_category string, target_store_id string, target_region string, "
        "discount_pct double, channel string, promo_start_date date, promo_end_date date",
    )
    fact = fact_promotions(promos, F.lit(MONDAY))
    flags = {r.promo_id: (r.is_active, r.is_future) for r in fact.collect()}
    assert flags == {
        "past": (False, False), "last day": (True, False), "first day": (True, False), "future": (False, True),
        "no start": (None, None),
    }
    assert sorted(r.promo_id for r in past_promos(fact).collect()) == ["first day", "last day", "past"]
    assert tuple(promo_phase_counts(promos, F.lit(MONDAY)).first()) == (1, 2, 1)
    assert fact_promotions(promos).where("is_future").count() == 0  # today by default


def test_calendar_grains(spark):
    promos = spark.createDataFrame([promo(start=date(2025, 1, 8), end=date(2025, 1, 13))], PROMO)
    assert [r.period for r in explode_promos(promos, "week").collect()] == [date(2025, 1, 6), date(2025, 1, 13)]
    assert explode_promos(promos, "day").count() == 6
    with pytest.raises(ValueError):
        explode_promos(promos, "month")


def test_snap_to_weeks(spark):
    df = spark.createDataFrame([(date(2025, 1, 8), date(2025, 1, 12)), (MONDAY, MONDAY)], "a date, b date")
    assert [tuple(r) for r in snap_to_weeks(df, "a", "b").collect()] == [(MONDAY, date(2025, 1, 12))] * 2


def test_steps_are_disjoint_and_hold_the_best(spark):
    """A sweep by hand, day by day, over promotions that nest, touch, repeat and run for ages."""
    rng = random.Random(3)
    data = [promo(sku="S", store="1", discount=rng.randrange(1, 9) / 10, start=MONDAY + timedelta(s), end=MONDAY + timedelta(s + rng.randrange(40)))
            for s in (rng.randrange(150) for _ in range(40))]
    data += [promo(sku="S", store="1", discount=0.05, start=date(1800, 1, 1), end=date(9999, 12, 31)), data[0], data[0]]
    out = discount_steps(spark.createDataFrame(data, PROMO)).collect()
    steps = sorted((s.first, s.last, s.discount_pct) for r in out for s in r.steps)
    assert all(a[1] < b[0] for a, b in zip(steps, steps[1:])) and all(a <= b for a, b, _ in steps)
    assert all(len(r.steps) <= SPAN_DAYS for r in out)
    for k in range(-10, 220):
        day = MONDAY + timedelta(k)
        want = max(p[4] for p in data if p[5] <= day <= p[6])
        assert [d for a, b, d in steps if a <= day <= b] == [want]


def test_many_long_promotions_leave_the_map_side_as_few_intervals(spark):
    """600,000 promotions of eight weeks, a third of them on one product and store."""
    offers = spark.range(600_000).selectExpr(
        "IF(id % 3 = 0, 'S', concat('S', id % 200)) AS target_sku", "CAST(NULL AS STRING) AS target_category",
        "IF(id % 3 = 0, '1', CAST(id % 50 AS STRING)) AS target_store_id", "CAST(NULL AS STRING) AS target_region",
        "(id % 90 + 1) / 100D AS discount_pct", "date_add(DATE'2025-01-06', CAST(id % 364 AS INT)) AS promo_start_date",
        "date_add(DATE'2025-01-06', CAST(id % 364 AS INT) + 55) AS promo_end_date",
    )
    day = spark.createDataFrame([("S", "1", MONDAY, "R", "C")] * 500, ROW)
    out = daily_best_discount(day, offers, "week")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan.split("SortMergeJoin", 1)[1] and plan.count("SortMergeJoin") >= 4
    assert {(r.discount_float, r.is_promoted) for r in out.collect()} == {(0.85, 1)} and out.count() == 500
    hot = discount_steps(offers).where("item = 'S' AND scope = '1'")
    assert hot.count() <= 6 and hot.selectExpr("max(size(steps))").first()[0] <= SPAN_DAYS
    assert "partial_max" in hot._jdf.queryExecution().executedPlan().toString()


def test_measured_steps_are_broadcast_and_give_the_same(spark, tmp_path, rows):
    offers = spark.createDataFrame([promo(sku="S", store="1", discount=0.2), promo(category="C", region="R", discount=0.4)], PROMO)
    steps = discount_steps(offers)
    steps.write.parquet(str(tmp_path / "steps"))
    small = measured(spark.read.parquet(str(tmp_path / "steps")))
    assert small.small
    got = add_promo_features(one_row(spark), small)
    assert rows(got) == rows(add_promo_features(one_row(spark), offers))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan


def test_steps_of_regions_are_broadcast_when_those_of_stores_are_too_many(spark, rows):
    """Stores' steps too many to broadcast: only their two lookups sort."""
    offers = spark.createDataFrame([promo(sku="S", store="1", discount=0.2), promo(category="C", region="R", discount=0.4)], PROMO)
    all_rows = discount_steps(offers)
    got = add_promo_features(one_row(spark), PromoSteps(all_rows, False, True))
    assert rows(got) == rows(add_promo_features(one_row(spark), PromoSteps(all_rows, True)))
    assert got.first().discount_pct_feat == 0.4
    executed = got._jdf.queryExecution().sparkPlan().toString()
    assert executed.count("BroadcastHashJoin") == 2 and executed.count("SortMergeJoin") == 2
