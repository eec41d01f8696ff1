from datetime import date

import pytest
from pyspark.sql import functions as F

from demandflow.functions.measures import discounted_price, sum_money, whole_units
from demandflow.plans import forecast, gold, model
from demandflow.sources.generated import date_range

WEEK = date(2025, 1, 6)
FEATURES = (
    "sku string, store_id string, week date, week_of_year int, is_promoted int, discount_pct_feat double, "
    "rolling_4wk_avg double, avg_demand_last_12w double"
)


def scored(spark, *pairs):
    """Forecast rows for (raw prediction, 12-week average) pairs."""
    data = [("a", str(i), WEEK, 2, 0, 0.0, float(raw), float(avg)) for i, (raw, avg) in enumerate(pairs)]
    rows = spark.createDataFrame(data, FEATURES)
    out = forecast.score(rows, lambda f: f.withColumn("prediction", F.col("rolling_4wk_avg")), "m1")
    return [
        (r.predicted_demand, r.is_stockout_risk, r.is_overstock_risk) for r in out.orderBy("store_id").collect()
    ]


def test_risk_flags_are_strict_and_need_history(spark):
    assert scored(spark, (14, 10), (13, 10), (7, 10), (6, 10), (9, 0)) == [
        (14, True, False), (13, False, False), (7, False, False), (6, False, True), (9, False, False),
    ]


def test_counts_are_rounded_half_up_and_not_negative(spark):
    df = spark.createDataFrame([(-0.4,), (2.5,), (2.4999,), (-7.0,), (3.5,)], "raw double")
    assert [r[0] for r in df.select(whole_units("raw")).collect()] == [0, 3, 2, 0, 4]
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS raw").select(whole_units("raw")).first()[0] is None


def test_uplift(spark):
    rows = spark.createDataFrame([("a", "1", WEEK, 2, 1, 0.5, 10.0, 10.0)], FEATURES)
    assert forecast.score(rows, forecast.uplift_predictor, "m").first().predicted_demand == 21


def test_money_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(1e9 + 0.07,)] * 7, "x double")
    sums = {df.repartition(n).agg(sum_money("x")).first()[0] for n in (1, 3, 8)}
    assert sums == {7000000100.49}


def test_discounted_price(spark):
    df = spark.createDataFrame([(10.0, 0.15), (10.0, 0.0)], "p double, d double")
    assert [r[0] for r in df.select(discounted_price("p", "d")).collect()] == [8.5, 10.0]


def test_fact_flags_and_unmatched_products(spark):
    sales = spark.createDataFrame(
        [("1", "a", "s", WEEK, 3, 1.25), ("2", "a", "s", WEEK, 1, 2.0), ("3", "zz", "s", WEEK, 1, 1.0), ("4", "a", "s", WEEK, 1, None)],
        "transaction_id string, sku string, store_id string, transaction_date date, quantity_sold int, unit_price_at_sale double",
    )
    products = spark.createDataFrame([("a", 2.0)], "sku string, unit_price double")
    fact = {r.transaction_id: (r.total_revenue, r.is_promoted) for r in gold.fact_transactions(sales, products).collect()}
    assert fact == {"1": (3.75, 1), "2": (2.0, 0), "3": (1.0, 0), "4": (None, 0)}


def test_date_ranges(spark):
    assert date_range(spark, date(2024, 1, 1), date(2026, 12, 31)).count() == 1096
    fact = spark.createDataFrame([(date(2024, 2, 28),), (date(2024, 3, 1),)], "date_id date")
    assert gold.dim_date(fact).count() == 366


@pytest.fixture(scope="module")
def training(spark):
    """Counts that grow with the average and double on promotion."""
    base = spark.range(4000).select(
        F.concat(F.lit("s"), F.col("id") % 20).alias("sku"), F.lit("1").alias("store_id"),
        F.date_add(F.lit(date(2023, 1, 2)), (F.floor(F.col("id") / 20) % 104 * 7).cast("int")).alias("week"),
        (F.col("id") % 20 + 5).cast("double").alias("rolling_4wk_avg"),
        (F.col("id") % 3 == 0).cast("int").alias("is_promoted"),
    )
    return base.select(
        "*", F.weekofyear("week").alias("week_of_year"), F.col("rolling_4wk_avg").alias("avg_demand_last_12w"),
        (F.col("is_promoted") * 0.2).alias("discount_pct_feat"),
        (F.col("rolling_4wk_avg") * (1 + F.col("is_promoted"))).cast("long").alias("total_quantity"),
        F.when(F.col("week") < F.lit(date(2024, 10, 1)), "train").otherwise("test").alias("part"),
    )


def test_rows_without_features_come_back_without_a_forecast(spark, training, tmp_path):
    holes = training.withColumn("rolling_4wk_avg", F.when(F.col("sku") != "s3", F.col("rolling_4wk_avg")))
    fitted = model.fit_demand_model(holes.where("part = 'train'"))
    model.save_coefficients(spark, str(tmp_path), model.coefficients(fitted))
    for predict in (model.glm_predictor(fitted), model.coefficient_predictor(model.load_coefficients(spark, str(tmp_path), 1), 1)):
        out = predict(holes)
        assert out.count() == training.count()
        assert out.where("prediction IS NULL").select("sku").distinct().collect() == [("s3",)]


def test_model_learns_promotions_and_can_be_saved(spark, training, tmp_path):
    fitted, errors = model.fit_and_evaluate(training, str(tmp_path))
    row = errors.first()
    assert row.beats_naive and row.mae_holdout < 0.2 * row.mae_naive_avg12w
    assert model.latest_version(spark, str(tmp_path)) == 0
    terms = model.coefficients(fitted)
    assert model.save_coefficients(spark, str(tmp_path), terms) == 1
    for version in (2, 11, 3):
        model.save_coefficients(spark, str(tmp_path), {**terms, "intercept": version}, version)
    assert model.latest_version(spark, str(tmp_path)) == 11
    assert model.load_coefficients(spark, str(tmp_path), 11).first().intercept == 11
    saved = model.coefficient_predictor(model.load_coefficients(spark, str(tmp_path), 1), 1)
    rows = training.where("part = 'test'")
    first, second = (forecast.score(rows, predict, model.model_name(1)) for predict in (model.glm_predictor(fitted), saved))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    assert first.first().model_version == "glm_poisson_v1"
    assert first.where("predicted_demand < 0").count() == 0


def test_trees_and_the_poisson_model_on_one_holdout(spark, training):
    train, test = training.where("part = 'train'"), training.where("part = 'test'")
    predictors = {
        "boosted_trees": model.trees_predictor(model.fit_trees(train, trees=5, depth=3)),
        "glm_poisson": model.glm_predictor(model.fit_demand_model(train)),
    }
    rows = {r.model: r for r in model.choose_model(predictors, train, test, test.limit(7)).collect()}
    assert {(r.train_rows, r.holdout_rows, r.scored_rows) for r in rows.values()} == {(train.count(), test.count(), 7)}
    best = min(rows, key=lambda m: rows[m].mae_holdout)
    assert [m for m in rows if rows[m].is_chosen] == [best]
    assert rows["boosted_trees"].mae_holdout < 5
    holes = training.withColumn("rolling_4wk_avg", F.when(F.col("sku") != "s3", F.col("rolling_4wk_avg")))
    assert predictors["boosted_trees"](holes).where("prediction IS NULL").select("sku").distinct().collect() == [("s3",)]


def test_trees_of_rows_put_together_are_those_of_all_rows(spark, training, monkeypatch):
    """Rows between the same split candidates are one row for the trees, however many there are."""
    train = training.where("part = 'train'").withColumn("total_quantity", F.col("total_quantity") + F.col("week_of_year") % 5)
    rows = train.unionByName(train.withColumn("total_quantity", F.col("total_quantity") * 3)).cache()
    given, fit = [], model.GBTRegressor.fit

    def counted(self, dataset, params=None):
        given.append(dataset.count())
        return fit(self, dataset, params)

    monkeypatch.setattr(model.GBTRegressor, "fit", counted)
    found = model.trees_predictor(model.fit_trees(rows, trees=5, depth=4))
    assert given[0] <= rows.select(*model.FEATURES).distinct().count() < rows.count()

    logs = model.SQLTransformer(statement="SELECT *, ln(1 + total_quantity) AS log_demand FROM __THIS__").transform(rows)
    vectors = model.VectorAssembler(inputCols=model.FEATURES, outputCol="inputs").transform(logs)
    every = fit(model.GBTRegressor(featuresCol="inputs", labelCol="log_demand", maxIter=5, maxDepth=4, stepSize=0.2, seed=17), vectors)
    # also for values between and beyond those of the rows, and for split candidates themselves
    asked = training.drop("prediction").withColumn("rolling_4wk_avg", F.explode(F.array(F.col("rolling_4wk_avg"), F.col("rolling_4wk_avg") + 0.5, F.lit(-1.0), F.lit(1e9))))
    want = model.VectorAssembler(inputCols=model.FEATURES, outputCol="inputs").transform(asked)
    want = every.transform(want).withColumn("want", F.greatest(F.lit(0.0), F.exp("prediction") - 1)).drop("prediction", "inputs")
    far = found(want).where("abs(prediction - want) > 1e-9 OR prediction IS NULL")
    assert far.count() == 0
