"""Every registered query: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.checks import fixtures as fx
from demandflow.checks.fixtures import FORECAST_AS_OF, PROMO_AS_OF, Retail, retail
from demandflow.functions.calendar import snap_to_weeks, week_start, with_date_parts
from demandflow.functions.measures import discounted_price
from demandflow.operators.asof import asof_lookup
from demandflow.operators.conform import CONFORM, conform_transactions, split_scope, split_target
from demandflow.operators.dimensions import with_region_and_category
from demandflow.operators.latest import latest_per_key
from demandflow.operators.promotions import daily_best_discount, explode_promos, promo_phase_counts
from demandflow.operators.quality import RULES, rule_violations
from demandflow.operators.ranking import sample_rows
from demandflow.operators.selection import (
    next_n_weeks, next_week, option_lists, this_week,
)
from demandflow.operators import series
from demandflow.plans import actions, bound, features, forecast, gold, governance, model
from demandflow.plans import questions, reports, summaries
from demandflow.schemas import KEYS, LANDING_SCHEMAS, SERIES, SOURCE_SYSTEMS
from demandflow.session import run_folder
from demandflow.sinks.keyed import KeyedTable
from demandflow.sinks.tables import append_stream, overwrite_table, snapshot_sync, write_landing
from demandflow.sources.landing import read_table, stream_table, with_ingest_metadata
from demandflow.streaming.flows import run_bronze, run_status, scd1_upsert

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the parameterised reports.
EXPLORER_STORE, EXPLORER_SKU = "Supplier#000000003", "BR-007"
DASHBOARD_WEEK = str(FORECAST_AS_OF)
QUEUE_FILTERS = {"region": "EUROPE", "store_name": "all", "category": "Apparel", "risk_type": "Stockout", "status": "all"}
# Coefficients of two saved versions of the demand model; the later one counts.
SAVED_MODELS = {
    1: dict(intercept=0.5, log_4wk=0.5, log_12wk=0.4, promoted=0.0, discount_pct_feat=0.0, season_sin=0.0, season_cos=0.0),
    2: dict(intercept=0.125, log_4wk=0.375, log_12wk=0.5625, promoted=0.0625, discount_pct_feat=1.75, season_sin=0.03125, season_cos=-0.0625),
}
QUEUE_OPTIONS = ["region", "store_name", "category", "risk_type", "status"]

_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    """Register a query under the function's name."""
    return named(build.__name__)(build)


def named(name: str) -> Callable:
    """Register a query under a name that is already taken in this module."""

    def register(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(retail(spark, sf_dir))

        _QUERIES[name] = run
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _file_name(col: str):
    return F.element_at(F.split(F.col(col), "/"), -1)


# ---------------------------------------------------------------- sources and sinks


@query
def ingest_metadata(r: Retail) -> DataFrame:
    named = with_ingest_metadata(r.given("lineitem"), SOURCE_SYSTEMS["transactions"])
    return named.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        _file_name("_source_file").alias("source_file"),
        F.col("_source_system").alias("source_system"),
        F.col("_ingested_at").isNotNull().alias("stamped"),
    )


@query
def ingest_stream_parquet(r: Retail) -> DataFrame:
    """Sales streamed from the line item file into an append-only bronze table."""
    folder = run_folder(r.spark, "bronze")
    raw = with_ingest_metadata(r.given_stream("lineitem"), SOURCE_SYSTEMS["transactions"])
    stamps = ["_source_file", "_ingested_at", "_source_system"]
    sales = fx.sale_rows(raw, r.given("part"), r.listed, keep=stamps)
    append_stream(sales, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return read_table(r.spark, f"{folder}/table").select(
        *LANDING_SCHEMAS["transactions"].names,
        _file_name("_source_file").alias("source_file"),
        F.col("_source_system").alias("source_system"),
    )


@query
def ingest_stream_csv(r: Retail) -> DataFrame:
    """Promotions written as CSV with a header, then streamed into bronze."""
    folder = run_folder(r.spark, "bronze")
    write_landing(r.landing("promotions"), f"{folder}/landing", "csv")
    run_bronze(r.spark, "promotions", f"{folder}/landing", f"{folder}/table", f"{folder}/checkpoint", glob="*.csv")
    return read_table(r.spark, f"{folder}/table", *LANDING_SCHEMAS["promotions"].names, "_source_system")


@query
def dim_date(r: Retail) -> DataFrame:
    return gold.dim_date(r.fact)


@query
def dim_product(r: Retail) -> DataFrame:
    return gold.dim_product(r.typed("products"))


@query
def dim_store(r: Retail) -> DataFrame:
    return gold.dim_store(r.typed("stores"))


@query
def feature_upsert(r: Retail) -> DataFrame:
    """An earlier run, made when the last 8 weeks were not known yet, merged with today's run.

    Forecast rows of the earlier run stay where the series had no sale in that week."""
    cutoff = F.date_sub(series.data_end(r.weekly).scalar(), 7 * series.HORIZON_WEEKS)
    earlier = features.build_features(
        r.weekly.where(F.col("week") <= cutoff), r.promo_steps, r.stores, r.products
    )
    return features.upsert_features(earlier, r.features)


@query
def feature_merge(r: Retail) -> DataFrame:
    """The earlier run and today's, one after the other into the feature table on disk."""
    path = f"{run_folder(r.spark, 'features')}/weekly_demand_features"
    cutoff = F.date_sub(series.data_end(r.weekly).scalar(), 7 * series.HORIZON_WEEKS)
    earlier = r.weekly.where(F.col("week") <= cutoff)
    features.merge_features(path, features.build_features(earlier, r.promo_steps, r.stores, r.products))
    return features.merge_features(path, r.features)


@query
def forecast_table(r: Retail) -> DataFrame:
    """The forecast as a catalog table, written twice; the second time its columns may not change."""
    folder = run_folder(r.spark, "catalog")
    name = f"forecast_demand_{folder[-12:]}"
    overwrite_table(r.forecast.limit(0), name, path=folder)
    return overwrite_table(r.forecast, name, overwrite_schema=False, path=folder)


@query
def bronze_stream_table(r: Retail) -> DataFrame:
    """The bronze sales streamed on into another table, row by row as they were delivered."""
    folder = run_folder(r.spark, "copy")
    r.silver_sales  # noqa: B018 - the runs that fill bronze
    append_stream(stream_table(r.spark, f"{r.folder}/bronze_transactions"), f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return read_table(r.spark, f"{folder}/table", *LANDING_SCHEMAS["transactions"].names, "_source_system")


@query
def action_list_snapshot(r: Retail) -> DataFrame:
    return snapshot_sync(r.actions, f"{run_folder(r.spark, 'snapshot')}/action_list", KEYS["actions"])


@query
def action_status_upsert(r: Retail) -> DataFrame:
    """Updates before one day as the table so far, then the later ones on top."""
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    before, after = r.status_feed.where(F.col("updated_at") < split), r.status_feed.where(F.col("updated_at") >= split)
    current = actions.upsert_status(None, before, fx.STATUS_ORDER)
    return actions.upsert_status(current, after, fx.STATUS_ORDER)


@query
def run_summary(r: Retail) -> DataFrame:
    return summaries.run_summary(r.weekly, r.features, r.forecast)


# ---------------------------------------------------------------- typing and rules


@named("conform_transactions")
def conform_transactions_query(r: Retail) -> DataFrame:
    return conform_transactions(fx.spoil(r.landing("transactions")))


@query
def conform_products(r: Retail) -> DataFrame:
    return CONFORM["products"](r.landing("products"))


@query
def conform_stores(r: Retail) -> DataFrame:
    return CONFORM["stores"](r.landing("stores"))


@query
def conform_promotions(r: Retail) -> DataFrame:
    return CONFORM["promotions"](r.landing("promotions"))


@query
def split_promo_target(r: Retail) -> DataFrame:
    return split_target(r.landing("promotions")).select(
        "promo_id", "sku_or_category", "target_sku", "target_category"
    )


@query
def split_promo_scope(r: Retail) -> DataFrame:
    return split_scope(r.landing("promotions")).select(
        "promo_id", "store_id_or_region", "target_store_id", "target_region"
    )


@query
def quality_kept_transactions(r: Retail) -> DataFrame:
    return gold.typed_rows("transactions", fx.spoil(r.landing("transactions")))


@query
def quality_kept_products(r: Retail) -> DataFrame:
    return gold.typed_rows("products", r.landing("products"))


@query
def quality_kept_promotions(r: Retail) -> DataFrame:
    return gold.typed_rows("promotions", r.landing("promotions"))


@query
def quality_violations(r: Retail) -> DataFrame:
    return rule_violations(conform_transactions(fx.spoil(r.landing("transactions"))), RULES["transactions"])


@query
def fact_transactions(r: Retail) -> DataFrame:
    return r.fact_plan()


@query
def fact_promotions(r: Retail) -> DataFrame:
    return gold.fact_promotions(r.typed("promotions"), F.lit(PROMO_AS_OF))


@query
def scd1_transactions(r: Retail) -> DataFrame:
    return latest_per_key(r.changes, ["transaction_id"], fx.CHANGE_SEQUENCE)


@query
def masked_transactions(r: Retail) -> DataFrame:
    """What members and non-members see, and the fact a non-member could build from it."""
    sales = r.typed("transactions")
    views = [
        gold.fact_transactions(governance.masked_transactions(sales, member), r.products)
        .withColumn("is_member", F.lit(member))
        for member in (True, False)
    ]
    return views[0].unionByName(views[1])


# ---------------------------------------------------------------- weekly series


@query
def weekly_demand(r: Retail) -> DataFrame:
    return series.weekly_demand(r.fact_plan())


@query
def data_end(r: Retail) -> DataFrame:
    return series.data_end(r.weekly)


@query
def valid_pairs(r: Retail) -> DataFrame:
    return series.valid_pairs(r.weekly)


@query
def weekly_valid(r: Retail) -> DataFrame:
    return series.keep_valid_pairs(r.weekly)


@query
def weekly_enriched(r: Retail) -> DataFrame:
    return with_region_and_category(r.weekly, r.stores, r.products)


@query
def rolling_features(r: Retail) -> DataFrame:
    return series.rolling_features(series.keep_valid_pairs(r.weekly))


@query
def latest_features(r: Retail) -> DataFrame:
    return series.latest_per_series(series.valid_series(r.weekly))


@query
def forecast_weeks(r: Retail) -> DataFrame:
    return series.forecast_weeks(r.weekly)


@query
def score_keys(r: Retail) -> DataFrame:
    return series.add_forecast_weeks(series.valid_pairs(r.weekly), r.weekly)


# ---------------------------------------------------------------- promotions


@query
def promo_calendar(r: Retail) -> DataFrame:
    return explode_promos(r.promotions, "week", "week").select(
        "promo_id", "target_sku", "target_category", "target_store_id", "target_region", "discount_pct", "week"
    )


@query
def promo_features_history(r: Retail) -> DataFrame:
    rows = with_region_and_category(series.keep_valid_pairs(r.weekly), r.stores, r.products)
    return features.add_promo_features(rows, r.promo_steps, "past_discount")


@named("daily_best_discount")
def daily_best_discount_query(r: Retail) -> DataFrame:
    sales = with_region_and_category(
        r.fact.select("transaction_id", "sku", "store_id", "date_id"), r.stores, r.products
    )
    return daily_best_discount(sales, r.promo_steps, "date_id", "past_discount")


@named("promo_phase_counts")
def promo_phase_counts_query(r: Retail) -> DataFrame:
    return promo_phase_counts(r.promotions, F.lit(PROMO_AS_OF))


@query
def week_snap(r: Retail) -> DataFrame:
    """Each line item's shipping day to two weeks later, widened to whole weeks."""
    days = r.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").cast("date").alias("start_date"),
        F.date_add(F.col("l_shipdate").cast("date"), 14).alias("end_date"),
    )
    return snap_to_weeks(days, "start_date", "end_date")


@named("discounted_price")
def discounted_price_query(r: Retail) -> DataFrame:
    sales = with_region_and_category(
        r.fact.select("transaction_id", "sku", "store_id", "date_id"), r.stores, r.products
    )
    matched = daily_best_discount(sales, r.promo_steps, "date_id", "past_discount")
    priced = matched.join(r.products.select("sku", "unit_price"), "sku")
    return priced.select(
        "transaction_id", "sku", "unit_price", "discount_float",
        discounted_price("unit_price", "discount_float").alias("sale_price"),
    )


# ---------------------------------------------------------------- features, model, forecast


@query
def history_features(r: Retail) -> DataFrame:
    return r.features_plan("history")


@query
def future_features(r: Retail) -> DataFrame:
    return r.features_plan("future")


@query
def all_features(r: Retail) -> DataFrame:
    return r.features_plan("all")


@query
def labels(r: Retail) -> DataFrame:
    return features.labels(r.weekly, series.valid_pairs(r.weekly))


@query
def holdout_split(r: Retail) -> DataFrame:
    return forecast.holdout_split(labels(r))


@query
def training_set(r: Retail) -> DataFrame:
    return forecast.training_set(labels(r), r.features)


@query
def asof_features(r: Retail) -> DataFrame:
    """Every sale with the feature row known on its day; many sales share a series and a day."""
    sales = r.fact.select("transaction_id", "sku", "store_id", "date_id")
    return asof_lookup(sales, r.features, SERIES, "date_id", "week").select(
        "transaction_id", "sku", "store_id", "date_id", "rolling_4wk_avg", "avg_demand_last_12w", "is_promoted"
    )


@query
def asof_score_features(r: Retail) -> DataFrame:
    return forecast.lookup_for_scoring(score_keys(r), r.features)


@query
def asof_carried_features(r: Retail) -> DataFrame:
    """Forecast keys against history alone: the last week of a series is carried over up to eight weeks."""
    return forecast.lookup_for_scoring(score_keys(r), r.features.where(F.col("week") <= series.data_end(r.weekly).scalar()))


@query
def forecast_demand(r: Retail) -> DataFrame:
    return r.forecast_plan()


@query
def forecast_summary(r: Retail) -> DataFrame:
    return forecast.forecast_summary(r.forecast)


@query
def baseline_mae(r: Retail) -> DataFrame:
    errors = forecast.baseline_mae(forecast.holdout_split(training_set(r)).where("part = 'test'"))
    return errors.withColumns({c: F.round(c, 6) for c in errors.columns if c.startswith("mae_")})


@query
def model_mae(r: Retail) -> DataFrame:
    return model.model_mae(r.fitted, r.training.where("part = 'test'"))


@query
def glm_forecast(r: Retail) -> DataFrame:
    """Scored with the newest version that the last fit saved."""
    version = r.saved_version
    predict = model.coefficient_predictor(model.load_coefficients(r.spark, r.models, version), version)
    return forecast.score(r.features_plan("future"), predict, model.model_name(version))


@query
def saved_model_forecast(r: Retail) -> DataFrame:
    """A model kept as data: of the versions in a folder the highest is found, joined and scored."""
    folder = run_folder(r.spark, "models")
    for version, terms in SAVED_MODELS.items():
        model.save_coefficients(r.spark, folder, terms, version)
    version = model.latest_version(r.spark, folder)
    predict = model.coefficient_predictor(model.load_coefficients(r.spark, folder, version), version)
    return forecast.score(r.features_plan("future"), predict, model.model_name(version))


@query
def model_choice(r: Retail) -> DataFrame:
    """Poisson model and boosted trees on the same holdout."""
    return model.choose_model(r.predictors, r.training.where("part = 'train'"), r.training.where("part = 'test'"), r.features_ahead)


@query
def model_choice_rows(r: Retail) -> DataFrame:
    """How many rows each model learned from, was judged on and scored."""
    return model_choice(r).select("model", "train_rows", "holdout_rows", "scored_rows")


# ---------------------------------------------------------------- actions


@query
def action_list(r: Retail) -> DataFrame:
    return actions.action_list(r.forecast_plan(), r.stores, r.products)


@query
def action_queue(r: Retail) -> DataFrame:
    return actions.action_queue(r.actions, r.status)


@query
def action_queue_filtered(r: Retail) -> DataFrame:
    return actions.action_queue(r.actions, r.status, filters=QUEUE_FILTERS)


@query
def queue_counts(r: Retail) -> DataFrame:
    return actions.queue_counts(actions.week_actions(r.actions, r.status))


@query
def filter_options(r: Retail) -> DataFrame:
    return option_lists(actions.week_actions(r.actions, r.status), QUEUE_OPTIONS)


# ---------------------------------------------------------------- reports


@query
def risk_summary(r: Retail) -> DataFrame:
    rows = r.forecast
    return reports.risk_summary(rows, r.newest("forecast_demand", "week"))


@query
def risk_detail(r: Retail) -> DataFrame:
    return reports.risk_detail(r.forecast, r.stores, r.products)


@query
def risk_total(r: Retail) -> DataFrame:
    return reports.risk_total(risk_detail(r))


@query
def risk_by_category(r: Retail) -> DataFrame:
    return reports.risk_by(risk_detail(r), "category")


@query
def risk_by_region(r: Retail) -> DataFrame:
    return reports.risk_by(risk_detail(r), "region")


@query
def weekly_revenue(r: Retail) -> DataFrame:
    return reports.weekly_revenue(r.fact, r.stores)


@query
def category_revenue(r: Retail) -> DataFrame:
    return reports.category_revenue(r.fact, r.products)


@query
def promo_lift(r: Retail) -> DataFrame:
    return reports.promo_lift(r.fact, r.products)


@query
def active_promotions(r: Retail) -> DataFrame:
    return reports.active_promotions(r.promos(PROMO_AS_OF))


@query
def upcoming_promotions(r: Retail) -> DataFrame:
    return reports.upcoming_promotions(r.promos(PROMO_AS_OF))


@query
def risk_dashboard(r: Retail) -> DataFrame:
    return reports.risk_dashboard(r.forecast, r.stores, r.products, DASHBOARD_WEEK)


@query
def week_options(r: Retail) -> DataFrame:
    return reports.week_options(r.forecast)


@query
def explorer_options(r: Retail) -> DataFrame:
    return reports.explorer_options(r.forecast, r.stores, r.products)


@query
def forecast_explorer(r: Retail) -> DataFrame:
    fact = r.fact_by_month
    return reports.forecast_explorer(
        fact, r.forecast, r.stores, r.products, EXPLORER_STORE, EXPLORER_SKU, newest_month=r.newest("fact_transactions", gold.SALE_MONTH)
    )


@query
def explorer_headline(r: Retail) -> DataFrame:
    return reports.explorer_headline(forecast_explorer(r))


@query
def explorer_chart(r: Retail) -> DataFrame:
    return reports.explorer_chart(forecast_explorer(r))


@query
def risk_dashboard_bound(r: Retail) -> DataFrame:
    tables = dict(forecast=r.forecast, stores=r.stores, products=r.products)
    return bound.risk_dashboard(r.spark, tables, week=DASHBOARD_WEEK)


@query
def forecast_explorer_bound(r: Retail) -> DataFrame:
    tables = dict(fact=r.fact_by_month, forecast=r.forecast, stores=r.stores, products=r.products)
    newest = r.newest("fact_transactions", gold.SALE_MONTH)
    return bound.forecast_explorer(r.spark, tables, store_name=EXPLORER_STORE, sku=EXPLORER_SKU, newest_month=newest)


@query
def top_stores_stockout(r: Retail) -> DataFrame:
    return reports.top_stores_stockout(r.forecast, r.stores)


@query
def weeks_this(r: Retail) -> DataFrame:
    return this_week(r.forecast, F.lit(FORECAST_AS_OF))


@query
def weeks_next(r: Retail) -> DataFrame:
    return next_week(r.forecast, F.lit(FORECAST_AS_OF))


@query
def weeks_next_n(r: Retail) -> DataFrame:
    return next_n_weeks(r.forecast, F.lit(FORECAST_AS_OF), 3)


@query
def fact_sample(r: Retail) -> DataFrame:
    return sample_rows(r.fact, 10, KEYS["transactions"])


@query
def layer_counts(r: Retail) -> DataFrame:
    tables = {("bronze", f"bronze_{feed}"): r.landing(feed) for feed in LANDING_SCHEMAS}
    tables |= {("silver", f"silver_{feed}"): r.typed(feed) for feed in LANDING_SCHEMAS}
    tables |= {
        ("gold", "dim_product"): r.products, ("gold", "dim_store"): r.stores,
        ("gold", "fact_transactions"): r.fact, ("gold", "fact_promotions"): r.promos(),
        ("gold", "forecast_demand"): r.forecast, ("gold", "forecast_action_list"): r.actions,
        ("feature", "weekly_demand_features"): r.features,
    }
    return summaries.layer_counts(tables)


# ---------------------------------------------------------------- standing questions


@query
def risk_pairs_by_category(r: Retail) -> DataFrame:
    return questions.risk_pairs_by_category(r.forecast, r.products)


@query
def forecast_by_region(r: Retail) -> DataFrame:
    return questions.forecast_by_region(r.forecast, r.stores, F.lit(FORECAST_AS_OF))


@query
def predicted_vs_actual(r: Retail) -> DataFrame:
    return questions.predicted_vs_actual(r.forecast, r.weekly, r.products)


@query
def top_products_forecast(r: Retail) -> DataFrame:
    return questions.top_products_forecast(r.forecast, r.products, F.lit(FORECAST_AS_OF))


@query
def category_revenue_weekly(r: Retail) -> DataFrame:
    return questions.category_revenue_weekly(r.fact, r.products)


@query
def top_stores_at_risk(r: Retail) -> DataFrame:
    return questions.top_stores_at_risk(r.forecast, r.stores)


@query
def discount_vs_quantity(r: Retail) -> DataFrame:
    return questions.discount_vs_quantity(r.fact, r.promo_steps, r.stores, r.products, "past_discount")


@query
def stores_stockout_next_week(r: Retail) -> DataFrame:
    return questions.stores_stockout_next_week(r.forecast, r.stores, F.lit(FORECAST_AS_OF))


# ---------------------------------------------------------------- scalar functions


@query
def date_parts(r: Retail) -> DataFrame:
    days = r.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("date_id")
    )
    return with_date_parts(days).withColumn("week", week_start("date_id"))


@query
def scalar_probe(r: Retail) -> DataFrame:
    """The remaining scalar functions over every part."""
    return r.given("part").select(
        "p_partkey",
        F.concat_ws("::", "p_brand", F.col("p_size").cast("string")).alias("joined"),
        F.regexp_replace("p_brand", "^Brand#", "").alias("stripped"),
        F.col("p_brand").rlike("^Brand#1\\d$").alias("matches"),
        F.col("p_name").startswith("p").alias("starts"),
        F.greatest(F.lit(0), F.col("p_size") - 25).alias("floored"),
        F.abs(F.col("p_size") - 25).alias("distance"),
        F.round(F.col("p_retailprice") / 4, 1).alias("rounded"),
        F.col("p_size").cast("double").alias("as_double"),
        (F.col("p_size") > 25).cast("int").alias("as_int"),
        F.when(F.col("p_size") > 40, F.col("p_brand")).alias("null_unless_large"),
        F.coalesce(F.when(F.col("p_size") > 40, F.col("p_size")), F.lit(-1)).alias("filled"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("p_size") % 3 + 1).alias("picked"),
        F.col("p_type").try_cast("int").alias("unreadable"),
    )


# ---------------------------------------------------------------- streams with state


@query
def scd1_stream_transactions(r: Retail) -> DataFrame:
    """The change feed streamed into a keyed table."""
    folder = run_folder(r.spark, "scd1")
    feed = fx.change_rows(r.given_stream("lineitem"))
    table = KeyedTable(r.spark, f"{folder}/table", feed.schema, ["transaction_id"], fx.CHANGE_SEQUENCE)
    scd1_upsert(feed, table, f"{folder}/checkpoint").awaitTermination()
    return table.read()


@query
def silver_stream_transactions(r: Retail) -> DataFrame:
    """Sales and later corrections of some, landing to bronze to silver in two runs."""
    return r.silver_sales


@query
def quality_stream_violations(r: Retail) -> DataFrame:
    """What the rules dropped on the way to silver, over all micro-batches of both runs."""
    return r.sales_rule_failures()


@query
def action_status_stream(r: Retail) -> DataFrame:
    """Status updates streamed from the event file and written back by key."""
    folder = run_folder(r.spark, "status")
    feed = fx.status_updates(r.given_stream("events"))
    table = run_status(feed, f"{folder}/table", f"{folder}/checkpoint", fx.STATUS_ORDER)
    return table.read().select(*actions.STATUS_SCHEMA.names)
