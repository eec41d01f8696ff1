"""The parameterised reports as SQL with bind parameters, for callers that send text and values apart.

Values are bound by Spark, never pasted into the text. A value that matches nothing, such as
``NOTHING`` for a choice not yet made or a week that is no date, selects no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandflow.plans.reports import EXPLORER_WEEKS

# Fixed value: what a page sends before a choice is made.
NOTHING = "__none__"

RISK_DASHBOARD = """
SELECT week, store_name, region, sku, product_name, category, predicted_demand,
       round(avg_demand_last_12w, 1) AS avg_demand_last_12w, is_stockout_risk, is_overstock_risk
FROM {forecast} JOIN {stores} USING (store_id) JOIN {products} USING (sku)
WHERE week = try_cast(:week AS DATE) AND (is_stockout_risk OR is_overstock_risk)
ORDER BY is_stockout_risk DESC, is_overstock_risk DESC, store_name, sku
"""

# The table of sales is partitioned by month; the newest month comes from its listing.
FORECAST_EXPLORER = """
WITH one_store AS (SELECT store_id, store_name, region FROM {stores} WHERE store_name = :store_name),
one_product AS (SELECT sku, product_name, category FROM {products} WHERE sku = :sku),
recent AS (
  SELECT sku, store_id, date_sub(date_id, weekday(date_id)) AS week, quantity_sold FROM {fact}
  WHERE sale_month >= trunc(date_sub(try_cast(:newest_month AS DATE), 7 * :weeks), 'month') AND sku = :sku
    AND date_id >= (SELECT date_sub(max(date_id), 7 * :weeks) FROM {fact} WHERE sale_month = try_cast(:newest_month AS DATE))
), demand AS (
  SELECT sku, store_id, week, CAST(sum(quantity_sold) AS DOUBLE) AS actual_demand, CAST(NULL AS DOUBLE) AS predicted_demand,
         CAST(NULL AS DOUBLE) AS avg_demand_last_12w, CAST(NULL AS BOOLEAN) AS is_stockout_risk, CAST(NULL AS BOOLEAN) AS is_overstock_risk
  FROM recent JOIN one_store USING (store_id) GROUP BY sku, store_id, week
  UNION ALL
  SELECT sku, store_id, week, NULL, CAST(predicted_demand AS DOUBLE), avg_demand_last_12w, is_stockout_risk, is_overstock_risk
  FROM {forecast} WHERE sku = :sku
)
SELECT CAST(week AS TIMESTAMP_NTZ) AS week, store_name, region, sku, product_name, category, actual_demand, predicted_demand,
       avg_demand_last_12w, is_stockout_risk, is_overstock_risk
FROM demand JOIN one_store USING (store_id) JOIN one_product USING (sku) ORDER BY week
"""


def risk_dashboard(spark: SparkSession, tables: dict[str, DataFrame], week: str = NOTHING) -> DataFrame:
    """``tables``: forecast, stores, products."""
    return spark.sql(RISK_DASHBOARD, args={"week": week}, **tables)


def forecast_explorer(
    spark: SparkSession, tables: dict[str, DataFrame], store_name: str = NOTHING, sku: str = NOTHING,
    newest_month: str = NOTHING, weeks: int = EXPLORER_WEEKS,
) -> DataFrame:
    """``tables``: fact partitioned by sale_month, forecast, stores, products."""
    values = {"store_name": store_name, "sku": sku, "newest_month": newest_month, "weeks": weeks}
    return spark.sql(FORECAST_EXPLORER, args=values, **tables)
