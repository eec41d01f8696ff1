"""The same queries as plain SQL on the given tables, written from the definitions.

Each query is the tail of a chain of named steps; ``_with`` puts the steps it uses in front.
"""

from __future__ import annotations

import re

from demandflow.checks import registry as q
from demandflow.checks.fixtures import FORECAST_AS_OF, MODEL_VERSION, PROMO_AS_OF
from demandflow.plans.forecast import UPLIFT

_CATEGORY = (
    "CASE {n} WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Grocery' WHEN 2 THEN 'Apparel' WHEN 3 THEN 'Home' ELSE 'Outdoor' END"
)
_BRAND_SKU = "'BR-' || lpad(substr(p_brand, 7), 3, '0')"
_PROMO_START = "CAST(date_trunc('week', DATE '1995-01-02' + CAST((p_partkey * 37) % 2600 AS INTEGER)) AS DATE)"

_FACT = """
SELECT t.transaction_id, t.sku, t.store_id, t.transaction_date AS date_id, t.quantity_sold, t.unit_price_at_sale,
       round(t.quantity_sold * t.unit_price_at_sale, 2) AS total_revenue,
       CASE WHEN t.unit_price_at_sale < p.unit_price THEN 1 ELSE 0 END AS is_promoted
FROM {sales} t LEFT JOIN products p ON t.sku = p.sku
"""

_FACT_PROMOS = """
SELECT promo_id, target_sku, target_category, target_store_id, target_region, discount_pct, channel,
       promo_start_date, promo_end_date,
       (promo_start_date <= DATE '{day}' AND promo_end_date >= DATE '{day}') AS is_active,
       promo_start_date > DATE '{day}' AS is_future
FROM promotions
"""

# a promotion names the row's product or category, and its store or region
_TARGETS = """(p.target_store_id = w.store_id OR p.target_region = w.region)
     AND (p.target_sku = w.sku OR p.target_category = w.category)"""

_OVERLAP = f"""
SELECT w.sku, w.store_id, w.week, max(p.discount_pct) AS best
FROM {{rows}} w JOIN (
  SELECT *, CAST(unnest(generate_series(date_trunc('week', promo_start_date)::TIMESTAMP, promo_end_date::TIMESTAMP, INTERVAL 7 DAY)) AS DATE) AS promo_week
  FROM {{promos}}) p
  ON p.promo_week = w.week AND {_TARGETS}
GROUP BY ALL
"""

_RISK = "is_stockout_risk OR is_overstock_risk"

STEPS: dict[str, str] = {
    "landing_products": f"""
SELECT {_BRAND_SKU} AS sku, p_brand AS product_name,
       {_CATEGORY.format(n="CAST(substr(p_brand, 7) AS INTEGER) % 5")} AS category,
       'Sub-' || (CAST(substr(p_brand, 7) AS INTEGER) % 4) AS subcategory,
       CAST(CAST(max(p_retailprice) * 0.6 AS DECIMAL(10,2)) AS VARCHAR) AS unit_cost,
       CAST(CAST(max(p_retailprice) AS DECIMAL(10,2)) AS VARCHAR) AS unit_price
FROM part GROUP BY p_brand""",
    "landing_stores": """
SELECT CAST(1001 + s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, r_name AS region,
       CASE (1001 + s_suppkey) % 3 WHEN 0 THEN 'flagship' WHEN 1 THEN 'standard' ELSE 'express' END AS store_type,
       'mgr_' || s_suppkey AS manager_name, 'mgr_' || s_suppkey || '@example.com' AS manager_email,
       '+1-555-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS manager_phone, '2015-01-01' AS manager_since
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "landing_transactions": """
SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey AS transaction_id,
       p.sku, CAST(1001 + l_suppkey AS VARCHAR) AS store_id,
       strftime(l_shipdate, '%Y-%m-%d') AS transaction_date,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity_sold,
       CAST(CAST(CAST(p.unit_price AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(10,2)) AS VARCHAR)
         AS unit_price_at_sale
FROM lineitem JOIN part ON p_partkey = l_partkey
JOIN landing_products p ON p.product_name = p_brand""",
    "spoiled_transactions": """
SELECT transaction_id, sku, store_id,
       CASE WHEN n % 211 = 0 THEN '2024-13-01' ELSE transaction_date END AS transaction_date,
       CASE WHEN n % 97 = 0 THEN '0' WHEN n % 307 = 0 THEN 'x' ELSE quantity_sold END AS quantity_sold,
       CASE WHEN n % 101 = 0 THEN '-1.00' ELSE unit_price_at_sale END AS unit_price_at_sale
FROM (SELECT *, CAST(split_part(transaction_id, '-', 1) AS BIGINT) AS n FROM landing_transactions)""",
    "landing_promotions": f"""
SELECT 'PROMO-' || lpad(hex(p_partkey), 8, '0') AS promo_id,
       CASE WHEN p_partkey % 5 < 2 THEN {_BRAND_SKU} ELSE {_CATEGORY.format(n="p_partkey % 7 % 5")} END AS sku_or_category,
       CASE WHEN p_size % 5 < 2 THEN 'store_' || (1001 + p_partkey // 20)
            ELSE CASE p_partkey % 5 WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA'
                 WHEN 3 THEN 'EUROPE' ELSE 'MIDDLE EAST' END END AS store_id_or_region,
       CASE p_size % 6 WHEN 0 THEN '10%' WHEN 1 THEN '15%' WHEN 2 THEN '20%' WHEN 3 THEN '25%'
            WHEN 4 THEN '30%' ELSE '40%' END AS discount_pct,
       CASE p_partkey % 3 WHEN 0 THEN 'in_store' WHEN 1 THEN 'online' ELSE 'both' END AS channel,
       strftime({_PROMO_START}, '%m/%d/%Y') AS promo_start_date,
       strftime({_PROMO_START} + CAST(7 * (1 + p_size % 8) - 1 AS INTEGER), '%m/%d/%Y') AS promo_end_date
FROM part""",
    "changes": """
SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_shipdate AS seq_1, l_partkey AS seq_2,
       l_suppkey AS seq_3, l_quantity AS seq_4, l_extendedprice AS seq_5,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity_sold
FROM lineitem""",
    "status_feed": f"""
SELECT 'BR-' || lpad(CAST(1 + event_id % 25 AS VARCHAR), 3, '0') AS sku,
       CAST(1001 + user_id AS VARCHAR) AS store_id, DATE '{FORECAST_AS_OF}' AS week,
       CASE event_type WHEN 'view' THEN 'acknowledged' WHEN 'purchase' THEN 'reorder_placed'
            WHEN 'signup' THEN 'resolved' WHEN 'click' THEN 'open' END AS status,
       CAST(NULL AS VARCHAR) AS note, 'user_' || user_id AS updated_by, ts AS updated_at, event_id AS seq
FROM events""",
    "typed_spoiled": """
SELECT transaction_id, sku, store_id, try_cast(transaction_date AS DATE) AS transaction_date,
       try_cast(quantity_sold AS INTEGER) AS quantity_sold, try_cast(unit_price_at_sale AS DOUBLE) AS unit_price_at_sale
FROM spoiled_transactions""",
    "corrections": """
SELECT transaction_id, sku, store_id,
       CASE WHEN n % 211 = 0 THEN '2024-13-01' ELSE transaction_date END AS transaction_date,
       CASE WHEN n % 97 = 0 THEN '0' WHEN n % 307 = 0 THEN 'x' ELSE CAST(CAST(quantity_sold AS INTEGER) + 1 AS VARCHAR) END AS quantity_sold,
       CASE WHEN n % 101 = 0 THEN '-1.00' ELSE unit_price_at_sale END AS unit_price_at_sale
FROM (SELECT *, CAST(split_part(transaction_id, '-', 1) AS BIGINT) AS n FROM landing_transactions)
WHERE n % 10 = 3 OR n % 97 = 0 OR n % 101 = 0 OR n % 211 = 0""",
    "typed_deliveries": """
SELECT delivery, transaction_id, sku, store_id, try_cast(transaction_date AS DATE) AS transaction_date,
       try_cast(quantity_sold AS INTEGER) AS quantity_sold, try_cast(unit_price_at_sale AS DOUBLE) AS unit_price_at_sale
FROM (SELECT 0 AS delivery, * FROM landing_transactions UNION ALL SELECT 1 AS delivery, * FROM corrections)""",
    # a sale is known once; the last delivery that passes the rules wins, ties by all columns
    "transactions": """
SELECT * EXCLUDE (delivery) FROM typed_deliveries
WHERE quantity_sold > 0 AND unit_price_at_sale > 0 AND transaction_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY delivery DESC, sku DESC, store_id DESC,
  transaction_date DESC, quantity_sold DESC, unit_price_at_sale DESC) = 1""",
    "products": """
SELECT * FROM (
  SELECT sku, product_name, category, subcategory, CAST(unit_cost AS DOUBLE) AS unit_cost,
         CAST(unit_price AS DOUBLE) AS unit_price
  FROM landing_products)
WHERE unit_price > unit_cost""",
    "stores": "SELECT store_id, store_name, region, store_type FROM landing_stores",
    "split_promotions": """
SELECT *,
       CASE WHEN regexp_full_match(sku_or_category, '[A-Z]{2}-[0-9]{3}') THEN sku_or_category END AS target_sku,
       CASE WHEN NOT regexp_full_match(sku_or_category, '[A-Z]{2}-[0-9]{3}') THEN sku_or_category END AS target_category,
       CASE WHEN starts_with(store_id_or_region, 'store_') THEN substr(store_id_or_region, 7) END AS target_store_id,
       CASE WHEN NOT starts_with(store_id_or_region, 'store_') THEN store_id_or_region END AS target_region
FROM landing_promotions""",
    "typed_promotions": """
SELECT promo_id, CAST(replace(discount_pct, '%', '') AS DOUBLE) / 100.0 AS discount_pct, channel,
       CAST(strptime(promo_start_date, '%m/%d/%Y') AS DATE) AS promo_start_date,
       CAST(strptime(promo_end_date, '%m/%d/%Y') AS DATE) AS promo_end_date,
       target_sku, target_category, target_store_id, target_region
FROM split_promotions""",
    "promotions": """
SELECT * FROM typed_promotions
WHERE discount_pct > 0 AND discount_pct < 1 AND promo_end_date >= promo_start_date""",
    "fact": _FACT.format(sales="transactions"),
    "promos": _FACT_PROMOS.format(day=FORECAST_AS_OF),
    "promos_then": _FACT_PROMOS.format(day=PROMO_AS_OF),
    "past_promos": "SELECT * FROM promos WHERE NOT is_future",
    "weekly": """
SELECT sku, store_id, CAST(date_trunc('week', date_id) AS DATE) AS week, CAST(sum(quantity_sold) AS BIGINT) AS total_quantity
FROM fact GROUP BY ALL""",
    "ends": "SELECT max(week) AS data_end FROM weekly",
    "pairs": "SELECT sku, store_id FROM weekly GROUP BY ALL HAVING count(DISTINCT week) >= 12",
    "label_rows": "SELECT weekly.* FROM weekly JOIN pairs USING (sku, store_id)",
    "described": """
SELECT l.*, region, category FROM label_rows l JOIN stores USING (store_id) JOIN products USING (sku)""",
    "past_best": _OVERLAP.format(rows="described", promos="past_promos"),
    "averages": """
SELECT *, coalesce(avg(total_quantity) OVER (PARTITION BY sku, store_id ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0)
            AS rolling_4wk_avg,
       coalesce(avg(total_quantity) OVER (PARTITION BY sku, store_id ORDER BY week ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), 0.0)
            AS avg_demand_last_12w
FROM described""",
    "history": """
SELECT sku, store_id, week, CAST(weekofyear(week) AS INTEGER) AS week_of_year,
       CASE WHEN best IS NOT NULL THEN 1 ELSE 0 END AS is_promoted, coalesce(best, 0.0) AS discount_pct_feat,
       rolling_4wk_avg, avg_demand_last_12w
FROM averages LEFT JOIN past_best USING (sku, store_id, week)""",
    "latest": """
SELECT sku, store_id, avg_demand_last_12w, rolling_4wk_avg FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, store_id ORDER BY week DESC) AS rn FROM history)
WHERE rn = 1""",
    "ahead": "SELECT CAST(data_end + CAST(7 * i AS INTEGER) AS DATE) AS week FROM ends, range(1, 9) t(i)",
    "keys": "SELECT sku, store_id, week FROM pairs CROSS JOIN ahead",
    "future_rows": """
SELECT k.*, region, category, rolling_4wk_avg, avg_demand_last_12w
FROM keys k JOIN latest USING (sku, store_id) JOIN stores USING (store_id) JOIN products USING (sku)""",
    "any_best": _OVERLAP.format(rows="future_rows", promos="promos"),
    "future": """
SELECT sku, store_id, week, CAST(weekofyear(week) AS INTEGER) AS week_of_year,
       CASE WHEN best IS NOT NULL THEN 1 ELSE 0 END AS is_promoted, coalesce(best, 0.0) AS discount_pct_feat,
       rolling_4wk_avg, avg_demand_last_12w
FROM future_rows LEFT JOIN any_best USING (sku, store_id, week)""",
    "features": "SELECT * FROM history UNION ALL SELECT * FROM future",
    "forecast": f"""
SELECT sku, store_id, week, predicted_demand, avg_demand_last_12w,
       predicted_demand > avg_demand_last_12w * 1.3 AND avg_demand_last_12w > 0 AS is_stockout_risk,
       predicted_demand < avg_demand_last_12w * 0.7 AND avg_demand_last_12w > 0 AS is_overstock_risk,
       '{MODEL_VERSION}' AS model_version
FROM (SELECT *, CAST(greatest(0, round(rolling_4wk_avg * (1 + {UPLIFT}::DOUBLE * discount_pct_feat))) AS INTEGER) AS predicted_demand
      FROM future)""",
    "actions": f"""
SELECT sku, store_id, week, store_name, region, product_name, category, predicted_demand,
       round(avg_demand_last_12w, 1) AS avg_demand_last_12w,
       CASE WHEN is_stockout_risk AND is_overstock_risk THEN 'Both' WHEN is_stockout_risk THEN 'Stockout' ELSE 'Overstock' END
         AS risk_type,
       CAST(round(predicted_demand - avg_demand_last_12w, 0) AS INTEGER) AS demand_delta, model_version
FROM forecast JOIN stores USING (store_id) JOIN products USING (sku) WHERE {_RISK}""",
    "status_table": """
SELECT sku || '::' || store_id || '::' || CAST(week AS VARCHAR) AS action_id, sku, store_id, week, status, note,
       updated_by, updated_at
FROM status_feed WHERE status IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY sku, store_id, week ORDER BY updated_at DESC, seq DESC) = 1""",
    "week_queue": """
SELECT a.sku, a.store_id, a.week, store_name, region, product_name, category, predicted_demand, avg_demand_last_12w,
       risk_type, demand_delta, coalesce(s.status, 'open') AS status, s.note, s.updated_by, s.updated_at
FROM actions a LEFT JOIN status_table s ON s.sku = a.sku AND s.store_id = a.store_id AND s.week = a.week
WHERE a.week = (SELECT min(week) FROM actions)""",
    "queue": """
SELECT * FROM week_queue
ORDER BY (risk_type = 'Stockout') DESC, abs(demand_delta) DESC, sku, store_id LIMIT 500""",
    "detail": f"""
SELECT store_id, store_name, sku, product_name, category, region, predicted_demand, avg_demand_last_12w,
       CASE WHEN is_stockout_risk THEN 'Stockout' WHEN is_overstock_risk THEN 'Overstock' ELSE 'OK' END AS risk_type, week
FROM forecast JOIN products USING (sku) JOIN stores USING (store_id)
WHERE ({_RISK}) AND week = (SELECT max(week) FROM forecast)""",
    "sales_described": """
SELECT f.*, region, category, unit_price FROM fact f JOIN stores USING (store_id) JOIN products USING (sku)""",
    "day_best": f"""
SELECT w.sku, w.store_id, w.date_id, max(p.discount_pct) AS best
FROM (SELECT DISTINCT sku, store_id, date_id, region, category FROM sales_described) w JOIN (
  SELECT *, CAST(unnest(generate_series(promo_start_date::TIMESTAMP, promo_end_date::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS promo_day
  FROM past_promos) p
  ON p.promo_day = w.date_id AND {_TARGETS}
GROUP BY ALL""",
    "sales_discounted": """
SELECT s.*, coalesce(best, 0.0) AS discount_float FROM sales_described s LEFT JOIN day_best USING (sku, store_id, date_id)""",
    "actual": f"""
SELECT CAST(date_trunc('week', date_id) AS DATE) AS week, sku, store_id, CAST(sum(quantity_sold) AS DOUBLE) AS actual_demand
FROM fact WHERE date_id >= (SELECT max(date_id) FROM fact) - 84 GROUP BY ALL""",
    "explorer": f"""
SELECT CAST(week AS TIMESTAMP) AS week, store_name, region, sku, product_name, category, actual_demand, predicted_demand,
       avg_demand_last_12w, is_stockout_risk, is_overstock_risk
FROM (
  SELECT week, sku, store_id, actual_demand, NULL::DOUBLE AS predicted_demand, NULL::DOUBLE AS avg_demand_last_12w,
         NULL::BOOLEAN AS is_stockout_risk, NULL::BOOLEAN AS is_overstock_risk FROM actual
  UNION ALL
  SELECT week, sku, store_id, NULL, CAST(predicted_demand AS DOUBLE), avg_demand_last_12w, is_stockout_risk, is_overstock_risk
  FROM forecast)
JOIN stores USING (store_id) JOIN products USING (sku)
WHERE store_name = '{q.EXPLORER_STORE}' AND sku = '{q.EXPLORER_SKU}'""",
    # the earlier run of the feature merge: everything as if the data ended 8 weeks sooner
    "early_labels": """
SELECT w.* FROM (SELECT * FROM weekly WHERE week <= (SELECT data_end - 56 FROM ends)) w
JOIN (SELECT sku, store_id FROM weekly WHERE week <= (SELECT data_end - 56 FROM ends) GROUP BY ALL HAVING count(*) >= 12)
USING (sku, store_id)""",
}

_AVERAGE = (
    "coalesce(avg(total_quantity) OVER (PARTITION BY sku, store_id ORDER BY week "
    "ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0.0)"
)
STEPS["early_latest"] = f"""
SELECT sku, store_id, rolling_4wk_avg, avg_demand_last_12w, region, category FROM (
  SELECT *, {_AVERAGE.format(n=4)} AS rolling_4wk_avg, {_AVERAGE.format(n=12)} AS avg_demand_last_12w,
         row_number() OVER (PARTITION BY sku, store_id ORDER BY week DESC) AS rn
  FROM early_labels)
JOIN stores USING (store_id) JOIN products USING (sku) WHERE rn = 1"""
STEPS["early_future"] = """
SELECT l.*, CAST(data_end - 56 + CAST(7 * i AS INTEGER) AS DATE) AS week
FROM early_latest l, ends, range(1, 9) t(i)"""
STEPS["early_best"] = _OVERLAP.format(rows="early_future", promos="promos")
# forecast rows of the earlier run that today's run does not overwrite; its history rows all are,
# because a series with 12 weeks then has them now as well
STEPS["left_over"] = """
SELECT sku, store_id, week, CAST(weekofyear(week) AS INTEGER) AS week_of_year,
       CASE WHEN best IS NOT NULL THEN 1 ELSE 0 END AS is_promoted, coalesce(best, 0.0) AS discount_pct_feat,
       rolling_4wk_avg, avg_demand_last_12w
FROM early_future LEFT JOIN early_best USING (sku, store_id, week)
WHERE NOT EXISTS (SELECT 1 FROM features f WHERE f.sku = early_future.sku AND f.store_id = early_future.store_id
                  AND f.week = early_future.week)"""

_MONEY = "CAST(sum(CAST(round(total_revenue * 100) AS BIGINT)) AS DOUBLE) / 100.0"
_WEEK_OF = "CAST(date_trunc('week', {d}) AS DATE)"
_PROMO_REPORT = """
SELECT promo_id, coalesce(target_sku, target_category) AS sku_or_category,
       coalesce(target_store_id, target_region) AS store_id_or_region, discount_pct, channel, promo_start_date, promo_end_date
FROM promos_then"""

TAILS: dict[str, str] = {
    "ingest_metadata": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'lineitem.parquet' AS source_file,
'pos_system' AS source_system, true AS stamped FROM lineitem""",
    "ingest_stream_parquet": """SELECT *, 'lineitem.parquet' AS source_file, 'pos_system' AS source_system
FROM landing_transactions""",
    "ingest_stream_csv": "SELECT *, 'promo_platform' AS _source_system FROM landing_promotions",
    "dim_date": """SELECT d AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(
        (SELECT make_date(CAST(year(min(date_id)) AS BIGINT), 1, 1) FROM fact)::TIMESTAMP,
        (SELECT make_date(CAST(year(max(date_id)) AS BIGINT), 12, 31) FROM fact)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_product": "SELECT * FROM products",
    "dim_store": "SELECT * FROM stores",
    "feature_merge": "SELECT * FROM features UNION ALL SELECT * FROM left_over",
    "forecast_table": "SELECT * FROM forecast",
    "bronze_stream_table": "SELECT *, 'pos_system' AS _source_system FROM landing_transactions UNION ALL SELECT *, 'pos_system' FROM corrections",
    "feature_upsert": "SELECT * FROM features UNION ALL SELECT * FROM left_over",
    "action_list_snapshot": "SELECT * FROM actions",
    "action_status_upsert": "SELECT * FROM status_table",
    "run_summary": f"""SELECT (SELECT count(*) FROM features) AS feature_rows, (SELECT data_end FROM ends) AS data_end,
count(*) AS forecast_rows, count(*) FILTER (WHERE {_RISK}) AS action_rows,
string_agg(DISTINCT CAST(week AS VARCHAR), ',' ORDER BY CAST(week AS VARCHAR)) AS forecast_weeks FROM forecast""",
    "conform_transactions": "SELECT * FROM typed_spoiled",
    "conform_products": """SELECT * REPLACE (CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(unit_price AS DOUBLE) AS unit_price)
FROM landing_products""",
    "conform_stores": "SELECT * REPLACE (CAST(manager_since AS DATE) AS manager_since) FROM landing_stores",
    "conform_promotions": "SELECT * FROM typed_promotions",
    "split_promo_target": "SELECT promo_id, sku_or_category, target_sku, target_category FROM split_promotions",
    "split_promo_scope": "SELECT promo_id, store_id_or_region, target_store_id, target_region FROM split_promotions",
    "quality_kept_transactions": """SELECT * FROM typed_spoiled
WHERE quantity_sold > 0 AND unit_price_at_sale > 0 AND transaction_date IS NOT NULL""",
    "quality_kept_products": "SELECT * FROM products",
    "quality_kept_promotions": "SELECT * FROM promotions",
    "quality_violations": """SELECT rule, count(*) FILTER (WHERE ok IS NOT TRUE) AS failed_rows, count(*) AS total_rows FROM (
  SELECT 'valid_quantity' AS rule, quantity_sold > 0 AS ok FROM typed_spoiled
  UNION ALL SELECT 'valid_revenue', unit_price_at_sale > 0 FROM typed_spoiled
  UNION ALL SELECT 'valid_date', transaction_date IS NOT NULL FROM typed_spoiled) GROUP BY rule""",
    "fact_transactions": "SELECT * FROM fact",
    "fact_promotions": "SELECT * FROM promos_then",
    "scd1_transactions": """SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY transaction_id
ORDER BY seq_1 DESC, seq_2 DESC, seq_3 DESC, seq_4 DESC, seq_5 DESC, quantity_sold DESC) = 1""",
    "masked_transactions": """SELECT *, true AS is_member FROM fact UNION ALL
SELECT * REPLACE (NULL::DOUBLE AS unit_price_at_sale, NULL::DOUBLE AS total_revenue, 0 AS is_promoted), false FROM fact""",
    "weekly_demand": "SELECT * FROM weekly",
    "data_end": "SELECT * FROM ends",
    "valid_pairs": "SELECT * FROM pairs",
    "weekly_valid": "SELECT * FROM label_rows",
    "weekly_enriched": "SELECT w.*, region, category FROM weekly w JOIN stores USING (store_id) JOIN products USING (sku)",
    "rolling_features": "SELECT * EXCLUDE (region, category) FROM averages",
    "latest_features": "SELECT * FROM latest",
    "forecast_weeks": "SELECT * FROM ahead",
    "score_keys": "SELECT * FROM keys",
    "promo_calendar": f"""SELECT promo_id, target_sku, target_category, target_store_id, target_region, discount_pct, w.week
FROM promotions JOIN (SELECT DISTINCT {_WEEK_OF.format(d='d')} AS week FROM
  (SELECT unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2003-01-01', INTERVAL 1 DAY)) AS d)) w
ON w.week + 6 >= promo_start_date AND w.week <= promo_end_date""",
    "promo_features_history": """SELECT d.*, coalesce(best, 0.0) AS discount_pct_feat,
CASE WHEN best IS NOT NULL THEN 1 ELSE 0 END AS is_promoted
FROM described d LEFT JOIN past_best USING (sku, store_id, week)""",
    "daily_best_discount": """SELECT transaction_id, sku, store_id, date_id, region, category, discount_float,
CAST(discount_float > 0 AS INTEGER) AS is_promoted FROM sales_discounted""",
    "promo_phase_counts": f"""SELECT count(*) FILTER (WHERE promo_end_date < DATE '{PROMO_AS_OF}') AS historical,
count(*) FILTER (WHERE DATE '{PROMO_AS_OF}' BETWEEN promo_start_date AND promo_end_date) AS active,
count(*) FILTER (WHERE promo_start_date > DATE '{PROMO_AS_OF}') AS future FROM promotions""",
    "week_snap": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
{_WEEK_OF.format(d='l_shipdate')} AS start_date, {_WEEK_OF.format(d="l_shipdate + INTERVAL 14 DAY")} + 6 AS end_date
FROM lineitem""",
    "discounted_price": """SELECT transaction_id, sku, unit_price, discount_float,
CASE WHEN discount_float > 0 THEN CAST(round(CAST(CAST(unit_price * (1 - discount_float) AS VARCHAR) AS DECIMAL(38,16)), 2) AS DOUBLE)
ELSE unit_price END AS sale_price
FROM sales_discounted""",
    "history_features": "SELECT * FROM history",
    "future_features": "SELECT * FROM future",
    "all_features": "SELECT * FROM features",
    "labels": "SELECT * FROM label_rows",
    "holdout_split": """SELECT *, CASE WHEN week < (
  SELECT min(week) FROM (SELECT DISTINCT week FROM label_rows ORDER BY week DESC LIMIT 8)) THEN 'train' ELSE 'test' END AS part
FROM label_rows""",
    "training_set": "SELECT l.*, f.* EXCLUDE (sku, store_id, week) FROM label_rows l LEFT JOIN history f USING (sku, store_id, week)",
    "asof_features": """SELECT s.transaction_id, s.sku, s.store_id, s.date_id, f.rolling_4wk_avg, f.avg_demand_last_12w,
f.is_promoted FROM fact s ASOF LEFT JOIN features f ON s.sku = f.sku AND s.store_id = f.store_id AND s.date_id >= f.week""",
    "asof_score_features": """SELECT k.*, f.* EXCLUDE (sku, store_id, week) FROM keys k
ASOF LEFT JOIN features f ON k.sku = f.sku AND k.store_id = f.store_id AND k.week >= f.week""",
    "asof_carried_features": """SELECT k.*, f.* EXCLUDE (sku, store_id, week) FROM keys k
ASOF LEFT JOIN history f ON k.sku = f.sku AND k.store_id = f.store_id AND k.week >= f.week""",
    "forecast_demand": "SELECT * FROM forecast",
    "forecast_summary": """SELECT model_version, count(*) AS forecast_rows, count(*) FILTER (WHERE is_stockout_risk) AS stockout,
count(*) FILTER (WHERE is_overstock_risk) AS overstock FROM forecast GROUP BY model_version""",
    "baseline_mae": """SELECT count(*) AS holdout_rows,
round(avg(abs(total_quantity - avg_demand_last_12w)), 6) AS mae_naive_avg12w,
round(avg(abs(total_quantity - rolling_4wk_avg)), 6) AS mae_naive_rolling4w
FROM label_rows JOIN features USING (sku, store_id, week)
WHERE week >= (SELECT min(week) FROM (SELECT DISTINCT week FROM label_rows ORDER BY week DESC LIMIT 8))""",
    "action_list": "SELECT * FROM actions",
    "action_queue": "SELECT * FROM queue",
    "action_queue_filtered": "SELECT * FROM week_queue WHERE " + " AND ".join(
        f"{c} = '{v}'" for c, v in q.QUEUE_FILTERS.items() if v != "all"
    ) + " ORDER BY (risk_type = 'Stockout') DESC, abs(demand_delta) DESC, sku, store_id LIMIT 500",
    "queue_counts": """SELECT count(*) FILTER (WHERE risk_type = 'Stockout') AS stockout_count,
count(*) FILTER (WHERE risk_type = 'Overstock') AS overstock_count, count(*) FILTER (WHERE risk_type = 'Both') AS both_count
FROM week_queue""",
    "filter_options": " UNION ".join(f"SELECT '{c}' AS option, {c} AS value FROM week_queue" for c in q.QUEUE_OPTIONS),
    "risk_summary": """SELECT count(CASE WHEN is_stockout_risk THEN 1 END) AS stockout_count,
count(CASE WHEN is_overstock_risk THEN 1 END) AS overstock_count
FROM forecast WHERE week = (SELECT max(week) FROM forecast)""",
    "risk_detail": "SELECT * FROM detail",
    "risk_total": "SELECT count(store_id) AS at_risk FROM detail",
    "risk_by_category": "SELECT risk_type, category, count(store_id) AS at_risk FROM detail GROUP BY ALL",
    "risk_by_region": "SELECT risk_type, region, count(store_id) AS at_risk FROM detail GROUP BY ALL",
    "weekly_revenue": f"""SELECT {_WEEK_OF.format(d='date_id')} AS week_start, region, {_MONEY} AS weekly_revenue
FROM fact JOIN stores USING (store_id) GROUP BY ALL""",
    "category_revenue": f"SELECT category, {_MONEY} AS total_revenue FROM fact JOIN products USING (sku) GROUP BY ALL",
    "promo_lift": """SELECT category, 'Promoted' AS promo_type, avg(quantity_sold) AS avg_qty
FROM fact JOIN products USING (sku) WHERE is_promoted = 1 GROUP BY category
UNION ALL SELECT category, 'Baseline', avg(quantity_sold) FROM fact JOIN products USING (sku)
WHERE is_promoted = 0 GROUP BY category""",
    "active_promotions": f"{_PROMO_REPORT} WHERE is_active",
    "upcoming_promotions": f"{_PROMO_REPORT} WHERE is_future ORDER BY promo_start_date, promo_id LIMIT 50",
    "risk_dashboard": f"""SELECT week, store_name, region, sku, product_name, category, predicted_demand,
round(avg_demand_last_12w, 1) AS avg_demand_last_12w, is_stockout_risk, is_overstock_risk
FROM forecast JOIN stores USING (store_id) JOIN products USING (sku)
WHERE ({_RISK}) AND week = DATE '{q.DASHBOARD_WEEK}'""",
    "week_options": f"SELECT DISTINCT week FROM forecast WHERE {_RISK}",
    "explorer_options": f"""SELECT DISTINCT store_name, region, sku, product_name, category
FROM forecast JOIN stores USING (store_id) JOIN products USING (sku) WHERE {_RISK}""",
    "forecast_explorer": "SELECT * FROM explorer",
    "explorer_chart": """SELECT strftime(week, '%Y-%m-%d') AS week, actual_demand, predicted_demand, avg_demand_last_12w,
is_stockout_risk, is_overstock_risk FROM explorer""",
    "explorer_headline": """SELECT strftime(week, '%Y-%m-%d') AS forecast_week, predicted_demand, avg_demand_last_12w,
is_stockout_risk, is_overstock_risk FROM explorer WHERE predicted_demand IS NOT NULL ORDER BY week LIMIT 1""",
    "top_stores_stockout": """SELECT store_id, store_name, stockout_risk_skus FROM (
  SELECT *, rank() OVER (ORDER BY stockout_risk_skus DESC) AS place FROM (
    SELECT store_id, store_name, count(sku) AS stockout_risk_skus FROM forecast JOIN stores USING (store_id)
    WHERE is_stockout_risk GROUP BY ALL))
WHERE place <= 5""",
    "weeks_this": f"SELECT * FROM forecast WHERE week = {_WEEK_OF.format(d=f'''DATE '{FORECAST_AS_OF}' ''')}",
    "weeks_next": f"SELECT * FROM forecast WHERE week = {_WEEK_OF.format(d=f'''DATE '{FORECAST_AS_OF}' + 7''')}",
    "weeks_next_n": f"""SELECT * FROM forecast WHERE week >= {_WEEK_OF.format(d=f"DATE '{FORECAST_AS_OF}' + 7")}
AND week < {_WEEK_OF.format(d=f"DATE '{FORECAST_AS_OF}' + 7")} + 21""",
    "fact_sample": "SELECT * FROM fact ORDER BY transaction_id LIMIT 10",
    "layer_counts": " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count FROM {step}"
        for layer, name, step in [
            ("bronze", "bronze_products", "landing_products"), ("bronze", "bronze_stores", "landing_stores"),
            ("bronze", "bronze_promotions", "landing_promotions"),
            ("bronze", "bronze_transactions", "landing_transactions"),
            ("silver", "silver_products", "products"), ("silver", "silver_stores", "stores"),
            ("silver", "silver_promotions", "promotions"), ("silver", "silver_transactions", "transactions"),
            ("gold", "dim_product", "products"), ("gold", "dim_store", "stores"), ("gold", "fact_transactions", "fact"),
            ("gold", "fact_promotions", "promos"), ("gold", "forecast_demand", "forecast"),
            ("gold", "forecast_action_list", "actions"), ("feature", "weekly_demand_features", "features"),
        ]
    ),
    "risk_pairs_by_category": """SELECT category, count(*) FILTER (WHERE is_stockout_risk) AS stockout_pairs,
count(*) FILTER (WHERE is_overstock_risk) AS overstock_pairs FROM forecast JOIN products USING (sku)
WHERE week = (SELECT max(week) FROM forecast) GROUP BY category""",
    "forecast_by_region": f"""SELECT region, CAST(sum(predicted_demand) AS BIGINT) AS total_predicted_demand
FROM forecast JOIN stores USING (store_id) WHERE week = DATE '{FORECAST_AS_OF}' GROUP BY region""",
    "predicted_vs_actual": """SELECT category, avg_predicted_demand, avg_actual_demand
FROM (SELECT category, avg(predicted_demand) AS avg_predicted_demand FROM forecast JOIN products USING (sku) GROUP BY category)
FULL JOIN (SELECT category, avg(total_quantity) AS avg_actual_demand FROM weekly JOIN products USING (sku)
  WHERE week > (SELECT data_end FROM ends) - 84 GROUP BY category) USING (category)""",
    "top_products_forecast": f"""SELECT sku, product_name, CAST(sum(predicted_demand) AS BIGINT) AS total_predicted_demand
FROM forecast JOIN products USING (sku) WHERE week = DATE '{FORECAST_AS_OF}' GROUP BY ALL
ORDER BY total_predicted_demand DESC, sku LIMIT 10""",
    "category_revenue_weekly": f"""SELECT {_WEEK_OF.format(d='date_id')} AS week_start, category, {_MONEY} AS total_revenue
FROM fact JOIN products USING (sku) GROUP BY ALL""",
    "top_stores_at_risk": f"""SELECT store_id, store_name, count(sku) AS at_risk_skus FROM forecast JOIN stores USING (store_id)
WHERE ({_RISK}) AND week = (SELECT max(week) FROM forecast) GROUP BY ALL""",
    "discount_vs_quantity": """SELECT discount_float AS discount_pct, count(*) AS sales,
CAST(sum(quantity_sold) AS BIGINT) AS units, avg(quantity_sold) AS avg_quantity FROM sales_discounted GROUP BY discount_float""",
    "stores_stockout_next_week": f"""SELECT week, store_id, store_name, count(sku) AS stockout_skus
FROM forecast JOIN stores USING (store_id)
WHERE is_stockout_risk AND week = {_WEEK_OF.format(d=f"DATE '{FORECAST_AS_OF}' + 7")} GROUP BY ALL""",
    "date_parts": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, d AS date_id, CAST(year(d) AS INTEGER) AS year,
CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, {_WEEK_OF.format(d='d')} AS week
FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
    "scalar_probe": """SELECT p_partkey, p_brand || '::' || p_size AS joined, replace(p_brand, 'Brand#', '') AS stripped,
regexp_matches(p_brand, '^Brand#1[0-9]$') AS matches, starts_with(p_name, 'p') AS starts,
greatest(0, p_size - 25) AS floored, abs(p_size - 25) AS distance, round(p_retailprice / 4, 1) AS rounded,
CAST(p_size AS DOUBLE) AS as_double, CAST(p_size > 25 AS INTEGER) AS as_int,
CASE WHEN p_size > 40 THEN p_brand END AS null_unless_large, CASE WHEN p_size > 40 THEN p_size ELSE -1 END AS filled,
['a', 'b', 'c'][p_size % 3 + 1] AS picked, try_cast(p_type AS INTEGER) AS unreadable FROM part""",
    "action_status_stream": "SELECT * FROM status_table",
}
_MODEL_VERSION, _MODEL = max(q.SAVED_MODELS.items())
_RAW = (
    "exp({intercept} + {log_4wk} * ln(1 + rolling_4wk_avg) + {log_12wk} * ln(1 + avg_demand_last_12w) + {promoted} * is_promoted "
    "+ {discount_pct_feat} * discount_pct_feat + {season_sin} * sin(2 * pi() * week_of_year / 52) "
    "+ {season_cos} * cos(2 * pi() * week_of_year / 52))"
).format(**{name: f"{value}::DOUBLE" for name, value in _MODEL.items()})
TAILS["saved_model_forecast"] = f"""
SELECT sku, store_id, week, predicted_demand, avg_demand_last_12w,
       predicted_demand > avg_demand_last_12w * 1.3 AND avg_demand_last_12w > 0 AS is_stockout_risk,
       predicted_demand < avg_demand_last_12w * 0.7 AND avg_demand_last_12w > 0 AS is_overstock_risk,
       'glm_poisson_v{_MODEL_VERSION}' AS model_version
FROM (SELECT *, CAST(greatest(0, round({_RAW})) AS INTEGER) AS predicted_demand FROM future)"""
TAILS["model_choice_rows"] = f"""
SELECT model, count(*) FILTER (WHERE part = 'train') AS train_rows, count(*) FILTER (WHERE part = 'test') AS holdout_rows,
       (SELECT count(*) FROM future) AS scored_rows
FROM ({TAILS["holdout_split"]}) CROSS JOIN (VALUES ('boosted_trees'), ('glm_poisson')) m(model) GROUP BY model"""
TAILS["risk_dashboard_bound"], TAILS["forecast_explorer_bound"] = TAILS["risk_dashboard"], TAILS["forecast_explorer"]
TAILS["silver_stream_transactions"] = "SELECT * FROM transactions"
TAILS["quality_stream_violations"] = TAILS["quality_violations"].replace("typed_spoiled", "typed_deliveries")
TAILS["scd1_stream_transactions"] = TAILS["scd1_transactions"]


def _with(tail: str) -> str:
    """Put the steps a query uses, directly or through other steps, in front of it."""
    needed: set[str] = set()
    queue = [tail]
    while queue:
        words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", queue.pop())))
        for step in words & STEPS.keys() - needed:
            needed.add(step)
            queue.append(STEPS[step])
    chain = [f"{name} AS ({sql.strip()})" for name, sql in _in_order(needed)]
    return (f"WITH {', '.join(chain)}\n" if chain else "") + tail.strip()


def _in_order(needed: set[str]) -> list[tuple[str, str]]:
    done: list[tuple[str, str]] = []
    placed: set[str] = set()

    def place(step: str) -> None:
        if step in placed:
            return
        placed.add(step)
        for word in re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", STEPS[step])):
            if word in STEPS and word != step:
                place(word)
        done.append((step, STEPS[step]))

    for step in STEPS:
        if step in needed:
            place(step)
    return done


def oracle_sql() -> dict[str, str]:
    return {name: _with(tail) for name, tail in TAILS.items()}
