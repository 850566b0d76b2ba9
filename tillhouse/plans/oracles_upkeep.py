"""The queries of ``queries_upkeep.py`` in plain SQL over the same tables."""

from __future__ import annotations

from tillhouse.plans import oracles as o
from tillhouse.plans import oracles_stored  # noqa: F401  whose SQL is used below
from tillhouse.plans.oracles import ORACLES


def _changed(unit: str, step: str) -> str:
    return f"""
WITH {o.DAYS}, after AS (
  SELECT *, CASE WHEN n % 5 <> 0 AND n % 11 = 2 THEN 10 ELSE 0 END AS more
  FROM (SELECT *, day(time_period_end_date) AS n FROM days) WHERE NOT (n % 5 <> 0 AND n % 7 = 3 AND n % 11 <> 2))
SELECT prod_id, site_id, data_provider_code, CAST(date_trunc('{unit}', time_period_end_date) + INTERVAL {step} AS DATE) AS time_period_end_date,
       CAST(arg_max(CASE WHEN n % 2 = 0 THEN 110011 ELSE 110013 END, time_period_end_date) AS INTEGER) AS secure_group_key,
       CAST(sum(pos_sales_units + more) AS BIGINT) AS pos_sales_units, round(sum(pos_sales_value_usd), 2) AS pos_sales_value_usd
FROM after GROUP BY 1, 2, 3, 4"""


ORACLES["rollup_by_delta"] = _changed("week", "7 DAY")
ORACLES["rollup_month_by_delta"] = _changed("month", "1 MONTH")
ORACLES["mask_by_tails"] = ORACLES["mask_volume_daily"]
ORACLES["fact_stream_upsert"] = "\nUNION ALL BY NAME\n".join(
    f"SELECT '{grain}' AS grain, * FROM ({ORACLES[f'gold_{grain}_fact']})" for grain in ("day", "week", "month")
)

ORACLES["pit_join_odd_dates"] = f"""
WITH {o.PROD_SCD}, {o.FACTS},
f AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN DATE '0001-01-01' WHEN l_orderkey % 89 = 0 THEN DATE '1900-01-01'
                             WHEN l_orderkey % 83 = 0 THEN DATE '2999-12-31' ELSE time_period_end_date END AS time_period_end_date) FROM facts),
v AS (SELECT prod_id, prod_key, CAST(valid_from AS TIMESTAMP) AS a, CAST(valid_to AS TIMESTAMP) AS b FROM pv3)
SELECT f.* REPLACE (CAST(time_period_end_date AS VARCHAR) AS time_period_end_date), prod_key
FROM f LEFT JOIN v ON v.prod_id = f.prod_id AND a <= CAST(time_period_end_date AS TIMESTAMP) AND (b IS NULL OR CAST(time_period_end_date AS TIMESTAMP) < b)"""

ORACLES["metrics_by_sketch"] = """
SELECT event_type, count(*) AS rows, CAST(count(*) AS BIGINT) AS row_count, count(DISTINCT user_id) AS user_id, count(DISTINCT event_id) AS event_id,
       TRUE AS user_id_near, TRUE AS event_id_near
FROM events WHERE event_type IS NOT NULL GROUP BY 1"""
ORACLES["rls_view"] = ORACLES["rls_grants"]
ORACLES["dim_at_function"] = ORACLES["dim_asof"]
