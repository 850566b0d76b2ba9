"""The queries of ``queries_stored.py`` in plain SQL over the same tables."""

from __future__ import annotations

from tillhouse.plans import oracles as o
from tillhouse.plans.oracles import ORACLES

LATER = "'2002-02-01 00:00:00'"
EPOCH = "'1900-01-01 00:00:00'"

AT_INSTANTS = f"""
WITH {o.PROD_SCD},
f AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(3 * l_linenumber AS BIGINT)) AS sold,
             '1001' || l_partkey AS prod_id FROM lineitem),
v AS (SELECT prod_id, prod_key, CAST(valid_to AS TIMESTAMP) + INTERVAL 10 HOUR AS b,
             CAST(valid_from AS TIMESTAMP) + CASE WHEN valid_from = {EPOCH} THEN INTERVAL 0 HOUR ELSE INTERVAL 10 HOUR END AS a
      FROM pv3)
SELECT l_orderkey, l_linenumber, strftime(sold, '%Y-%m-%d %H:%M:%S') AS sold_at, f.prod_id, prod_key
FROM f JOIN v ON v.prod_id = f.prod_id AND a <= sold AND (b IS NULL OR sold < b)"""
ORACLES["pit_join_timestamp"] = AT_INSTANTS
ORACLES["pit_join_timestamp_shuffled"] = AT_INSTANTS

MONTH = "CAST(greatest(least(date_trunc('month', time_period_end_date), DATE '2001-12-01'), DATE '1995-01-01') AS DATE)"
ORACLES["pit_join_many_versions"] = f"""
WITH {o.FACTS} SELECT *, {o.key('site_id', MONTH)} AS site_key FROM facts"""

ORACLES["rollup_week_two_groups"] = f"""
WITH {o.DAYS}, periods AS (
  SELECT prod_id, site_id, data_provider_code,
         CAST(date_trunc('week', time_period_end_date) + INTERVAL 7 DAY AS DATE) AS week,
         CAST(arg_max(CASE WHEN day(time_period_end_date) % 2 = 0 THEN 110011 ELSE 110013 END, time_period_end_date) AS INTEGER) AS secure_group_key,
         CAST(sum(pos_sales_units) AS BIGINT) AS pos_sales_units, round(sum(pos_sales_value_usd), 2) AS pos_sales_value_usd
  FROM days GROUP BY 1, 2, 3, 4),
named AS (SELECT * EXCLUDE (week), week AS time_period_end_date FROM periods)
SELECT *, {o.LOADED} AS created_at_utc_datetime, {o.LOADED_DAY} AS created_at_date, 'aggregation' AS data_source,
       {o.moving('pos_sales_units', 4, True)} FROM named"""

ORACLES["new_partitions_null"] = """
WITH found AS (SELECT DISTINCT CASE WHEN event_id % 10 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS partition_key FROM events)
SELECT partition_key, 'events_' || coalesce(partition_key, '__null__') AS run_key, CAST(1 AS INTEGER) AS pass
FROM found WHERE partition_key IS NULL OR partition_key >= '2024-01-15'"""

ORACLES["scd2_null_key"] = f"""
WITH batch AS (
  SELECT CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS prod_id, 'cds_1001' AS data_provider_code,
         p_name AS source_prod_name, p_type AS source_category FROM part),
one AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY prod_id ORDER BY source_prod_name NULLS FIRST, source_category NULLS FIRST) AS r
  FROM batch) WHERE r = 1)
SELECT *, {o.key('prod_id', 'source_category', 'source_prod_name')} AS prod_key, TRUE AS is_current, {EPOCH} AS valid_from,
       CAST(NULL AS VARCHAR) AS valid_to FROM one"""

ORACLES["gold_mask_by_age"] = f"""
WITH gold AS ({ORACLES['gold_day_fact']}), marked AS (SELECT *, time_period_end_date > DATE '2001-11-05' - 365 AS recent FROM gold)
SELECT * EXCLUDE (recent, at_masked_pos_sales_units, at_masked_pos_sales_value_usd, at_masked_pos_sales_value_lc) REPLACE (
  CASE WHEN recent AND data_provider_code = 'cds_1002' THEN at_masked_pos_sales_units ELSE pos_sales_units END AS pos_sales_units,
  CASE WHEN recent AND data_provider_code = 'cds_1001' THEN at_masked_pos_sales_value_usd ELSE pos_sales_value_usd END AS pos_sales_value_usd,
  CASE WHEN recent AND data_provider_code = 'cds_1001' THEN at_masked_pos_sales_value_lc ELSE pos_sales_value_lc END AS pos_sales_value_lc)
FROM marked"""

ORACLES["rejected_rows"] = """
SELECT * FROM (
  SELECT CASE l_returnflag WHEN 'A' THEN 'cds_1001' WHEN 'N' THEN 'cds_1002' ELSE 'cds_1003' END AS data_provider_code,
         CASE WHEN l_suppkey % 7 = 0 THEN '2001-13-01' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS store_id,
         CASE WHEN l_partkey % 10 = 0 THEN 'many' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS amount,
         concat_ws(',', CASE WHEN l_suppkey % 7 = 0 THEN 'date' END,
                   CASE WHEN l_partkey % 10 = 0 THEN CASE l_returnflag WHEN 'R' THEN 'inventory_qty' ELSE 'sales_qty' END END) AS rejected
  FROM lineitem) WHERE rejected <> ''"""

ORACLES["rls_grants"] = """
WITH items AS (
  SELECT l_orderkey, l_linenumber,
         CAST(CASE l_returnflag WHEN 'A' THEN 110011 WHEN 'N' THEN 0 ELSE 110013 END AS INTEGER) AS secure_group_key FROM lineitem)
SELECT * FROM items WHERE secure_group_key = 0
  OR secure_group_key IN (SELECT 110011 + n_nationkey % 4 FROM nation WHERE n_nationkey % 2 = 0)"""

ORACLES["stored_upsert"] = f"""
SELECT *, CAST(year(sold_on) AS INTEGER) AS sold_year FROM ({ORACLES['upsert_fact']})"""

ORACLES["append_new_columns"] = f"""
SELECT event_id, user_id, {', '.join(f"CASE WHEN event_id % 2 = 1 THEN {c} END AS {c}" for c in ('ts', 'event_type', 'value', 'props'))}
FROM (SELECT {o.EVENTS_TEXT} FROM events)"""

ORACLES["new_files"] = f"SELECT {o.EVENTS_TEXT}, CAST(event_id % 2 AS INTEGER) AS arrival FROM events"

def _ones(p: int) -> str:
    """One row per key of a provider's sales."""
    return f"""raw{p} AS ({o.SALES[p]} FROM lineitem WHERE l_returnflag = '{o.FLAGS[p]}'),
one{p} AS (SELECT * FROM (SELECT *, row_number() OVER (
   PARTITION BY time_period_end_date, prod_id, site_id ORDER BY {o.TIES[p]}) AS r FROM raw{p}) WHERE r = 1)"""


ORACLES["gold_with_base"] = f"""
WITH {", ".join(_ones(p) for p in o.FLAGS)}
SELECT * REPLACE (CASE WHEN time_period_end_date < DATE '1999-01-01' THEN 'stored' ELSE data_source END AS data_source) FROM (
{" UNION ALL BY NAME ".join(f"SELECT time_period_end_date, prod_id, site_id, {o.provenance(p)}, {o._unrounded(o.gold_columns(p, []))} FROM one{p}" for p in o.FLAGS)})"""

AGAIN = "time_period_end_date >= DATE '1999-12-01'"
ORACLES["refresh_twice"] = f"""
WITH {", ".join(_ones(p) for p in o.FLAGS)}
SELECT * REPLACE (CASE WHEN {AGAIN} THEN {LATER} ELSE created_at_utc_datetime END AS created_at_utc_datetime,
                  CASE WHEN {AGAIN} THEN DATE '2002-02-01' ELSE created_at_date END AS created_at_date) FROM (
{" UNION ALL BY NAME ".join(f"SELECT time_period_end_date, prod_id, site_id, {o.provenance(p)}, {o.gold_columns(p, [f'at_masked_{c}' for c in o.MASKED[p]])} FROM {o.masked_rows(p, f'one{p}', 7)}" for p in o.FLAGS)})"""


def _products_of(p: int, values: dict, current: str, start: str, end: str, where: str) -> str:
    d = o.DIM["prod"]
    tracked = [values[c] for c in sorted(values) if c != "extra_attributes"]
    columns = ", ".join(f"{values[c]} AS {c}" if c in values else f"CAST(NULL AS {t}) AS {c}" for c, t in d["columns"].items())
    return f"""SELECT '{p}' || {d['own']} AS prod_id, {o.provenance(p)}, {o.key(f"'{p}' || {d['own']}", *tracked)} AS prod_key, {current} AS is_current,
  {start} AS valid_from, {end} AS valid_to, {columns}
FROM products p LEFT JOIN master m ON {d['master_on']}
WHERE {where} AND EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = '{o.FLAGS[p]}' AND l_partkey = p.product_id)"""


def _values_of(p: int, corp: bool) -> dict:
    d = o.DIM["prod"]
    if p == 1001:
        return {d["first"]: d["values"][d["first"]]}
    return d["values"] | (d["corp"] if corp else {}) | ({"extra_attributes": d["extra"]} if p == 1003 else {})


def _prod_versions() -> str:
    """Products of all providers: unchanged ones, and old and new versions of those whose master changed."""
    none, parts = "CAST(NULL AS VARCHAR)", []
    for p in o.FLAGS:
        values = _values_of(p, True)
        if p == 1001:  # sends no number by which the master could be met
            parts.append(_products_of(p, values, "TRUE", EPOCH, none, "TRUE"))
            continue
        parts.append(_products_of(p, values, "TRUE", EPOCH, none, "m.item_gtin IS NULL"))
        parts.append(_products_of(p, values, "FALSE", EPOCH, LATER, "m.item_gtin IS NOT NULL"))
        parts.append(_products_of(p, values | {"corp_category": "m.category || ' new'"}, "TRUE", LATER, none, "m.item_gtin IS NOT NULL"))
    return f"WITH {o.PRODUCTS}, {o.PRODUCT_MASTER}\n" + "\nUNION ALL BY NAME\n".join(parts)


ORACLES["prod_dim_second_batch"] = _prod_versions()
ORACLES["dim_stream_upsert"] = f"WITH {o.PRODUCTS}, {o.PRODUCT_MASTER}\n" + "\nUNION ALL BY NAME\n".join(
    _products_of(p, _values_of(p, False), "TRUE", EPOCH, "CAST(NULL AS VARCHAR)", "TRUE") for p in o.FLAGS
)


def _star(category: str, current: str, start: str, end: str, where: str) -> str:
    return f"""SELECT '1001' || p_partkey AS prod_id, 'cds_1001' AS data_provider_code, p_name AS source_prod_name, {category} AS source_category,
  {o.key("'1001' || p_partkey", category, 'p_name')} AS prod_key, {current} AS is_current, {start} AS valid_from, {end} AS valid_to
FROM part WHERE {where}"""


NONE = "CAST(NULL AS VARCHAR)"
ORACLES["star_feed_full_refresh"] = "\nUNION ALL\n".join(
    [
        _star("p_type", "TRUE", EPOCH, NONE, "p_partkey % 2 <> 0"),
        _star("p_type", "FALSE", EPOCH, LATER, "p_partkey % 2 = 0"),
        _star("p_type || ' new'", "TRUE", LATER, NONE, "p_partkey % 2 = 0"),
    ]
)
ORACLES["star_feed_increment"] = _star("p_type", "TRUE", EPOCH, NONE, "TRUE")
