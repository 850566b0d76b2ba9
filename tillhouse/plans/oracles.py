"""The queries of ``queries.py`` in plain SQL over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

LOADED = "'2002-01-01 00:00:00'"
LOADED_DAY = "DATE '2002-01-01'"
FLAGS = {1001: "A", 1002: "N", 1003: "R"}
GROUPS = {1001: 110011, 1002: 110012, 1003: 110013}
SOURCES = {1001: "uploader", 1002: "uploader", 1003: "delta-share"}


def key(*columns: str) -> str:
    """The md5 form of the surrogate key."""
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def provenance(provider: int) -> str:
    return (
        f"{LOADED} AS created_at_utc_datetime, {LOADED_DAY} AS created_at_date, "
        f"'{SOURCES[provider]}' AS data_source, 'cds_{provider}' AS data_provider_code, "
        f"CAST({GROUPS[provider]} AS INTEGER) AS secure_group_key"
    )


# Products and stores as the feeds describe them.
PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product, p_type AS category, p_brand AS sector,
         CAST(DATE '1990-01-01' + CAST(p_size AS INTEGER) AS DATE) AS launch_date, p_partkey AS gtin,
         p_brand || ' ' || p_name AS description, p_size AS size, p_type, p_brand
  FROM part)"""
STORES = """
stores AS (
  SELECT s_suppkey AS store_id, s_name AS store, n_name AS city, s_name || ', ' || n_name AS address,
         r_name AS channel, s_acctbal AS latitude, s_acctbal / 2 AS longitude, s_suppkey AS gln,
         n_nationkey AS nation_number
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey)"""

PRODUCT_MASTER = """
master AS (
  SELECT CAST(p_partkey AS BIGINT) AS item_gtin, p_name AS prod_name, p_brand AS sector, p_type AS category,
         p_brand || ' ' || p_name AS item_description
  FROM part
  WHERE CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) < 1288490188)"""
SITE_MASTER = """
master AS (
  SELECT CAST(gln AS BIGINT) AS global_location_number, store AS site_name, address, channel, latitude, longitude
  FROM stores
  WHERE CAST('0x' || substr(md5(CAST(gln AS VARCHAR)), 1, 8) AS BIGINT) < 1288490188)"""

# Conformed facts per provider, before copies are dropped.
SALES = {
    1001: """SELECT CAST(l_shipdate AS DATE) AS time_period_end_date, '1001' || l_partkey AS prod_id,
       '1001' || l_suppkey AS site_id, CAST(l_quantity AS BIGINT) AS pos_sales_units,
       l_extendedprice AS pos_sales_value_usd, l_partkey, l_suppkey""",
    1002: """SELECT CAST(l_shipdate AS DATE) AS time_period_end_date, '1002' || l_partkey AS prod_id,
       '1002' || l_suppkey AS site_id, CAST(l_quantity AS BIGINT) AS pos_sales_units,
       l_extendedprice AS pos_sales_value_usd, l_extendedprice / 2 AS pos_sales_value_lc,
       CAST(l_linenumber AS BIGINT) AS returned_qty, l_discount AS returned_value_lc, l_partkey, l_suppkey""",
    1003: """SELECT CAST(l_shipdate AS DATE) AS time_period_end_date, '1003' || l_partkey AS prod_id,
       '1003' || l_suppkey AS site_id, CAST(l_quantity AS BIGINT) AS inventory_qty_on_hand,
       CAST(l_linenumber AS BIGINT) AS inventory_qty_on_order,
       l_extendedprice AS inventory_value_on_hand_usd, l_extendedprice / 2 AS inventory_value_on_hand_lc,
       CAST(json_object(
         'safety_stock_qty', CAST(l_linenumber AS VARCHAR),
         'cycle_count_variance_qty', CAST(l_linenumber AS VARCHAR),
         'inventory_accuracy_pct', l_linestatus,
         'days_of_supply', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
         'shrinkage_qty', CAST(NULL AS VARCHAR),
         'reserved_qty_for_online', CAST(l_linenumber AS VARCHAR),
         'backroom_qty', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS VARCHAR) AS extra_attributes,
       l_linenumber, l_linestatus, l_partkey, l_suppkey""",
}
# Order that decides between rows with the same date, product and store.
TIES = {
    1001: "pos_sales_units, pos_sales_value_usd",
    1002: "pos_sales_units, pos_sales_value_usd, pos_sales_value_lc, returned_qty, returned_value_lc",
    1003: "inventory_qty_on_hand, inventory_qty_on_order, inventory_value_on_hand_usd, l_linestatus",
}
MEASURES = {
    1001: ["pos_sales_units", "pos_sales_value_usd"],
    1002: ["pos_sales_units", "pos_sales_value_usd", "pos_sales_value_lc", "returned_qty", "returned_value_lc"],
    1003: [
        "inventory_qty_on_hand", "inventory_qty_on_order",
        "inventory_value_on_hand_usd", "inventory_value_on_hand_lc",
    ],
}
ALL_MEASURES = {
    "pos_sales_units": "BIGINT", "pos_sales_value_usd": "DOUBLE", "pos_sales_value_lc": "DOUBLE",
    "returned_qty": "BIGINT", "returned_value_usd": "DOUBLE", "returned_value_lc": "DOUBLE",
    "inventory_qty_on_hand": "BIGINT", "inventory_qty_on_order": "BIGINT",
    "inventory_value_on_hand_usd": "DOUBLE", "inventory_value_on_hand_lc": "DOUBLE",
}
MASKS = {
    "at_masked_pos_sales_units": "BIGINT",
    "at_masked_pos_sales_value_usd": "DOUBLE",
    "at_masked_pos_sales_value_lc": "DOUBLE",
}


def declared(columns: dict[str, str], have: list[str]) -> str:
    return ", ".join(
        (f"round({c}, 4) AS {c}" if t == "DOUBLE" else c) if c in have else f"CAST(NULL AS {t}) AS {c}"
        for c, t in columns.items()
    )


def moving(column: str, size: int, volume: bool) -> str:
    frame = (
        "OVER (PARTITION BY prod_id, site_id ORDER BY time_period_end_date "
        f"ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    )
    mean = f"CASE WHEN count({column}) {frame} = {size} THEN avg({column}) {frame} END"
    text = f"CAST(round_even({mean}, 0) AS BIGINT)" if volume else mean
    return f"{text} AS at_masked_{column}"


# Raw layer and conformance

def texts(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
ORACLES["bronze_ingest"] = f"""
SELECT {texts(*LINEITEM)}, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, {provenance(1001)}
FROM lineitem"""


def conformed(ids: str) -> str:
    """All providers' facts by name; ``ids`` replaces the id columns."""
    return "\nUNION ALL BY NAME\n".join(
        f"""SELECT time_period_end_date, {ids}, {", ".join(MEASURES[p])},
  {"extra_attributes" if p == 1003 else "CAST(NULL AS VARCHAR) AS extra_attributes"}, {provenance(p)}
FROM ({SALES[p]} FROM lineitem WHERE l_returnflag = '{FLAGS[p]}')"""
        for p in FLAGS
    )


ORACLES["conform_fact"] = conformed("prod_id, site_id")
ORACLES["json_feed"] = conformed("CAST(l_partkey AS VARCHAR) AS prod_id, CAST(l_suppkey AS VARCHAR) AS site_id")
ORACLES["delimited_feed"] = ORACLES["json_feed"]

ORACLES["extra_attributes_json"] = """
SELECT p_partkey AS product_id,
       CAST(json_object('product', p_name, 'package_material', p_type, 'is_bundle', CAST(NULL AS VARCHAR),
                        'brand_marketing_tier', p_brand) AS VARCHAR) AS extra_attributes
FROM part"""

# Distinct

EVENTS_TEXT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props"
ORACLES["dedupe_full"] = f"""
SELECT {EVENTS_TEXT} FROM (SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events))"""
ORACLES["dedupe_latest"] = f"""
WITH twice AS (SELECT * FROM events UNION ALL SELECT * FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
             ORDER BY ts DESC NULLS LAST, event_id ASC NULLS FIRST, value ASC NULLS FIRST, props ASC NULLS FIRST) AS r
           FROM twice)
SELECT {EVENTS_TEXT} FROM ranked WHERE r = 1"""

# Master data

ORACLES["master_build"] = f"WITH {PRODUCT_MASTER} SELECT * FROM master"
ORACLES["site_master_build"] = f"WITH {STORES}, {SITE_MASTER} SELECT * FROM master"
ENRICHED_PRODUCT = f"""
WITH {PRODUCT_MASTER}
SELECT CAST(p_partkey AS VARCHAR) AS prod_id, p_name AS source_prod_name, CAST(p_partkey AS BIGINT) AS source_item_gtin,
       m.prod_name AS corp_prod_name, m.sector AS corp_sector, m.category AS corp_category,
       m.item_description AS corp_item_description
FROM part LEFT JOIN master m ON m.item_gtin = p_partkey"""
ORACLES["master_enrich_product"] = ENRICHED_PRODUCT
ORACLES["master_enrich_site"] = f"""
WITH {STORES}, {SITE_MASTER}
SELECT CAST(store_id AS VARCHAR) AS site_id, store AS source_site_name, CAST(gln AS BIGINT) AS source_global_location_number,
       m.site_name AS corp_site_name, m.address AS corp_address, m.channel AS corp_channel,
       m.latitude AS corp_latitude, m.longitude AS corp_longitude
FROM stores LEFT JOIN master m ON m.global_location_number = gln"""

# Dimension versions

CUTS = ["1995-04-01", "2001-07-01", "2002-01-01"]


def scd(source_key: str, table: str, table_key: str, name: str, nk: str, sk: str, attrs: tuple[str, str], p: str) -> str:
    """Common table expressions ``{p}in``, ``{p}d2``, ``{p}v1`` to ``{p}v3``."""
    name_col, status_col = attrs
    cols = f"{nk}, data_provider_code, {name_col}, {status_col}, {sk}"
    start = "'1900-01-01 00:00:00'"
    tracked = sorted(attrs)
    parts = [
        f"""
{p}seen AS (
  SELECT {source_key} AS k, l_linestatus AS status,
         CASE WHEN l_shipdate < TIMESTAMP '{CUTS[0]}' THEN 1 WHEN l_shipdate < TIMESTAMP '{CUTS[1]}' THEN 2 ELSE 3 END AS b,
         l_shipdate AS seen_at FROM lineitem),
{p}last AS (
  SELECT k, b, status FROM (
    SELECT *, row_number() OVER (PARTITION BY b, k ORDER BY seen_at DESC, status ASC NULLS FIRST) AS r FROM {p}seen) WHERE r = 1),
{p}rows AS (
  SELECT b, '1001' || k AS {nk}, 'cds_1001' AS data_provider_code, {name} AS {name_col}, status AS {status_col}
  FROM {p}last LEFT JOIN {table} ON {table_key} = k),
{p}in AS (SELECT *, {key(nk, *tracked)} AS {sk} FROM {p}rows),
{p}v1 AS (SELECT {cols}, TRUE AS is_current, {start} AS valid_from, CAST(NULL AS VARCHAR) AS valid_to FROM {p}in WHERE b = 1)"""
    ]
    for run in (2, 3):
        at = f"'{CUTS[run - 1]} 00:00:00'"
        old = f"{p}v{run - 1}"
        parts.append(
            f"""
{p}n{run} AS (SELECT * FROM {p}in i WHERE b = {run} AND NOT EXISTS (SELECT 1 FROM {old} v WHERE v.{nk} = i.{nk} AND v.{sk} = i.{sk})),
{p}d{run} AS (
  SELECT {cols}, TRUE AS is_current,
         CASE WHEN EXISTS (SELECT 1 FROM {old} v WHERE v.{nk} = n.{nk} AND v.is_current) THEN {at} ELSE {start} END AS valid_from,
         CAST(NULL AS VARCHAR) AS valid_to
  FROM {p}n{run} n
  UNION ALL
  SELECT {cols}, FALSE, valid_from, {at} FROM {old} v
  WHERE is_current AND EXISTS (SELECT 1 FROM {p}n{run} n WHERE n.{nk} = v.{nk})),
{p}v{run} AS (
  SELECT * FROM {old} v WHERE NOT EXISTS (SELECT 1 FROM {p}d{run} d WHERE d.{nk} = v.{nk} AND d.{sk} = v.{sk})
  UNION ALL SELECT * FROM {p}d{run})"""
        )
    return ",".join(parts)


PROD_SCD = scd(
    "l_partkey", "part", "p_partkey", "p_name", "prod_id", "prod_key", ("source_prod_name", "source_category"), "p"
)
SITE_SCD = scd(
    "l_suppkey", "supplier", "s_suppkey", "s_name", "site_id", "site_key", ("source_site_name", "source_channel"), "s"
)

ORACLES["scd2_hash_key"] = f"SELECT p_partkey, {key('p_partkey', 'p_brand', 'p_name', 'p_type')} AS prod_key FROM part"
ORACLES["scd2_initial"] = f"WITH {PROD_SCD} SELECT * FROM pv1"
ORACLES["scd2_delta"] = f"WITH {PROD_SCD} SELECT * FROM pd2"
ORACLES["scd2_apply"] = f"WITH {PROD_SCD} SELECT * FROM pv3"
ORACLES["dim_current_product"] = f"WITH {PROD_SCD} SELECT * FROM pv3 WHERE is_current"
ORACLES["dim_current"] = f"WITH {SITE_SCD} SELECT * FROM sv3 WHERE is_current"
ORACLES["dim_asof"] = f"""
WITH {PROD_SCD} SELECT * FROM pv3
WHERE valid_from <= '2001-09-15 12:00:00' AND (valid_to IS NULL OR valid_to > '2001-09-15 12:00:00')"""


# With reverted products reopened every change of state is a version: the batches in
# which a product's state differs from the one before.
ORACLES["scd2_reopen"] = f"""
WITH {PROD_SCD},
states AS (
  SELECT *, prod_key AS state, lag(prod_key) OVER (PARTITION BY prod_id ORDER BY b) AS before FROM pin),
starts AS (
  SELECT *, CASE WHEN before IS NULL THEN '1900-01-01 00:00:00'
                 WHEN b = 2 THEN '{CUTS[1]} 00:00:00' ELSE '{CUTS[2]} 00:00:00' END AS valid_from
  FROM states WHERE before IS NULL OR before <> state)
SELECT prod_id, data_provider_code, source_prod_name, source_category,
       CASE WHEN before IS NULL THEN state ELSE {key('state', 'valid_from')} END AS prod_key,
       lead(valid_from) OVER w IS NULL AS is_current, valid_from, lead(valid_from) OVER w AS valid_to
FROM starts WINDOW w AS (PARTITION BY prod_id ORDER BY b)"""

# Facts and dimensions

FACTS = """
facts AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS time_period_end_date, '1001' || l_partkey AS prod_id,
         '1001' || l_suppkey AS site_id, CAST(l_quantity AS BIGINT) AS pos_sales_units FROM lineitem)"""


def valid(v: str) -> str:
    return (
        f"CAST({v}.valid_from AS TIMESTAMP) <= f.time_period_end_date "
        f"AND ({v}.valid_to IS NULL OR f.time_period_end_date < CAST({v}.valid_to AS TIMESTAMP))"
    )


KEYED = f"""
WITH {PROD_SCD}, {SITE_SCD}, {FACTS}
SELECT f.*, p.prod_key, s.site_key FROM facts f
JOIN pv3 p ON p.prod_id = f.prod_id AND {valid('p')}
JOIN sv3 s ON s.site_id = f.site_id AND {valid('s')}"""
ORACLES["pit_join_fact"] = KEYED
ORACLES["pit_join_fact_shuffled"] = KEYED
ORACLES["ri_orphans"] = f"""
WITH {PROD_SCD}, {FACTS}
SELECT f.* FROM facts f WHERE NOT EXISTS (SELECT 1 FROM pv1 p WHERE p.prod_id = f.prod_id AND {valid('p')})"""
ORACLES["history_join"] = f"""
WITH {PROD_SCD}, {FACTS}
SELECT p.source_category, CAST(sum(f.pos_sales_units) AS BIGINT) AS units
FROM facts f JOIN pv3 p ON p.prod_id = f.prod_id AND {valid('p')} GROUP BY 1"""
ORACLES["current_join"] = f"""
WITH {PROD_SCD}, {FACTS}
SELECT p.source_category, CAST(sum(f.pos_sales_units) AS BIGINT) AS units
FROM facts f JOIN pv3 p ON p.prod_id = f.prod_id AND p.is_current GROUP BY 1"""
STAR = """
SELECT n_name, c_mktsegment, CAST(count(*) AS BIGINT) AS order_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_value
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2"""
ORACLES["star_feed_join"] = STAR
ORACLES["star_feed_join_shuffled"] = STAR
ORACLES["star_feed_files"] = """
SELECT p_brand AS sector, n_name AS city, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
     LEFT JOIN nation ON n_nationkey = s_nationkey
GROUP BY 1, 2"""

# Masks and roll-ups

DAYS = """
days AS (
  SELECT p_brand AS prod_id, CAST(s_nationkey AS VARCHAR) AS site_id, CAST(l_shipdate AS DATE) AS time_period_end_date,
         CAST(sum(l_quantity) AS BIGINT) AS pos_sales_units, round(sum(l_extendedprice), 2) AS pos_sales_value_usd,
         'cds_1001' AS data_provider_code, CAST(110011 AS INTEGER) AS secure_group_key
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3)"""
ORACLES["mask_volume_daily"] = f"WITH {DAYS} SELECT *, {moving('pos_sales_units', 7, True)} FROM days"
ORACLES["mask_value_daily"] = f"""
WITH {DAYS}, masked AS (SELECT *, {moving('pos_sales_value_usd', 7, False)} FROM days)
SELECT * REPLACE (round(at_masked_pos_sales_value_usd, 4) AS at_masked_pos_sales_value_usd) FROM masked"""


def rolled(unit: str, step: str, size: int) -> str:
    return f"""
WITH {DAYS}, periods AS (
  SELECT prod_id, site_id, data_provider_code, secure_group_key,
         CAST(date_trunc('{unit}', time_period_end_date) + INTERVAL {step} AS DATE) AS time_period_end_date,
         CAST(sum(pos_sales_units) AS BIGINT) AS pos_sales_units, round(sum(pos_sales_value_usd), 2) AS pos_sales_value_usd
  FROM days GROUP BY 1, 2, 3, 4, 5)
SELECT *, {LOADED} AS created_at_utc_datetime, {LOADED_DAY} AS created_at_date, 'aggregation' AS data_source,
       {moving('pos_sales_units', size, True)} FROM periods"""


ORACLES["rollup_week"] = rolled("week", "7 DAY", 4)
ORACLES["rollup_month"] = rolled("month", "1 MONTH", 3)
ORACLES["mask_by_age"] = f"""
WITH {DAYS}, masked AS (SELECT *, {moving('pos_sales_units', 7, True)} FROM days)
SELECT * EXCLUDE (at_masked_pos_sales_units)
         REPLACE (CASE WHEN time_period_end_date > DATE '2001-11-05' - 365 THEN at_masked_pos_sales_units
                       ELSE pos_sales_units END AS pos_sales_units)
FROM masked"""
ORACLES["rls_filter"] = """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CAST(CASE l_returnflag WHEN 'A' THEN 110011 WHEN 'N' THEN 0 ELSE 110013 END AS INTEGER) AS secure_group_key
  FROM lineitem) WHERE secure_group_key IN (0, 110011)"""

# Upserts, unions, gold

ORACLES["upsert_fact"] = """
WITH items AS (
  SELECT CAST(l_shipdate AS DATE) AS sold_on, l_partkey, l_suppkey, l_orderkey, l_linenumber,
         CAST(l_quantity AS BIGINT) AS units FROM lineitem),
one AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY sold_on, l_partkey, l_suppkey
            ORDER BY l_orderkey DESC NULLS LAST, l_linenumber ASC NULLS FIRST, units ASC NULLS FIRST) AS r FROM items) WHERE r = 1),
source AS (SELECT * REPLACE (units + 100 AS units), 'second' AS load FROM one WHERE sold_on >= DATE '1999-01-01')
SELECT *, 'first' AS load FROM one t WHERE sold_on < DATE '2000-01-01'
  AND NOT EXISTS (SELECT 1 FROM source s WHERE s.sold_on = t.sold_on AND s.l_partkey = t.l_partkey AND s.l_suppkey = t.l_suppkey)
UNION ALL SELECT * FROM source"""


def gold_columns(provider: int, masks: list[str]) -> str:
    have = [*MEASURES[provider], *masks]
    extra = "extra_attributes" if provider == 1003 else "CAST(NULL AS VARCHAR) AS extra_attributes"
    return f"{declared(ALL_MEASURES | MASKS, have)}, {extra}"


def _unrounded(text: str) -> str:
    for c, t in (ALL_MEASURES | MASKS).items():
        if t == "DOUBLE":
            text = text.replace(f"round({c}, 4) AS {c}", c)
    return text


ORACLES["schema_union_gold_fact"] = "\nUNION ALL BY NAME\n".join(
    f"""SELECT time_period_end_date, prod_id, site_id, {provenance(p)}, {_unrounded(gold_columns(p, []))}
FROM ({SALES[p]} FROM lineitem WHERE l_returnflag = '{FLAGS[p]}')"""
    for p in FLAGS
)

PROD_COLUMNS = {
    "source_prod_name": "VARCHAR", "source_sector": "VARCHAR", "source_category": "VARCHAR",
    "source_subcategory": "VARCHAR", "source_item_gtin": "BIGINT", "source_item_description": "VARCHAR",
    "source_prod_launch_date": "DATE", "corp_prod_name": "VARCHAR", "corp_sector": "VARCHAR",
    "corp_subcategory": "VARCHAR", "corp_category": "VARCHAR", "corp_item_description": "VARCHAR",
    "extra_attributes": "VARCHAR",
}
SITE_COLUMNS = {
    "source_global_location_number": "BIGINT", "source_site_name": "VARCHAR", "source_address": "VARCHAR",
    "source_channel": "VARCHAR", "source_latitude": "DOUBLE", "source_longitude": "DOUBLE",
    "source_city": "VARCHAR", "source_state": "VARCHAR", "source_county": "VARCHAR",
    "source_country": "VARCHAR", "corp_site_name": "VARCHAR", "corp_address": "VARCHAR",
    "corp_channel": "VARCHAR", "corp_latitude": "DOUBLE", "corp_longitude": "DOUBLE",
    "corp_city": "VARCHAR", "corp_state": "VARCHAR", "corp_county": "VARCHAR",
    "corp_country": "VARCHAR", "extra_attributes": "VARCHAR",
}
# Expressions over products p, stores s and master m.
PROD_VALUES = {
    "source_prod_name": "p.product", "source_sector": "p.sector", "source_category": "p.category",
    "source_item_gtin": "CAST(p.gtin AS BIGINT)", "source_item_description": "p.description",
    "source_prod_launch_date": "p.launch_date",
}
PROD_CORP = {
    "corp_prod_name": "m.prod_name", "corp_sector": "m.sector", "corp_category": "m.category",
    "corp_item_description": "m.item_description",
}
SITE_VALUES = {
    "source_global_location_number": "CAST(s.gln AS BIGINT)", "source_site_name": "s.store",
    "source_address": "s.address", "source_channel": "s.channel", "source_latitude": "s.latitude",
    "source_longitude": "s.longitude", "source_city": "s.city",
}
SITE_CORP = {
    "corp_site_name": "m.site_name", "corp_address": "m.address", "corp_channel": "m.channel",
    "corp_latitude": "m.latitude", "corp_longitude": "m.longitude",
}
PROD_EXTRA = """CAST(json_object('product_id', CAST(p.product_id AS VARCHAR), 'logo_present_on_pack', 'Y',
  'package_material', p.p_type, 'shelf_life_days', CAST(p.size AS VARCHAR), 'is_bundle', CAST(NULL AS VARCHAR),
  'brand_marketing_tier', p.p_brand, 'num_components', CAST(p.size AS VARCHAR)) AS VARCHAR)"""
SITE_EXTRA = """CAST(json_object('store_id', CAST(s.store_id AS VARCHAR), 'store_manager_name', s.store,
  'store_opening_date', CAST(NULL AS VARCHAR), 'format_subtype', s.channel,
  'store_square_footage', CAST(s.nation_number AS VARCHAR), 'lease_type', 'owned',
  'parking_spaces', CAST(s.nation_number AS VARCHAR), 'micro_fulfillment_enabled', 'N') AS VARCHAR)"""

DIM = {
    "prod": dict(
        columns=PROD_COLUMNS, values=PROD_VALUES, corp=PROD_CORP, extra=PROD_EXTRA, source="products p",
        item="l_partkey", own="p.product_id", master_on="m.item_gtin = p.gtin", first="source_prod_name",
    ),
    "site": dict(
        columns=SITE_COLUMNS, values=SITE_VALUES, corp=SITE_CORP, extra=SITE_EXTRA, source="stores s",
        item="l_suppkey", own="s.store_id", master_on="m.global_location_number = s.gln", first="source_site_name",
    ),
}


def dim_key(kind: str, provider: int, corp: bool) -> str:
    """Surrogate key of a provider's products or stores: id and tracked values in name order."""
    d = DIM[kind]
    values = {d["first"]: d["values"][d["first"]]} if provider == 1001 else dict(d["values"])
    if corp and provider != 1001:
        values |= d["corp"]
    return key(f"'{provider}' || {d['own']}", *[values[c] for c in sorted(values)])


def gold_dim(kind: str) -> str:
    d = DIM[kind]
    master = PRODUCT_MASTER if kind == "prod" else SITE_MASTER
    parts = []
    for p in FLAGS:
        values = {d["first"]: d["values"][d["first"]]} if p == 1001 else d["values"] | d["corp"]
        if p == 1003:
            values = values | {"extra_attributes": d["extra"]}
        columns = ", ".join(
            f"{values[c]} AS {c}" if c in values else f"CAST(NULL AS {t}) AS {c}" for c, t in d["columns"].items()
        )
        parts.append(
            f"""SELECT '{p}' || {d['own']} AS {kind}_id, {provenance(p)}, {dim_key(kind, p, True)} AS {kind}_key,
  TRUE AS is_current, '1900-01-01 00:00:00' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, {columns}
FROM {d['source']} LEFT JOIN master m ON {d['master_on']}
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = '{FLAGS[p]}' AND {d['item']} = {d['own']})"""
        )
    return f"WITH {PRODUCTS}, {STORES}, {master}\n" + "\nUNION ALL BY NAME\n".join(parts)


ORACLES["gold_prod_dim"] = gold_dim("prod")
ORACLES["gold_site_dim"] = gold_dim("site")

MASKED = {1001: ["pos_sales_value_usd"], 1002: ["pos_sales_units"], 1003: []}


def day_ctes(p: int) -> str:
    return f"""
raw{p} AS ({SALES[p]} FROM lineitem WHERE l_returnflag = '{FLAGS[p]}'),
one{p} AS (SELECT * FROM (SELECT *, row_number() OVER (
   PARTITION BY time_period_end_date, prod_id, site_id ORDER BY {TIES[p]}) AS r FROM raw{p}) WHERE r = 1),
day{p} AS (
  SELECT f.*, {dim_key('prod', p, False)} AS prod_key, {dim_key('site', p, False)} AS site_key
  FROM one{p} f JOIN products p ON p.product_id = f.l_partkey JOIN stores s ON s.store_id = f.l_suppkey)"""


def masked_rows(p: int, rows: str, size: int) -> str:
    masks = "".join(f", {moving(c, size, c == 'pos_sales_units')}" for c in MASKED[p])
    return f"(SELECT *{masks} FROM {rows})"


ORACLES["gold_day_fact"] = (
    f"WITH {PRODUCTS}, {STORES}, {','.join(day_ctes(p) for p in FLAGS)}\n"
    + "\nUNION ALL BY NAME\n".join(
        f"""SELECT time_period_end_date, prod_id, site_id, {provenance(p)}, prod_key, site_key,
  {gold_columns(p, [f'at_masked_{c}' for c in MASKED[p]])}
FROM {masked_rows(p, f'day{p}', 7)}"""
        for p in FLAGS
    )
)


def gold_period(unit: str, step: str, size: int) -> str:
    parts, ctes = [], []
    for p in FLAGS:
        sums = ", ".join(
            f"CAST(sum({c}) AS {ALL_MEASURES[c]}) AS {c}" for c in MEASURES[p]
        )
        ctes.append(
            f"""{day_ctes(p)},
period{p} AS (
  SELECT prod_id, site_id, CAST(date_trunc('{unit}', time_period_end_date) + INTERVAL {step} AS DATE) AS time_period_end_date,
         {sums}, arg_max(prod_key, time_period_end_date) AS prod_key, arg_max(site_key, time_period_end_date) AS site_key
  FROM day{p} GROUP BY 1, 2, 3)"""
        )
        own = provenance(p).replace(f"'{SOURCES[p]}' AS data_source", "'aggregation' AS data_source")
        columns = gold_columns(p, [f"at_masked_{c}" for c in MASKED[p]])
        columns = columns.replace("extra_attributes", "CAST(NULL AS VARCHAR) AS extra_attributes") if p == 1003 else columns
        parts.append(
            f"""SELECT time_period_end_date, prod_id, site_id, {own}, prod_key, site_key, {columns}
FROM {masked_rows(p, f'period{p}', size)}"""
        )
    return f"WITH {PRODUCTS}, {STORES}, {','.join(ctes)}\n" + "\nUNION ALL BY NAME\n".join(parts)


ORACLES["gold_week_fact"] = gold_period("week", "7 DAY", 4)
ORACLES["gold_month_fact"] = gold_period("month", "1 MONTH", 3)

# Files, partitions, quality

ORACLES["new_partitions"] = """
SELECT partition_key, 'events_' || partition_key AS run_key FROM (
  SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS partition_key FROM events
  EXCEPT
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-15')"""
ORACLES["partition_load"] = f"""
SELECT {EVENTS_TEXT}, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'"""
ORACLES["freshness"] = """
SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest, max(ts) >= TIMESTAMP '2024-01-30' AS is_fresh
FROM events GROUP BY 1"""
ORACLES["table_metrics"] = """
SELECT 'events' AS table_name, CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS date_count, CAST(count(DISTINCT user_id) AS BIGINT) AS id_count
FROM events"""
ORACLES["null_profile"] = f"""
WITH e AS ({ENRICHED_PRODUCT})
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null FROM e"
    for c in [
        "prod_id", "source_prod_name", "source_item_gtin",
        "corp_prod_name", "corp_sector", "corp_category", "corp_item_description",
    ]
)

SPARK_NAMES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date"}


def _report(provider: int) -> str:
    n = f"(SELECT CAST(count(*) AS BIGINT) FROM lineitem WHERE l_returnflag = '{FLAGS[provider]}')"
    present = {
        "time_period_end_date": "date", "prod_id": "string", "site_id": "string",
        "created_at_utc_datetime": "timestamp", "created_at_date": "date", "data_source": "string",
        "data_provider_code": "string", "secure_group_key": "int",
    }
    present |= {c: SPARK_NAMES[ALL_MEASURES[c]] for c in MEASURES[provider] if c != "pos_sales_units"}
    rows = [(c, t, t, "ok", n) for c, t in present.items()]
    rows += [(c, "bigint", None, "missing", "0") for c in ("prod_key", "site_key")]
    if "pos_sales_units" in MEASURES[provider]:
        rows.append(("pos_sales_units", "bigint", "int", "mismatch", n))
    rows += [(c, SPARK_NAMES[t], None, "absent", "0") for c, t in (ALL_MEASURES | MASKS).items() if c not in MEASURES[provider]]
    if provider == 1003:
        fields = [
            "safety_stock_qty", "cycle_count_variance_qty", "inventory_accuracy_pct", "days_of_supply",
            "shrinkage_qty", "reserved_qty_for_online", "backroom_qty",
        ]
        rows.append(("extra_attributes", "struct<>", f"struct<{','.join(f'{c}:string' for c in fields)}>", "ok", n))
    else:
        rows.append(("extra_attributes", "struct<>", None, "absent", "0"))
    rows.append(("note", None, "string", "unexpected", "0"))

    def text(value):
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {text(e)} AS expected_type, {text(a)} AS actual_type, "
        f"'{v}' AS verdict, CAST({count} AS BIGINT) AS non_null, CAST({provider} AS INTEGER) AS provider"
        for c, e, a, v, count in rows
    )


ORACLES["schema_report"] = "\nUNION ALL\n".join(_report(p) for p in FLAGS)
ORACLES["stream_bronze"] = f"""
SELECT {texts("event_id", "ts", "user_id", "event_type", "value", "props")}, TRUE AS ingested,
       CAST(110011 AS INTEGER) AS secure_group_key, 'cds_1001' AS data_provider_code, 'uploader' AS data_source
FROM events"""
