"""The queries of ``queries_feeds.py`` in plain SQL over the same tables."""

from __future__ import annotations

from tillhouse.plans.oracles import EVENTS_TEXT, ORACLES

ORACLES["json_array_split"] = r"""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
       CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_suppkey AS VARCHAR) AS placed_at,
       '{"' || l_returnflag || '"},' || chr(10) || '[\' || l_linestatus || '\"}' AS note
FROM lineitem"""
ORACLES["stream_dedupe"] = f"SELECT {EVENTS_TEXT} FROM (SELECT DISTINCT * FROM events)"
ORACLES["extra_attributes_variant"] = """
SELECT p_partkey AS product_id,
       CAST(json_object('is_bundle', CAST(NULL AS VARCHAR), 'package_material', p_type, 'product', p_name, 'shelf_life_days', p_size) AS VARCHAR) AS extra_attributes,
       p_type AS package_material, CAST(p_size AS BIGINT) AS shelf_life_days, CAST(NULL AS BIGINT) AS no_number,
       CAST(NULL AS VARCHAR) AS is_bundle, CAST(NULL AS VARCHAR) AS absent,
       'OBJECT<is_bundle: VOID, package_material: STRING, product: STRING, shelf_life_days: BIGINT>' AS attribute_schema
FROM part"""
