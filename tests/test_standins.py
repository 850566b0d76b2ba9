"""Stand-in feeds: every sale with its product and store, the wide columns made after the lookups."""

from __future__ import annotations

from datetime import datetime

import pytest

from tillhouse.operators import joins
from tillhouse.plans import standins as s

SALE = "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime(2000, 1, 2)
    ids = [(1, 1), (1, 9), (9, 1), (2, 2), (None, 1), (3, None), (1, 1)]
    sales = [(p, q, n, 1.0, 2.0, 0.1, flag, "F", day) for flag in "ANR" for n, (p, q) in enumerate(ids)]
    frames = {
        "lineitem": spark.createDataFrame(sales, SALE),
        "part": spark.createDataFrame([(1, "a", "t", "b", 7), (2, None, "u", None, None), (2, "c", "u", "d", 1), (None, "n", "n", "n", 1)], "p_partkey long, p_name string, p_type string, p_brand string, p_size int"),
        "supplier": spark.createDataFrame([(1, "s", 4, 2.5), (2, "r", None, None), (None, "n", 4, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": spark.createDataFrame([(4, "N", 1), (4, "M", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string"),
    }
    for name, rows in frames.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def _sorted(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("limit", [64 << 20, -1])
@pytest.mark.parametrize("provider", [1002, 1003])
def test_a_feed_is_its_sales_joined_with_both_dimension_feeds(spark, tables, provider, limit, monkeypatch):
    monkeypatch.setitem(joins.DEFAULT_LIMITS.__dict__, "broadcast_bytes", limit)
    got = s.feed(spark, tables, provider)
    products, stores = s.products(spark, tables), s.stores(spark, tables)
    own = [c for c in got.columns if c not in products.columns[1:] and c not in stores.columns[1:]]
    plain = got.select(*own).distinct().join(products, "product_id", "left").join(stores, "store_id", "left")
    wide = [*own, *products.columns[1:], *stores.columns[1:]]
    assert got.columns == wide and got.count() == 12  # product 2 and nation 4 are there twice
    assert _sorted(got, wide) == _sorted(plain, wide)
    lone = got.filter("product_id = 9 OR product_id IS NULL").select(*products.columns[1:]).distinct().collect()
    assert [set(r) for r in lone] == [{None}]
    lone = got.filter("store_id = 9 OR store_id IS NULL").select(*stores.columns[1:]).distinct().collect()
    assert [set(r) for r in lone] == [{None}]


@pytest.mark.parametrize("provider", [1002, 1003])
def test_only_the_columns_of_the_tables_travel_through_the_lookups(spark, tables, provider):
    plan = s.feed(spark, tables, provider)._jdf.queryExecution().optimizedPlan().toString()
    made = [plan.rindex(x) for x in ("concat_ws", "lpad", "date_format(cast(date_add")]
    assert max(made) < plan.index("Join LeftOuter")
