"""Provider feeds and dimension batches derived from the benchmark tables.

Line items are sales: parts are products, suppliers are stores, the return flag tells
the provider. All rows are used; a feed differs from another only in layout.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators.conform import with_global_ids
from tillhouse.operators.dedupe import latest_per_key
from tillhouse.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup_join
from tillhouse.operators.scd2 import version_delta
from tillhouse.operators.union import upserted
from tillhouse.session import prepare, together, written

LOADED = datetime(2002, 1, 1)  # ingestion time of every derived feed
PROVIDER_FLAG = {1001: "A", 1002: "N", 1003: "R"}

# Feed batches of the dimension history: the first is the initial load, the others
# end (and are processed) at these times.
FIRST_CUT, SECOND_CUT, LAST_RUN = datetime(1995, 4, 1), datetime(2001, 7, 1), datetime(2002, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _product_columns() -> dict[str, Column]:
    """The columns of a product feed, from those of part; ``product_id`` is part's key."""
    size = F.col("p_size")
    return {
        "product": F.col("p_name"),
        "category": F.col("p_type"),
        "sector": F.col("p_brand"),
        "launch_date": F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), size), "yyyy-MM-dd"),
        "GTIN": F.lpad(F.col("product_id").cast("string"), 13, "0"),
        "description": F.concat_ws(" ", "p_brand", "p_name"),
        "logo_present_on_pack": F.lit("Y"),
        "package_material": F.col("p_type"),
        "shelf_life_days": size,
        "is_bundle": F.lit(None).cast("string"),
        "brand_marketing_tier": F.col("p_brand"),
        "num_components": size,
    }


def _store_columns() -> dict[str, Column]:
    """The columns of a store feed, from those of supplier, nation and region; ``store_id`` is supplier's key."""
    return {
        "store": F.col("s_name"),
        "city": F.col("n_name"),
        "address": F.concat_ws(", ", "s_name", "n_name"),
        "channel": F.col("r_name"),
        "latitude": F.col("s_acctbal"),
        "longitude": F.col("s_acctbal") / 2,
        "global_location_number": F.lpad(F.col("store_id").cast("string"), 13, "0"),
        "store_manager_name": F.col("s_name"),
        "store_opening_date": F.lit(None).cast("string"),
        "format_subtype": F.col("r_name"),
        "store_square_footage": F.col("n_nationkey"),
        "lease_type": F.lit("owned"),
        "parking_spaces": F.col("n_nationkey"),
        "micro_fulfillment_enabled": F.lit("N"),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _parts(spark, sf_dir) -> DataFrame:
    own = ["p_name", "p_type", "p_brand", "p_size"]
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), *own)


def _suppliers(spark, sf_dir) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    country = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    placed = supplier.join(country, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    own = ["s_name", "s_acctbal", "n_nationkey", "n_name", "r_name"]
    return placed.select(F.col("s_suppkey").alias("store_id"), *own)


def products(spark, sf_dir) -> DataFrame:
    """Part as a full product dimension feed."""
    return _parts(spark, sf_dir).select("product_id", *_named(_product_columns()))


def stores(spark, sf_dir) -> DataFrame:
    """Supplier with nation and region as a full store dimension feed."""
    return _suppliers(spark, sf_dir).select("store_id", *_named(_store_columns()))


def with_full_dimensions(rows: DataFrame, spark, sf_dir, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Sales with all columns of their product and store, null where there is none.

    Only the columns of the tables travel with a sale; the feed's columns are made of them when both lookups are done.
    Products come first: there are more of them, so stores may still be broadcast, and the sales of a product then lie together.
    """
    placed = _suppliers(spark, sf_dir).withColumn("_placed", F.lit(True))
    known = _parts(spark, sf_dir).withColumn("_known", F.lit(True))
    found = lookup_join(lookup_join(rows, known, ["product_id"], limits=limits), placed, ["store_id"], limits=limits)
    product = {name: F.when(F.col("_known"), column) for name, column in _product_columns().items()}
    store = {name: F.when(F.col("_placed"), column) for name, column in _store_columns().items()}
    return found.select(*rows.columns, *_named(product), *_named(store))


def provider_sales(spark, sf_dir, provider_id: int) -> DataFrame:
    """The line items of one provider, keyed as the feeds are."""
    items = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == PROVIDER_FLAG[provider_id])
    return items.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").alias("usd"),
        (F.col("l_extendedprice") / 2).alias("local"),
        F.col("l_linenumber").cast("bigint").alias("number"),
        F.col("l_discount").alias("discount"),
        F.col("l_linestatus").alias("status"),
    )


def feed(spark, sf_dir, provider_id: int) -> DataFrame:
    """The feed of a provider in that provider's own columns."""
    sales = provider_sales(spark, sf_dir, provider_id)
    keys = ["date", "product_id", "store_id"]
    if provider_id == 1001:
        prod, site = products(spark, sf_dir).select("product_id", "product"), stores(spark, sf_dir)
        rows = sales.select(
            *keys, F.col("qty").alias("sales_qty"), F.col("usd").alias("sales_value_usd")
        )
        named = lookup_join(rows, prod, ["product_id"])
        return lookup_join(named, site.select("store_id", "store"), ["store_id"]).select(*rows.columns, "product", "store")
    if provider_id == 1002:
        rows = sales.select(
            *keys,
            F.col("qty").alias("sales_qty"),
            F.col("usd").alias("sales_value_usd"),
            F.col("local").alias("sales_value_local_currency"),
            F.col("number").alias("return_amount"),
            F.col("discount").alias("return_value_local_currency"),
        )
    else:
        rows = sales.select(
            *keys,
            F.col("qty").alias("inventory_qty"),
            F.col("number").alias("units_on_order"),
            F.col("usd").alias("value_on_hand_usd"),
            F.col("local").alias("value_on_hand_local_currency"),
            F.col("number").alias("safety_stock_qty"),
            F.col("number").alias("cycle_count_variance_qty"),
            F.col("status").alias("inventory_accuracy_pct"),
            F.col("qty").alias("days_of_supply"),
            F.lit(None).cast("bigint").alias("shrinkage_qty"),
            F.col("number").alias("reserved_qty_for_online"),
            F.col("qty").alias("backroom_qty"),
        )
    return with_full_dimensions(rows, spark, sf_dir)


def brand_days(spark, sf_dir) -> DataFrame:
    """Daily sales by brand and nation: long series, as roll-ups and masks need."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    sold = lookup_join(lookup_join(items, part, ["l_partkey"]), supplier, ["l_suppkey"])
    return (
        sold.groupBy(
            F.col("p_brand").alias("prod_id"),
            F.col("s_nationkey").cast("string").alias("site_id"),
            F.to_date("l_shipdate").alias("time_period_end_date"),
        )
        .agg(
            F.sum("l_quantity").cast("bigint").alias("pos_sales_units"),
            F.round(F.sum("l_extendedprice"), 2).alias("pos_sales_value_usd"),
        )
        .withColumns(
            {
                "data_provider_code": F.lit("cds_1001"),
                "secure_group_key": F.lit(110011),
            }
        )
    )


def facts(spark, sf_dir) -> DataFrame:
    """Every line item as a fact of one provider, with global ids."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("time_period_end_date"),
        F.concat(F.lit("1001"), F.col("l_partkey").cast("string")).alias("prod_id"),
        F.concat(F.lit("1001"), F.col("l_suppkey").cast("string")).alias("site_id"),
        F.col("l_quantity").cast("bigint").alias("pos_sales_units"),
    )


def _observed(spark, sf_dir, key: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """The latest status of each key among the line items of a period."""
    items = table(spark, sf_dir, "lineitem").select(key, "l_shipdate", "l_linestatus")
    at = F.col("l_shipdate")
    if start is not None:
        items = items.filter(at >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        items = items.filter(at < F.lit(str(end)).cast("timestamp_ntz"))
    return latest_per_key(items, [key], newest="l_shipdate")


def product_batch(spark, sf_dir, start=None, end=None) -> DataFrame:
    """Products seen in a period: name, and as category the status last seen."""
    seen = _observed(spark, sf_dir, "l_partkey", start, end)
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    rows = lookup_join(seen, part, ["l_partkey"]).select(
        F.col("l_partkey").cast("string").alias("prod_id"),
        F.lit("cds_1001").alias("data_provider_code"),
        F.col("l_shipdate").cast("timestamp").alias("created_at_utc_datetime"),
        F.col("p_name").alias("source_prod_name"),
        F.col("l_linestatus").alias("source_category"),
    )
    return with_global_ids(rows, "prod_id")


def site_batch(spark, sf_dir, start=None, end=None) -> DataFrame:
    """Stores seen in a period: name, and as channel the status last seen."""
    seen = _observed(spark, sf_dir, "l_suppkey", start, end)
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    rows = lookup_join(seen, supplier, ["l_suppkey"]).select(
        F.col("l_suppkey").cast("string").alias("site_id"),
        F.lit("cds_1001").alias("data_provider_code"),
        F.col("l_shipdate").cast("timestamp").alias("created_at_utc_datetime"),
        F.col("s_name").alias("source_site_name"),
        F.col("l_linestatus").alias("source_channel"),
    )
    return with_global_ids(rows, "site_id")


PRODUCT_SCD = dict(
    tracked=["source_prod_name", "source_category"], natural_key="prod_id", key="prod_key", algorithm="md5"
)
SITE_SCD = dict(
    tracked=["source_site_name", "source_channel"], natural_key="site_id", key="site_key", algorithm="md5"
)


def history(spark, sf_dir, batch, scd: dict, runs: int = 3, reopen: bool = False) -> DataFrame:
    """The stored dimension after the first ``runs`` batches, each applied to the last state."""
    keys = [scd["natural_key"], scd["key"]]
    periods = [(None, FIRST_CUT, FIRST_CUT), (FIRST_CUT, SECOND_CUT, SECOND_CUT), (SECOND_CUT, None, LAST_RUN)]
    periods = periods[:runs]
    batches = together(*[partial(batch, spark, sf_dir, start, end) for start, end, _ in periods])
    dim = None
    for rows, (_, _, run_at) in zip(batches, periods):
        delta = version_delta(
            rows,
            dim,
            as_of=run_at,
            reopen_reverted=reopen,
            one_each=True,
            **scd,
        )
        dim = written(delta if dim is None else upserted(dim, delta, keys))
    return dim
