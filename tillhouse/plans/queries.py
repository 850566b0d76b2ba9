"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.columns import attributes_json, surrogate_key
from tillhouse.operators import gold, quality
from tillhouse.operators.conform import conform, pack, with_global_ids
from tillhouse.operators.dedupe import distinct_rows, latest_per_key
from tillhouse.operators.joins import (
    JoinLimits,
    enrich,
    lookup_join,
    orphans,
    point_in_time_join,
    with_current,
    with_history,
)
from tillhouse.operators.masking import apply_mask, reveal_by_age
from tillhouse.operators.rollup import downsample
from tillhouse.operators.scd2 import current_versions, initial_versions, snapshot, version_delta
from tillhouse.operators.union import relaxed_union, upserted
from tillhouse.plans import silver
from tillhouse.plans import standins as s
from tillhouse.plans.providers import PROVIDERS, SALES_FEED
from tillhouse.schemas import STORE_FACT, STORE_FACT_REQUIRED
from tillhouse.session import together, work_dir, written
from tillhouse.sources import feeds, files, master
from tillhouse.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Nothing fits: every lookup takes its shuffled path.
SHUFFLED = JoinLimits(broadcast_bytes=-1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as text: date and time in UTC."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Raw layer and conformance


@query
def bronze_ingest(spark, sf_dir):
    """All columns as text, plus security group, provider and ingestion columns."""
    items = s.table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    return _text(silver.bronze(items, SALES_FEED, s.LOADED), "created_at_utc_datetime")


def _conformed(spark, sf_dir, provider_id):
    who = PROVIDERS[provider_id]
    raw = silver.bronze(s.feed(spark, sf_dir, provider_id), who, s.LOADED)
    return with_global_ids(conform(raw, "store_fact", who.fact, who.fact_extras), "prod_id", "site_id")


def _as_one(conformed: list[DataFrame]) -> DataFrame:
    """The providers' conformed rows by name, attributes as text."""
    return _text(relaxed_union([attributes_json(df) for df in conformed]), "created_at_utc_datetime")


@query
def conform_fact(spark, sf_dir):
    """All providers' text back to typed model columns, with global ids."""
    return _as_one(together(*[partial(_conformed, spark, sf_dir, p) for p in PROVIDERS]))


@query
def extra_attributes_json(spark, sf_dir):
    """Non-standard product columns packed into a struct and written as JSON text."""
    rows = s.products(spark, sf_dir).select(
        "product_id",
        pack(["product", "package_material", "is_bundle", "brand_marketing_tier"]),
    )
    return attributes_json(rows)


def _through_files(spark, sf_dir, fmt: str, **options) -> DataFrame:
    """Every provider's feed written in a format, scanned and conformed."""

    def one(who):
        path = work_dir(spark)
        feeds.write_feed(s.feed(spark, sf_dir, who.id), path, fmt)
        raw = silver.bronze(feeds.read_feed(spark, path, fmt, **options), who, s.LOADED)
        return conform(raw, "store_fact", who.fact, who.fact_extras)

    return _as_one(together(*[partial(one, who) for who in PROVIDERS.values()]))


@query
def delimited_feed(spark, sf_dir):
    """Feeds as pipe-delimited text."""
    return _through_files(spark, sf_dir, "txt")


@query
def json_feed(spark, sf_dir):
    """Feeds as lines of JSON, whose values are read as text."""
    return _through_files(spark, sf_dir, "json", json_lines=True)


# Distinct


@query
def dedupe_full(spark, sf_dir):
    events = s.table(spark, sf_dir, "events")
    return _text(distinct_rows(events.unionByName(events)), "ts")


@query
def dedupe_latest(spark, sf_dir):
    """The latest event of each user and type; the feed arrives twice."""
    events = s.table(spark, sf_dir, "events")
    return _text(latest_per_key(events.unionByName(events), ["user_id", "event_type"], "ts"), "ts")


# Master data


def _product_master(spark, sf_dir):
    feed = s.products(spark, sf_dir)
    return master.build_master([feed, feed], master.PRODUCT_MASTER, master.PRODUCT_KEY)


def _site_master(spark, sf_dir):
    feed = s.stores(spark, sf_dir)
    return master.build_master([feed, feed], master.SITE_MASTER, master.SITE_KEY)


@query
def master_build(spark, sf_dir):
    """Product master data: union of feeds, one row per GTIN, a sample of 30 percent."""
    return _product_master(spark, sf_dir)


@query
def site_master_build(spark, sf_dir):
    return _site_master(spark, sf_dir)


def _source_products(spark, sf_dir):
    return s.products(spark, sf_dir).select(
        F.col("product_id").cast("string").alias("prod_id"),
        F.col("product").alias("source_prod_name"),
        F.col("GTIN").cast("bigint").alias("source_item_gtin"),
    )


@query
def master_enrich_product(spark, sf_dir):
    corp = master.corporate(_product_master(spark, sf_dir))
    return enrich(_source_products(spark, sf_dir), corp, "source_item_gtin", "corp_item_gtin")


@query
def master_enrich_site(spark, sf_dir):
    corp = master.corporate(_site_master(spark, sf_dir))
    sites = s.stores(spark, sf_dir).select(
        F.col("store_id").cast("string").alias("site_id"),
        F.col("store").alias("source_site_name"),
        F.col("global_location_number").cast("bigint").alias("source_global_location_number"),
    )
    key = "global_location_number"
    return enrich(sites, corp, f"source_{key}", f"corp_{key}")


# Dimension versions


@query
def scd2_hash_key(spark, sf_dir):
    part = s.table(spark, sf_dir, "part")
    return part.select(
        "p_partkey", surrogate_key(["p_partkey", "p_brand", "p_name", "p_type"], "md5").alias("prod_key")
    )


def _versions(df: DataFrame) -> DataFrame:
    return _text(df.drop("created_at_utc_datetime"), "valid_from", "valid_to")


def _first_products(spark, sf_dir):
    return s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD, runs=1)


@query
def scd2_initial(spark, sf_dir):
    batch = s.product_batch(spark, sf_dir, None, s.FIRST_CUT)
    return _versions(initial_versions(batch, **s.PRODUCT_SCD))


@query
def scd2_delta(spark, sf_dir):
    """Changed and new products of the second batch, with the versions they expire."""
    batch = s.product_batch(spark, sf_dir, s.FIRST_CUT, s.SECOND_CUT)
    existing = _first_products(spark, sf_dir)
    return _versions(version_delta(batch, existing, as_of=s.SECOND_CUT, **s.PRODUCT_SCD))


@query
def scd2_apply(spark, sf_dir):
    """The product dimension after three batches; some products go back to an earlier state."""
    return _versions(s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD))


@query
def scd2_reopen(spark, sf_dir):
    """The same batches with reverted products getting a new version."""
    return _versions(s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD, reopen=True))


@query
def dim_current_product(spark, sf_dir):
    return _versions(current_versions(s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD)))


@query
def dim_current(spark, sf_dir):
    return _versions(current_versions(s.history(spark, sf_dir, s.site_batch, s.SITE_SCD)))


@query
def dim_asof(spark, sf_dir):
    """Product versions valid at noon of a day between the second and third batch."""
    dim = s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD)
    return _versions(snapshot(dim, datetime(2001, 9, 15, 12)))


# Facts and dimensions


def _with_keys(spark, sf_dir, limits):
    prod, site = together(
        partial(s.history, spark, sf_dir, s.product_batch, s.PRODUCT_SCD),
        partial(s.history, spark, sf_dir, s.site_batch, s.SITE_SCD),
    )
    facts = point_in_time_join(s.facts(spark, sf_dir), prod, "prod_id", "prod_key", limits=limits)
    return point_in_time_join(facts, site, "site_id", "site_key", limits=limits), prod, site


@query
def pit_join_fact(spark, sf_dir):
    """Every fact with the product and site version valid on its date."""
    return _with_keys(spark, sf_dir, JoinLimits())[0]


@query
def pit_join_fact_shuffled(spark, sf_dir):
    """The same lookup for dimensions too large to broadcast, with hot ids spread."""
    return _with_keys(spark, sf_dir, SHUFFLED)[0]


@query
def ri_orphans(spark, sf_dir):
    """Facts of products that the first batch did not know."""
    return orphans(s.facts(spark, sf_dir), _first_products(spark, sf_dir), "prod_id", "prod_key")


@query
def history_join(spark, sf_dir):
    """Units by the category a product had at the time of sale."""
    keyed, prod, _ = _with_keys(spark, sf_dir, JoinLimits())
    rows = with_history(keyed, prod.select("prod_key", "source_category"), "prod_key")
    return rows.groupBy("source_category").agg(F.sum("pos_sales_units").alias("units"))


@query
def current_join(spark, sf_dir):
    """Units by the category a product has now."""
    prod = s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD)
    rows = with_current(s.facts(spark, sf_dir), prod.select("prod_id", "is_current", "source_category"), "prod_id")
    return rows.groupBy("source_category").agg(F.sum("pos_sales_units").alias("units"))


def _star(spark, sf_dir, limits):
    orders = s.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customer = s.table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = s.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sites = lookup_join(customer.select("c_custkey", "n_nationkey", "c_mktsegment"), nation, ["n_nationkey"])
    rows = lookup_join(orders.select("o_orderkey", "c_custkey", "o_totalprice"), sites, ["c_custkey"], "inner", limits)
    return rows.groupBy("n_name", "c_mktsegment").agg(
        F.count("o_orderkey").alias("order_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("order_value"),
    )


@query
def star_feed_join(spark, sf_dir):
    """A star feed: orders with the customer dimension and its nation."""
    return _star(spark, sf_dir, JoinLimits())


@query
def star_feed_join_shuffled(spark, sf_dir):
    return _star(spark, sf_dir, SHUFFLED)


@query
def star_feed_files(spark, sf_dir):
    """Product, store and sales files in CSV, read as one star feed and joined."""
    root = work_dir(spark)
    sales = s.table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), F.col("l_suppkey").alias("store"),
        F.col("l_partkey").alias("product"), F.col("l_quantity").cast("bigint").alias("sales_qty"),
    )
    feeds.write_feed(s.products(spark, sf_dir).withColumnRenamed("product_id", "id"), f"{root}/p", "csv")
    feeds.write_feed(s.stores(spark, sf_dir).withColumnRenamed("store_id", "id"), f"{root}/s", "csv")
    feeds.write_feed(sales, f"{root}/f", "csv")
    star = feeds.read_star_feed(spark, f"{root}/p", f"{root}/s", f"{root}/f", "csv")
    rows = lookup_join(star.sales, star.products.select("product_id", "sector"), ["product_id"])
    rows = lookup_join(rows, star.stores.select("store_id", "city"), ["store_id"])
    return rows.groupBy("sector", "city").agg(F.sum(F.col("sales_qty").cast("bigint")).alias("units"))


# Masks and roll-ups


@query
def mask_volume_daily(spark, sf_dir):
    return apply_mask(s.brand_days(spark, sf_dir), "volume", "daily")


@query
def mask_value_daily(spark, sf_dir):
    return _rounded(
        apply_mask(s.brand_days(spark, sf_dir), "value", "daily"), 4, "at_masked_pos_sales_value_usd"
    )


def _rolled(spark, sf_dir, period):
    days = apply_mask(s.brand_days(spark, sf_dir), "volume", "daily")
    rows = downsample(days, period, s.LOADED)
    return _text(_rounded(rows, 2, "pos_sales_value_usd"), "created_at_utc_datetime")


@query
def rollup_week(spark, sf_dir):
    return _rolled(spark, sf_dir, "1w")


@query
def rollup_month(spark, sf_dir):
    return _rolled(spark, sf_dir, "1mo")


@query
def mask_by_age(spark, sf_dir):
    """Masked units in the last year of data, real units before."""
    days = apply_mask(s.brand_days(spark, sf_dir), "volume", "daily")
    return reveal_by_age(days, datetime(2001, 11, 5), 365, competition=[1001])


@query
def rls_filter(spark, sf_dir):
    """Sales visible to a user of group 110011; the second provider is open to all."""
    flag = F.col("l_returnflag")
    group = F.when(flag == "A", 110011).when(flag == "N", 0).otherwise(110013)
    items = s.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", group.alias("secure_group_key")
    )
    return gold.visible_to_groups(items, [110011])


# Upserts, unions, gold


@query
def upsert_fact(spark, sf_dir):
    """Sales up to 1999 updated and extended by a second load from 1999 on."""
    keys = ["sold_on", "l_partkey", "l_suppkey"]
    items = s.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("sold_on"), "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("units"), F.lit("first").alias("load"),
    )
    one_each = latest_per_key(items, keys, newest="l_orderkey")
    first = one_each.filter(F.col("sold_on") < "2000-01-01")
    second = one_each.filter(F.col("sold_on") >= "1999-01-01").withColumns(
        {"units": F.col("units") + 100, "load": F.lit("second")}
    )
    return upserted(first, second, keys)


@query
def schema_union_gold_fact(spark, sf_dir):
    """Three feeds with different columns and attributes in one declared layout."""
    rows = gold.gold_store_fact(together(*[partial(_conformed, spark, sf_dir, p) for p in PROVIDERS]))
    return _text(rows, "created_at_utc_datetime").drop("prod_key", "site_key")


def _gold_dim(spark, sf_dir, delta, build, corp):
    corp = written(corp)  # one master for all providers

    def one(who):
        raw = silver.bronze(s.feed(spark, sf_dir, who.id), who, s.LOADED)
        return delta(raw, who, None, corp, s.LOADED, algorithm="md5")

    dims = together(*[partial(one, who) for who in PROVIDERS.values()])
    return _text(build(dims), "created_at_utc_datetime", "valid_from", "valid_to")


@query
def gold_prod_dim(spark, sf_dir):
    corp = master.corporate(_product_master(spark, sf_dir))
    return _gold_dim(spark, sf_dir, silver.prod_dim_delta, gold.gold_prod_dim, corp)


@query
def gold_site_dim(spark, sf_dir):
    corp = master.corporate(_site_master(spark, sf_dir))
    return _gold_dim(spark, sf_dir, silver.site_dim_delta, gold.gold_site_dim, corp)


def _silver_day(spark, sf_dir, who):
    raw = written(silver.bronze(s.feed(spark, sf_dir, who.id), who, s.LOADED))  # read by three plans
    prod, site = together(
        lambda: written(silver.prod_dim_delta(raw, who, None, None, s.LOADED, algorithm="md5")),
        lambda: written(silver.site_dim_delta(raw, who, None, None, s.LOADED, algorithm="md5")),
    )
    return silver.day_fact(raw, who, prod, site)


def _silver_days(spark, sf_dir):
    return together(*[partial(_silver_day, spark, sf_dir, who) for who in PROVIDERS.values()])


def _gold_fact(silver_facts):
    rows = quality.gate(gold.gold_store_fact(silver_facts), "store_fact", "gold")
    money = [c for c, t in STORE_FACT.items() if t.simpleString() == "double"]
    return _text(_rounded(rows, 4, *money), "created_at_utc_datetime")


@query
def gold_day_fact(spark, sf_dir):
    """All providers from landed feeds to the shared day fact, version keys and masks included."""
    return _gold_fact(_silver_days(spark, sf_dir))


@query
def gold_week_fact(spark, sf_dir):
    return _gold_fact([downsample(d, "1w", s.LOADED) for d in _silver_days(spark, sf_dir)])


@query
def gold_month_fact(spark, sf_dir):
    return _gold_fact([downsample(d, "1mo", s.LOADED) for d in _silver_days(spark, sf_dir)])


# Files, partitions, quality


@query
def new_partitions(spark, sf_dir):
    """Dates in the event feed that the ledger does not hold yet."""
    events = s.table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    done = files.partitions_in(events.filter(F.col("date") < "2024-01-15"))
    ledger = files.partitions_to_run(done, None, "events")
    return files.partitions_to_run(files.partitions_in(events), ledger, "events")


@query
def partition_load(spark, sf_dir):
    """The rows of one date, chosen by its text key."""
    events = s.table(spark, sf_dir, "events").withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    return _text(feeds.partition_rows(events, "2024-01-15"), "ts")


def _ingested_events(spark, sf_dir):
    events = s.table(spark, sf_dir, "events")
    return events.withColumn("created_at_utc_datetime", F.col("ts").cast("timestamp"))


@query
def freshness(spark, sf_dir):
    rows = quality.freshness(_ingested_events(spark, sf_dir), datetime(2024, 1, 31), by="event_type")
    return _text(rows, "latest")


@query
def table_metrics(spark, sf_dir):
    events = s.table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    return quality.table_metrics(events, "events", "date", "user_id")


@query
def null_profile(spark, sf_dir):
    """Non-null values per column of the products enriched with a partial master."""
    return quality.null_profile(master_enrich_product(spark, sf_dir))


@query
def schema_report(spark, sf_dir):
    """Each provider's conformed facts against their declared columns, before version keys are added."""

    def one(provider_id):
        rows = _conformed(spark, sf_dir, provider_id).withColumn("note", F.lit(None).cast("string"))
        if "pos_sales_units" in rows.columns:
            rows = rows.withColumn("pos_sales_units", F.col("pos_sales_units").cast("int"))
        return quality.schema_report(rows, STORE_FACT, STORE_FACT_REQUIRED).withColumn("provider", F.lit(provider_id))

    return reduce(DataFrame.unionByName, together(*[partial(one, p) for p in PROVIDERS]))


@query
def stream_bronze(spark, sf_dir):
    """Event files picked up as a stream into bronze, then read back."""
    root = work_dir(spark)
    events = s.table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/landing")
    stream = ingest.stream_feed(spark, f"{root}/landing", "parquet", events.schema)
    rows = ingest.stream_bronze(stream, 1001, 110011, "uploader")
    ingest.append_stream(rows, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    bronze = spark.read.schema(rows.schema).parquet(f"{root}/bronze")
    ingested = F.col("created_at_date") == F.to_date("created_at_utc_datetime")  # the time is that of the run
    return bronze.withColumn("ingested", ingested).drop("created_at_utc_datetime", "created_at_date")
