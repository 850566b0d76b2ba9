"""Queries over stored tables, second loads and awkward rows: what a running lakehouse meets."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import EPOCH, instant, surrogate_key
from tillhouse.operators import gold
from tillhouse.operators.bronze import to_bronze
from tillhouse.operators.conform import conform, rejects, with_global_ids
from tillhouse.operators.dedupe import latest_per_key
from tillhouse.operators.joins import JoinLimits, point_in_time_join
from tillhouse.operators.masking import apply_mask, reveal_by_age
from tillhouse.operators.rollup import downsample
from tillhouse.operators.scd2 import initial_versions, version_delta
from tillhouse.operators.union import upserted
from tillhouse.plans import silver
from tillhouse.plans import standins as s
from tillhouse.plans.lakehouse import Lakehouse
from tillhouse.plans.providers import PROVIDERS
from tillhouse.plans.queries import QUERIES, SHUFFLED, _product_master, _rounded, _text, query
from tillhouse.schemas import FACT_KEYS
from tillhouse.session import together, work_dir, written
from tillhouse.sources import feeds, files, master, tables
from tillhouse.streaming import ingest

LATER = datetime(2002, 2, 1)


# Point-in-time lookup


def _at_instants(spark, sf_dir, limits: JoinLimits) -> DataFrame:
    """Sales at hours of the day, and products whose versions change at ten in the morning."""
    dim = s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD)
    at_ten = F.expr("INTERVAL 10 HOURS")
    first = F.col("valid_from") == instant(EPOCH)
    dim = dim.withColumns(
        {
            "valid_from": F.when(first, F.col("valid_from")).otherwise(F.col("valid_from") + at_ten),
            "valid_to": F.col("valid_to") + at_ten,
        }
    )
    sales = s.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.timestamp_add("HOUR", 3 * F.col("l_linenumber"), F.col("l_shipdate").cast("timestamp")).alias("sold_at"),
        F.concat(F.lit("1001"), F.col("l_partkey").cast("string")).alias("prod_id"),
    )
    return _text(point_in_time_join(sales, dim, "prod_id", "prod_key", "sold_at", limits=limits), "sold_at")


@query
def pit_join_timestamp(spark, sf_dir):
    return _at_instants(spark, sf_dir, JoinLimits())


@query
def pit_join_timestamp_shuffled(spark, sf_dir):
    return _at_instants(spark, sf_dir, SHUFFLED)


@query
def pit_join_many_versions(spark, sf_dir):
    """Stores with a version for every month of seven years."""
    months = F.expr("sequence(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)")
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sites = s.table(spark, sf_dir, "supplier").select("s_suppkey").repartition(shares, "s_suppkey")  # each makes 84 versions
    dim = sites.select(F.concat(F.lit("1001"), F.col("s_suppkey").cast("string")).alias("site_id"), F.explode(months).alias("month"))
    last = F.col("month") == F.lit("2001-12-01").cast("date")
    dim = dim.withColumns(
        {
            "site_key": surrogate_key(["site_id", "month"], "md5"),
            "valid_from": F.when(F.col("month") > F.lit("1995-01-01").cast("date"), F.col("month").cast("timestamp")).otherwise(instant(EPOCH)),
            "valid_to": F.when(~last, F.add_months("month", 1).cast("timestamp")),
        }
    )
    return point_in_time_join(s.facts(spark, sf_dir), written(dim), "site_id", "site_key")  # read by three plans


# Awkward rows


@query
def rollup_week_two_groups(spark, sf_dir):
    """Weeks within which the security group changes from day to day."""
    group = F.when(F.dayofmonth("time_period_end_date") % 2 == 0, 110011).otherwise(110013).cast("int")
    days = apply_mask(s.brand_days(spark, sf_dir).withColumn("secure_group_key", group), "volume", "daily")
    rows = downsample(days, "1w", s.LOADED)
    return _text(_rounded(rows, 2, "pos_sales_value_usd"), "created_at_utc_datetime")


@query
def new_partitions_null(spark, sf_dir):
    """A tenth of the events has no date: their partition is due once, like any other."""
    day = F.when(F.col("event_id") % 10 != 0, F.to_date("ts"))
    events = s.table(spark, sf_dir, "events").withColumn("date", day)
    found = files.partitions_in(events)
    ledger = files.partitions_to_run(files.partitions_in(events.filter(F.col("date") < "2024-01-15")), None, "events")
    due = files.partitions_to_run(found, ledger, "events")
    again = files.partitions_to_run(found, ledger.unionByName(due), "events")
    return due.withColumn("pass", F.lit(1)).unionByName(again.withColumn("pass", F.lit(2)))


@query
def scd2_null_key(spark, sf_dir):
    """Products of which a tenth has no id: one entity, and the same batch again changes nothing."""
    part = s.table(spark, sf_dir, "part")
    batch = part.select(
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey").cast("string")).alias("prod_id"),
        F.lit("cds_1001").alias("data_provider_code"),
        instant(s.LOADED).alias("created_at_utc_datetime"),
        F.col("p_name").alias("source_prod_name"),
        F.col("p_type").alias("source_category"),
    )
    first = written(initial_versions(batch, **s.PRODUCT_SCD))
    again = version_delta(batch, first, as_of=LATER, **s.PRODUCT_SCD)
    return _text(upserted(first, again, ["prod_id", "prod_key"]).drop("created_at_utc_datetime"), "valid_from", "valid_to")


@query
def gold_mask_by_age(spark, sf_dir):
    """The shared day fact with each provider's own masks on the last year of data."""
    days = QUERIES["gold_day_fact"](spark, sf_dir)
    return reveal_by_age(days, datetime(2001, 11, 5), 365, selections={p: who.mask for p, who in PROVIDERS.items()})


@query
def rejected_rows(spark, sf_dir):
    """All providers' sales with quantities and dates that do not parse, and which columns those are."""
    found = []
    for who in PROVIDERS.values():
        amount = "inventory_qty" if who.id == 1003 else "sales_qty"
        feed = s.feed(spark, sf_dir, who.id).withColumns(
            {
                amount: F.when(F.col("product_id") % 10 == 0, F.lit("many")).otherwise(F.col(amount).cast("string")),
                "date": F.when(F.col("store_id") % 7 == 0, F.lit("2001-13-01")).otherwise(F.col("date")),
            }
        )
        bad = rejects(silver.bronze(feed, who, s.LOADED), who.fact)
        found.append(bad.select("data_provider_code", "date", "product_id", "store_id", F.col(amount).alias("amount"), F.array_join("rejected_columns", ",").alias("rejected")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def rls_grants(spark, sf_dir):
    """Sales a user may see by a table of grants."""
    flag = F.col("l_returnflag")
    group = F.when(flag == "A", 110011).when(flag == "N", 0).otherwise(110013).cast("int")
    items = s.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", group.alias("secure_group_key"))
    grants = s.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("user"), (F.col("n_nationkey") % 2).cast("string")).alias("user_name"),
        (110011 + F.col("n_nationkey") % 4).cast("int").alias("secure_group_key"),
    )
    return gold.visible_to_user(items, grants, "user0")


# Stored tables


@query
def stored_upsert(spark, sf_dir):
    """The loads of ``upsert_fact`` through a stored table, partitioned by year."""
    keys = ["sold_on", "l_partkey", "l_suppkey"]
    items = s.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("sold_on"), "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("units"), F.lit("first").alias("load"),
    )
    one_each = latest_per_key(items, keys, newest="l_orderkey").withColumn("sold_year", F.year("sold_on"))
    first = one_each.filter(F.col("sold_on") < "2000-01-01")
    second = one_each.filter(F.col("sold_on") >= "1999-01-01").withColumns({"units": F.col("units") + 100, "load": F.lit("second")})
    path = work_dir(spark)
    for load in (first, second):
        tables.upsert_table(load, path, keys, ["sold_year"], unique=True)
    return tables.load_table(spark, path)


@query
def append_new_columns(spark, sf_dir):
    """Two appends, the second with more columns."""
    events, path = s.table(spark, sf_dir, "events"), work_dir(spark)
    tables.append_table(events.filter("event_id % 2 = 0").select("event_id", "user_id"), path)
    tables.append_table(events.filter("event_id % 2 = 1"), path)
    return _text(tables.load_table(spark, path), "ts")


@query
def new_files(spark, sf_dir):
    """Files that arrive in two drops, each found once."""
    events, landing = s.table(spark, sf_dir, "events"), work_dir(spark)
    cursor, drops = None, []
    for drop in (0, 1):
        events.filter(F.col("event_id") % 2 == drop).write.mode("append").parquet(landing)
        found = files.detect_new_files(spark, landing, cursor)
        cursor = found.cursor
        drops.append(feeds.read_feed(spark, found.paths, "parquet").withColumn("arrival", F.lit(drop)))
    return _text(drops[0].unionByName(drops[1]), "ts")


@query
def gold_with_base(spark, sf_dir):
    """Rows of all providers brought into a shared table that holds some of them already."""
    stored, fresh, day = [], [], F.col("time_period_end_date")
    for who in PROVIDERS.values():
        raw = silver.bronze(s.feed(spark, sf_dir, who.id), who, s.LOADED)
        rows = conform(raw, "store_fact", who.fact, who.fact_extras)
        days = with_global_ids(latest_per_key(rows, FACT_KEYS), "prod_id", "site_id")
        stored.append(days.filter(day < "2000-01-01").withColumn("data_source", F.lit("stored")))
        fresh.append(days.filter(day >= "1999-01-01"))
    rows = gold.gold_store_fact(fresh, base=gold.gold_store_fact(stored))
    return _text(rows, "created_at_utc_datetime").drop("prod_key", "site_key")


@query
def refresh_twice(spark, sf_dir):
    """All providers from landing to gold in two runs; the second brings later days and a month of days again."""
    providers = {who.id: replace(who, feed_format="parquet") for who in PROVIDERS.values()}
    lake, landing = Lakehouse(spark, work_dir(spark), providers=providers, by_month=True), work_dir(spark)
    days = {"early": "date < '1999-12-01'", "again": "date >= '1999-12-01' AND date < '2000-01-01'", "late": "date >= '2000-01-01'"}
    for i in providers:
        feed = s.feed(spark, sf_dir, i)
        for name, part in days.items():
            feed.filter(part).write.parquet(f"{landing}/{i}/{name}")
    for names, at in ((("early", "again"), s.LOADED), (("again", "late"), LATER)):
        lake.run_all({i: [f"{landing}/{i}/{name}" for name in names] for i in providers}, at)
    rows = lake.table("gold", "day_fact").drop("prod_key", "site_key")
    money = [c for c, t in rows.dtypes if t == "double"]
    return _text(_rounded(rows, 4, *money), "created_at_utc_datetime")


def _shared_products(dims) -> DataFrame:
    return _text(gold.gold_table("prod_dim", dims), "created_at_utc_datetime", "valid_from", "valid_to")


@query
def prod_dim_second_batch(spark, sf_dir):
    """Stored product dimensions of all providers meet a master that has new categories."""
    corp = written(master.corporate(_product_master(spark, sf_dir)))
    changed = corp.withColumn("corp_category", F.concat("corp_category", F.lit(" new")))

    def twice(who) -> DataFrame:
        raw = written(silver.bronze(s.feed(spark, sf_dir, who.id), who, s.LOADED))
        first = written(silver.prod_dim_delta(raw, who, None, corp, s.LOADED, algorithm="md5"))
        delta = silver.prod_dim_delta(raw, who, first, changed, LATER, algorithm="md5")
        return upserted(first, delta, ["prod_id", "prod_key"])

    return _shared_products(together(*[partial(twice, who) for who in PROVIDERS.values()]))


@query
def dim_stream_upsert(spark, sf_dir):
    """Bronze files of all providers as streams of micro-batches that keep their product dimensions up to date."""

    def streamed(who) -> DataFrame:
        root, raw = work_dir(spark), silver.bronze(s.feed(spark, sf_dir, who.id), who, s.LOADED)
        for part in (0, 1):
            raw.filter(F.col("store_id").cast("bigint") % 2 == part).write.mode("append").parquet(f"{root}/landing")
        stream = ingest.stream_feed(spark, f"{root}/landing", "parquet", raw.schema, files_per_batch=8)
        handle = ingest.dimension_upsert(who, "prod_dim", f"{root}/prod_dim", clock=lambda: s.LOADED, algorithm="md5")
        ingest.stream_batches(ingest.dimension_feed(stream, who, "prod_dim"), f"{root}/checkpoint", handle).awaitTermination()
        return tables.load_table(spark, f"{root}/prod_dim")

    return _shared_products(together(*[partial(streamed, who) for who in PROVIDERS.values()]))


# Star feeds in their other forms


def _star_dim(spark, sf_dir, drops) -> DataFrame:
    """A product dimension after several drops of a star feed, each a CSV of products."""
    root, dim = work_dir(spark), None
    for k, (products, at) in enumerate(drops):
        feeds.write_feed(products.withColumnRenamed("product_id", "id"), f"{root}/p{k}", "csv")
        feeds.write_feed(s.stores(spark, sf_dir).withColumnRenamed("store_id", "id").limit(0), f"{root}/s{k}", "csv")
        sales = products.select(F.lit("2001-01-01").alias("date"), F.lit(1).alias("store"), F.col("product_id").alias("product"))
        feeds.write_feed(sales, f"{root}/f{k}", "csv")
        star = feeds.read_star_feed(spark, f"{root}/p{k}", f"{root}/s{k}", f"{root}/f{k}", "csv")
        raw = to_bronze(star.products, 1001, 110011, "uploader", at)
        rows = with_global_ids(
            raw.select(
                F.col("product_id").alias("prod_id"), "data_provider_code", "created_at_utc_datetime",
                F.col("product").alias("source_prod_name"), F.col("category").alias("source_category"),
            ),
            "prod_id",
        )
        delta = version_delta(rows, dim, as_of=at, **s.PRODUCT_SCD)
        dim = written(delta if dim is None else upserted(dim, delta, ["prod_id", "prod_key"]))
    return _text(dim.drop("created_at_utc_datetime"), "valid_from", "valid_to")


@query
def star_feed_full_refresh(spark, sf_dir):
    """All products each time, every second one with a new category in the second drop."""
    products = s.products(spark, sf_dir)
    redrawn = F.when(F.col("product_id") % 2 == 0, F.concat("category", F.lit(" new"))).otherwise(F.col("category"))
    return _star_dim(spark, sf_dir, [(products, s.LOADED), (products.withColumn("category", redrawn), LATER)])


@query
def star_feed_increment(spark, sf_dir):
    """New products only in the second drop, none in the third."""
    products = s.products(spark, sf_dir)
    old = F.col("product_id") % 3 != 0
    return _star_dim(spark, sf_dir, [(products.filter(old), s.LOADED), (products.filter(~old), LATER), (products.limit(0), datetime(2002, 3, 1))])
