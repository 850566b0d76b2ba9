"""Queries over tables that are kept up to date: by differences, by tails of series, per micro-batch."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.operators import gold
from tillhouse.operators.deltas import SIGN, changed_rows, merged_states, moved_state, period_state, stated_facts
from tillhouse.operators.joins import point_in_time_join
from tillhouse.operators.masking import SERIES, mask_with_tails
from tillhouse.operators.quality import SKETCH_ERROR, merged_counts, partition_sketches
from tillhouse.operators.rollup import DATE
from tillhouse.operators.union import upserted
from tillhouse.plans import silver
from tillhouse.plans import standins as s
from tillhouse.plans.lakehouse import Lakehouse
from tillhouse.plans.providers import PROVIDERS, Provider
from tillhouse.plans.queries import SHUFFLED, _gold_fact, _rounded, _versions, query
from tillhouse.session import together, work_dir, written
from tillhouse.sources import tables
from tillhouse.streaming import ingest


def _changing_days(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Days as first loaded, days taken out later, and days that came late or were corrected."""
    number = F.dayofmonth(DATE)
    group = F.when(number % 2 == 0, 110011).otherwise(110013).cast("int")
    days = written(s.brand_days(spark, sf_dir).withColumn("secure_group_key", group))
    first = days.filter(number % 5 != 0)
    corrected = first.filter(number % 11 == 2).withColumn("pos_sales_units", F.col("pos_sales_units") + 10)
    return first, first.filter(number % 7 == 3).filter(number % 11 != 2), days.filter(number % 5 == 0).unionByName(corrected)


def _by_delta(spark, sf_dir, period: str) -> DataFrame:
    keys = [*SERIES, DATE]
    first, removed, fresh = _changing_days(spark, sf_dir)
    state = written(period_state(first, period))
    changes = changed_rows(first, fresh, keys).unionByName(removed.withColumn(SIGN, F.lit(-1)))
    after = upserted(first, fresh, keys).join(removed.select(*keys), keys, "left_anti")
    changes = written(changes)
    rows = merged_states(state, moved_state(state, changes, period, after))
    return _rounded(stated_facts(rows, first), 2, "pos_sales_value_usd")


@query
def rollup_by_delta(spark, sf_dir):
    """Weeks after late, corrected and removed days, by differences to the stored sums."""
    return _by_delta(spark, sf_dir, "1w")


@query
def rollup_month_by_delta(spark, sf_dir):
    return _by_delta(spark, sf_dir, "1mo")


@query
def mask_by_tails(spark, sf_dir):
    """Masks after three loads: old days, newer ones, and those of every fifth day of a month, which come late."""
    days, late = written(s.brand_days(spark, sf_dir)), F.dayofmonth(DATE) % 5 == 0
    cut = F.col(DATE) < F.lit("1999-06-01").cast("date")
    loads = [days.filter(cut & ~late), days.filter(~cut & ~late), days.filter(late)]
    stored = tails = None
    for fresh in loads:
        start = fresh.agg(F.min(DATE).alias("d")).first()["d"]
        if start is None:
            continue
        masked, ends = mask_with_tails(fresh, stored, tails, "volume", "daily", start)
        masked, ends = written(masked), written(ends)
        stored = masked if stored is None else written(upserted(stored, masked, [*SERIES, DATE]))
        tails = ends if tails is None else written(upserted(tails, ends, SERIES))
    return stored


def _streamed(spark, sf_dir, lake: Lakehouse, who: Provider) -> None:
    """A provider's feed as files that a stream picks up: old sales, then newer and late ones and all old ones again."""
    root = work_dir(spark)
    raw = written(silver.bronze(s.feed(spark, sf_dir, who.id), who, s.LOADED))
    late = F.col("store_id").cast("bigint") % 5 == 0
    old = F.col(who.date_column) < "1998-01-01"
    for drop in (raw.filter(old & ~late), raw):
        drop.write.mode("append").parquet(f"{root}/landing")
        stream = ingest.stream_feed(spark, f"{root}/landing", "parquet", raw.schema)
        handle = ingest.fact_upsert(lake, who, clock=lambda: s.LOADED, algorithm="md5")
        ingest.stream_batches(stream, f"{root}/checkpoint", handle).awaitTermination()


@query
def pit_join_odd_dates(spark, sf_dir):
    """Sales of which a few bear dates of the years 1, 1900 and 2999, looked up in a dimension too large to broadcast."""
    odd = F.when(F.col("l_orderkey") % 97 == 0, "0001-01-01").when(F.col("l_orderkey") % 89 == 0, "1900-01-01").when(F.col("l_orderkey") % 83 == 0, "2999-12-31")
    sales = s.facts(spark, sf_dir).withColumn(DATE, F.coalesce(odd.cast("date"), F.col(DATE)))
    dim = s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD)
    found = point_in_time_join(sales, dim, "prod_id", "prod_key", strict=False, limits=SHUFFLED)
    return found.withColumn(DATE, F.col(DATE).cast("string"))


@query
def fact_stream_upsert(spark, sf_dir):
    """Day, week and month facts of all providers, kept up by micro-batches of bronze files."""
    lake = Lakehouse(spark, work_dir(spark), by_month=True)
    together(*[partial(_streamed, spark, sf_dir, lake, who) for who in PROVIDERS.values()])
    grains = {"day": "day_fact", "week": "week_fact", "month": "month_fact"}
    found = [
        _gold_fact([lake.table("silver", name, who) for who in PROVIDERS.values()]).withColumn("grain", F.lit(grain))
        for grain, name in grains.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def rls_view(spark, sf_dir):
    """What whoever runs the query may see of the sales, through a view in the catalog; half of the grants are theirs."""
    flag = F.col("l_returnflag")
    group = F.when(flag == "A", 110011).when(flag == "N", 0).otherwise(110013).cast("int")
    s.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", group.alias("secure_group_key")).createOrReplaceTempView("all_sales")
    s.table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") % 2 == 0, F.session_user()).otherwise(F.lit("another")).alias("user_name"),
        (110011 + F.col("n_nationkey") % 4).cast("int").alias("secure_group_key"),
    ).createOrReplaceTempView("sales_grants")
    gold.secured_view(spark, "my_sales", "all_sales", "sales_grants")
    return spark.table("my_sales")


@query
def dim_at_function(spark, sf_dir):
    """The product versions of an instant, asked by SQL through a table function."""
    s.history(spark, sf_dir, s.product_batch, s.PRODUCT_SCD).createOrReplaceTempView("product_versions")
    gold.dimension_at(spark, "products_at", "product_versions")
    return _versions(spark.sql("SELECT * FROM products_at(TIMESTAMP '2001-09-15 12:00:00')"))


@query
def metrics_by_sketch(spark, sf_dir):
    """Distinct counts of the events from sketches stored per day in two runs, beside the exact ones, per type."""
    ids, path = ["user_id", "event_id"], work_dir(spark)
    events = s.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    early = F.to_date("ts") < F.lit("2024-01-15").cast("date")
    for run in (events.filter(early), events.filter(~early)):
        tables.append_table(partition_sketches(run, ["day", "event_type"], ids), path)
    about = merged_counts(tables.load_table(spark, path), ids, ["event_type"])
    exact = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), *[F.countDistinct(c).alias(c) for c in ids])
    near = [(F.abs(F.col(f"{c}_count") - F.col(c)) <= 4 * SKETCH_ERROR * F.col(c)).alias(f"{c}_near") for c in ids]
    return exact.join(about, "event_type").select("event_type", "rows", "row_count", *ids, *near)
