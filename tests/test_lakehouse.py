"""Three providers from landed files to gold, in two loads, and the streaming variant."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import feed_files
from tillhouse.operators.joins import with_history
from tillhouse.operators.quality import gate, rows_seen
from tillhouse.operators.scd2 import current_versions
from tillhouse.plans import silver
from tillhouse.plans.lakehouse import LAYOUT, Lakehouse
from tillhouse.plans.providers import INVENTORY_FEED, PROVIDERS, SALES_FEED, WIDE_SALES_FEED
from tillhouse.schemas import FACT_KEYS
from tillhouse.sources.feeds import read_feed, read_star_feed
from tillhouse.sources.tables import append_table, upsert_table
from tillhouse.streaming import ingest

FIRST, SECOND = datetime(2024, 1, 21), datetime(2024, 2, 11, 6)
CUT, END = 20, 40
ROWS_PER_DAY = feed_files.PRODUCTS * feed_files.STORES


def rows(df, *without):
    names = [c for c in sorted(df.columns) if c not in without]
    return sorted(str(r) for r in df.select(names).collect())


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    loads = []
    for first, last, name in ((0, CUT, "one"), (CUT - 1, END, "two")):
        renamed = {1: "Renamed"} if name == "two" else None
        loads.append(
            {
                1001: feed_files.daily_sales(root / name / "1001", first, last),
                1002: [feed_files.all_dates(root / name / "1002", first, last, renamed)],
                1003: feed_files.inventory_texts(root / name / "1003", first, last),
            }
        )
    return loads, feed_files.masters(root / "master")


@pytest.fixture(scope="module")
def lake(spark, landed, tmp_path_factory):
    loads, (product, site) = landed
    house = Lakehouse(spark, str(tmp_path_factory.mktemp("lake")), product, site)
    for load, at in zip(loads, (FIRST, SECOND)):
        house.run_all(load, at)
    return house


def test_tables_have_their_declared_schema(lake):
    for name, (declared, _) in LAYOUT.items():
        gate(lake.table("gold", name), declared, "gold")
        for who in PROVIDERS.values():
            gate(lake.table("silver", name, who), declared)


def test_day_fact_holds_every_sale_once(lake):
    gold = lake.table("gold", "day_fact")
    assert gold.count() == 3 * END * ROWS_PER_DAY
    assert gold.select(*FACT_KEYS).distinct().count() == gold.count()


def test_bronze_keeps_both_deliveries_as_text(lake):
    raw = lake.table("bronze", "day_fact", INVENTORY_FEED)
    assert raw.count() == (END + 1) * ROWS_PER_DAY
    text = [f.dataType.simpleString() for f in raw.schema if f.name in ("inventory_qty", "GTIN", "value_on_hand_usd")]
    assert text == ["string"] * 3


def test_renamed_product_has_two_versions_and_facts_find_them(lake):
    dim = lake.table("silver", "prod_dim", WIDE_SALES_FEED).filter("prod_id = '10021'")
    got = {r["source_prod_name"]: (r["is_current"], r["valid_from"], r["valid_to"]) for r in dim.collect()}
    assert got == {
        "Product 1": (False, datetime(1900, 1, 1), SECOND),
        "Renamed": (True, SECOND, None),
    }
    assert lake.dims_at("prod_dim", WIDE_SALES_FEED, FIRST).filter("source_prod_name = 'Renamed'").isEmpty()
    facts = lake.table("silver", "day_fact", WIDE_SALES_FEED).filter("prod_id = '10021'")
    old_key = dim.filter("not is_current").first()["prod_key"]
    # all sales are dated before the run that brought the new name
    assert {r["prod_key"] for r in facts.select("prod_key").distinct().collect()} == {old_key}


def test_master_data_reaches_the_dimensions(lake):
    dim = current_versions(lake.table("gold", "prod_dim"))
    named = {(r["prod_id"], r["corp_prod_name"]) for r in dim.filter("corp_prod_name is not null").collect()}
    assert named == {("10020", "Corp 0"), ("10030", "Corp 0")}
    sites = lake.table("gold", "site_dim").filter("corp_site_name is not null")
    assert {r["site_id"] for r in sites.collect()} == {"10021", "10031"}


def test_masks_per_provider(lake):
    gold = lake.table("gold", "day_fact")
    masked = {
        r["data_provider_code"]: (r["units"], r["usd"])
        for r in gold.groupBy("data_provider_code")
        .agg(
            F.count("at_masked_pos_sales_units").alias("units"),
            F.count("at_masked_pos_sales_value_usd").alias("usd"),
        )
        .collect()
    }
    full = (END - 6) * ROWS_PER_DAY
    assert masked == {"cds_1001": (0, full), "cds_1002": (full, 0), "cds_1003": (0, 0)}


def test_roll_ups_add_up(lake):
    total = F.sum("pos_sales_units").alias("u")
    expected = lake.table("gold", "day_fact").agg(total).first()["u"]
    for name in ("week_fact", "month_fact"):
        assert lake.table("gold", name).agg(total).first()["u"] == expected
    labels = {r[0] for r in lake.table("gold", "month_fact").select("time_period_end_date").distinct().collect()}
    assert labels == {date(2024, 2, 1), date(2024, 3, 1)}


def test_incremental_loads_equal_a_full_recomputation(spark, landed, lake, tmp_path):
    loads, (product, site) = landed
    full = Lakehouse(spark, str(tmp_path), product, site)
    who = SALES_FEED
    for load, at in zip(loads, (FIRST, SECOND)):
        full.run(who, load[who.id], at, incremental=False)
    for name in ("day_fact", "week_fact", "month_fact"):
        assert rows(lake.table("silver", name, who), "created_at_utc_datetime", "created_at_date") == rows(
            full.table("silver", name, who), "created_at_utc_datetime", "created_at_date"
        )


def test_replaying_a_load_changes_nothing(lake, landed):
    who, before = INVENTORY_FEED, {}
    for name in LAYOUT:
        before[name] = rows(lake.table("gold", name), "created_at_utc_datetime", "created_at_date")
    lake.refresh_dims(who, SECOND + timedelta(days=1), SECOND.date())
    start = lake.refresh_facts(who, SECOND + timedelta(days=1), SECOND.date())
    for name in LAYOUT:
        lake.refresh_gold(name, who, start)
        assert rows(lake.table("gold", name), "created_at_utc_datetime", "created_at_date") == before[name]


def test_metrics(lake):
    assert tuple(lake.metrics("gold", "day_fact").first()) == ("day_fact", 3 * END * ROWS_PER_DAY, END, None)
    assert lake.metrics("gold", "prod_dim").first()["id_count"] == 3 * feed_files.PRODUCTS


def test_metrics_are_kept(spark, lake):
    for name in ("day_fact", "prod_dim"):
        lake.record_metrics("gold", name, SECOND)
    kept = spark.read.parquet(f"{lake.root}/metrics")
    assert {(r["table_name"], r["layer"], r["recorded_at"]) for r in kept.collect()} == {
        ("day_fact", "gold", SECOND), ("prod_dim", "gold", SECOND),
    }


def test_each_run_notes_the_rows_of_every_table(lake):
    found = lake.run_metrics()
    at = {(r["layer"], r["table_name"], r["provider"], r["recorded_at"]): r["row_count"] for r in found.collect() if r["recorded_at"] in (FIRST, SECOND)}
    names = [who.name for who in lake.providers.values()]
    for name in names:
        assert at["bronze", "day_fact", name, FIRST] == CUT * ROWS_PER_DAY
        assert at["bronze", "day_fact", name, SECOND] == (END - CUT + 1) * ROWS_PER_DAY
        assert at["silver", "day_fact", name, FIRST] == CUT * ROWS_PER_DAY
        assert at["silver", "prod_dim", name, FIRST] == feed_files.PRODUCTS
    assert at["gold", "day_fact", None, FIRST] == 3 * CUT * ROWS_PER_DAY
    assert all(n > 0 for (_, _, _, time), n in at.items() if time == FIRST)
    for name in LAYOUT:  # the first run brings all it finds
        assert at["gold", name, None, FIRST] == sum(at["silver", name, p, FIRST] for p in names)
    tables = {(layer, name) for layer, name, _, _ in at}
    assert {("gold", name) for name in LAYOUT} | {("silver", name) for name in LAYOUT} <= tables


def test_rows_are_counted_by_the_write_itself(spark, tmp_path):
    def jobs(group, write):
        spark.sparkContext.setJobGroup(group, group)
        seen = write()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), seen

    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 2).alias("part"))
    plain = jobs("plain", lambda: rows.write.mode("append").parquet(str(tmp_path / "plain")))[0]
    noted, seen = jobs("noted", lambda: append_table(rows, str(tmp_path / "noted")))
    assert (noted, seen.get["row_count"]) == (plain, 40)
    first = upsert_table(rows.filter("k < 30"), str(tmp_path / "t"), ["k"], ["part"])
    second = upsert_table(rows.filter("k >= 25"), str(tmp_path / "t"), ["k"], ["part"])
    nothing = upsert_table(rows.filter("k > 99"), str(tmp_path / "t"), ["k"], ["part"])
    assert [rows_seen(s) for s in (first, second, nothing)] == [30, 15, 0]


def test_shared_tables_are_empty_before_the_first_run(spark, tmp_path, lake):
    house = Lakehouse(spark, str(tmp_path / "none"))
    for name in LAYOUT:
        assert house.shared(name).collect() == []
        assert set(house.shared(name).columns) <= set(lake.shared(name).columns)
    assert house.run_metrics().collect() == []
    assert rows(lake.shared("day_fact")) == rows(lake.table("gold", "day_fact"))


STAR = replace(
    SALES_FEED,
    id=1004,
    name="star",
    feed_format="csv",
    prod={"prod_id": ("product_id", "string"), "prod_name": ("product", "string"), "category": ("category", "string")},
    tracked_prod=("source_prod_name", "source_category"),
)


def test_star_feed_with_dimensions_refreshed_every_day(spark, tmp_path):
    house = Lakehouse(spark, str(tmp_path / "lake"), providers={STAR.id: STAR})
    for day in (1, 2, 3):
        at, folder = datetime(2024, 1, day, 6), tmp_path / f"day{day}"
        folder.mkdir()
        stores = "id,store\n0,Store\n" if day == 1 else "id,store\n"  # nothing new: an empty file
        (folder / "p.csv").write_text(f"id,product,category\n0,same,c\n1,other,drawn {day}\n")
        (folder / "s.csv").write_text(stores)
        (folder / "f.csv").write_text(
            "date,store,product,sales_qty,sales_value_usd\n" + "".join(f"2024-01-0{day},0,{p},{day},1.5\n" for p in (0, 1))
        )
        feed = read_star_feed(spark, *[str(folder / f"{n}.csv") for n in "psf"], "csv")
        house.ingest_star(STAR, feed, at)
        since = at.date() if day > 1 else None
        house.refresh_dims(STAR, at, since)
        house.refresh_facts(STAR, at, since)
    dim = house.table("silver", "prod_dim", STAR)
    assert dim.filter("prod_id = '10040'").count() == 1
    assert [r["source_category"] for r in dim.filter("prod_id = '10041'").orderBy("valid_from").collect()] == [
        "drawn 1", "drawn 2", "drawn 3",
    ]
    assert house.table("silver", "site_dim", STAR).count() == 1
    facts = with_history(house.table("silver", "day_fact", STAR), dim.select("prod_key", "source_category"), "prod_key")
    found = {(r["time_period_end_date"].day, r["source_category"]) for r in facts.filter("prod_id = '10041'").collect()}
    # versions start at six in the morning, so a day's sales still see the version before
    assert found == {(1, "drawn 1"), (2, "drawn 1"), (3, "drawn 2")}


def test_facts_need_their_dimensions_first(spark, landed, tmp_path):
    empty = Lakehouse(spark, str(tmp_path))
    with pytest.raises(ValueError, match="has not been loaded"):
        empty.refresh_facts(SALES_FEED, FIRST)
    empty.ingest(SALES_FEED, landed[0][0][1001], FIRST)
    with pytest.raises(ValueError, match="prod_dim"):
        empty.refresh_facts(SALES_FEED, FIRST)


def test_one_date_of_a_landing_directory(spark, landed, tmp_path):
    house = Lakehouse(spark, str(tmp_path))
    house.ingest(INVENTORY_FEED, landed[0][0][1003], FIRST, partition="2024-01-05")
    assert house.table("bronze", "day_fact", INVENTORY_FEED).count() == ROWS_PER_DAY
    with pytest.raises(ValueError, match="2030-01-01"):
        house.ingest(INVENTORY_FEED, landed[0][0][1003], FIRST, partition="2030-01-01")


def test_only_new_dates_are_loaded(spark, landed, tmp_path):
    house = Lakehouse(spark, str(tmp_path))
    first, second = landed[0][0][1003], landed[0][1][1003]
    assert house.ingest_new_partitions(INVENTORY_FEED, first, FIRST).count() == CUT
    # the second delivery repeats the last date of the first one
    loaded = house.ingest_new_partitions(INVENTORY_FEED, second, SECOND)
    assert loaded.count() == END - CUT
    assert house.table("bronze", "day_fact", INVENTORY_FEED).count() == END * ROWS_PER_DAY
    assert house.ingest_new_partitions(INVENTORY_FEED, second, SECOND).isEmpty()
    again = house.ingest_new_partitions(INVENTORY_FEED, second, SECOND, reprocess=True)
    assert again.count() == END - CUT + 1


def test_stream_reads_each_file_once_and_equals_a_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    first = feed_files.inventory_texts(landing, 0, 2)
    schema = read_feed(spark, first, "txt").schema

    def pump():
        feed = ingest.stream_feed(spark, str(landing), "txt", schema, files_per_batch=1)
        tagged = ingest.stream_bronze(feed, 1003, 110013, "delta-share")
        ingest.append_stream(tagged, str(tmp_path / "bronze"), str(tmp_path / "cp")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "bronze"))

    assert pump().count() == 2 * ROWS_PER_DAY
    assert pump().count() == 2 * ROWS_PER_DAY
    second = feed_files.inventory_texts(landing, 2, 3)
    out = pump()
    batch = read_feed(spark, first + second, "txt")
    assert rows(out.select(*batch.columns)) == rows(batch)
    assert {r["secure_group_key"] for r in out.collect()} == {110013}


def test_stream_keeps_a_dimension_up_to_date(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "prod_dim")
    feed_files.all_dates(landing, 0, 1)
    schema = spark.read.parquet(str(landing)).schema
    times = iter([FIRST, SECOND, SECOND + timedelta(days=1)])

    def pump(checkpoint):
        feed = ingest.stream_feed(spark, str(landing), "parquet", schema)
        tagged = ingest.stream_bronze(feed, 1002, 110012, "uploader")
        handle = ingest.dimension_upsert(WIDE_SALES_FEED, "prod_dim", path, clock=lambda: next(times))
        ingest.stream_batches(tagged, str(tmp_path / checkpoint), handle).awaitTermination()
        return spark.read.parquet(path)

    assert pump("cp").count() == feed_files.PRODUCTS
    feed_files.all_dates(landing, 1, 2, {2: "Renamed"})
    changed = pump("cp")
    assert changed.count() == feed_files.PRODUCTS + 1
    before = rows(changed)
    assert rows(pump("fresh")) == before, "delivering the files again changes nothing"


def test_a_change_of_security_group_within_a_week_runs_on(spark, tmp_path):
    """2024-01-21 is a Sunday: the second delivery, under another group, falls into the week of 15 January too."""
    house = Lakehouse(spark, str(tmp_path / "lake"))
    house.run(SALES_FEED, feed_files.daily_sales(tmp_path / "one", 0, 17), FIRST)
    moved = replace(SALES_FEED, secure_group_key=110099)
    house.run(moved, feed_files.daily_sales(tmp_path / "two", 17, 30), SECOND)
    house.run(moved, feed_files.daily_sales(tmp_path / "three", 30, 32), SECOND + timedelta(days=1))
    weeks = house.table("gold", "week_fact")
    assert weeks.select(*FACT_KEYS).distinct().count() == weeks.count()
    groups = {str(r["time_period_end_date"]): r["secure_group_key"] for r in weeks.collect()}
    assert groups["2024-01-15"] == 110011 and groups["2024-01-22"] == 110099
    assert house.table("silver", "runs", SALES_FEED).count() == 3


def test_rows_without_a_date_reach_bronze_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    spark.createDataFrame([("2024-01-01", 1), (None, 2)], "date string, product_id int").write.parquet(landing)
    house = Lakehouse(spark, str(tmp_path / "lake"))
    assert house.ingest_new_partitions(SALES_FEED, landing, FIRST).count() == 2
    assert house.table("bronze", "day_fact", SALES_FEED).count() == 2
    assert house.ingest_new_partitions(SALES_FEED, landing, SECOND).isEmpty()


def test_a_stream_carries_only_what_its_dimension_is_made_of(spark):
    sales = spark.createDataFrame([("2024-01-01", 1, "soap", 5, "north", 3, 2.5), ("2024-01-02", 2, "tea", 5, "north", 1, 4.0)],
        "date string, product_id long, product string, store_id long, store string, sales_qty long, sales_value_usd double")
    raw = silver.bronze(sales, SALES_FEED, FIRST)
    for table, build, used in (("prod_dim", silver.prod_dim_delta, {"product_id", "product"}), ("site_dim", silver.site_dim_delta, {"store_id", "store"})):
        narrow = ingest.dimension_feed(raw, SALES_FEED, table)
        assert set(narrow.columns) & set(sales.columns) == used
        assert rows(build(narrow, SALES_FEED, None, None, FIRST)) == rows(build(raw, SALES_FEED, None, None, FIRST))
