"""Feeds, files, ledger, master data and stored tables."""

from __future__ import annotations

import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

import feed_files
from tillhouse.plans.standins import products
from tillhouse.schemas import STRING, empty
from tillhouse.session import work_dir
from tillhouse.sources import feeds, files, master, tables

SF_DIR = "/root/testdata/sf0.001"


def test_parquet_directory_and_file_list(spark, tmp_path):
    paths = feed_files.daily_sales(tmp_path / "in", 0, 3)
    assert feeds.read_feed(spark, str(tmp_path / "in"), "parquet").count() == 3 * 6
    assert feeds.read_feed(spark, paths[:2], "parquet").count() == 2 * 6


def test_delimited_text_is_not_inferred(spark, tmp_path):
    paths = feed_files.inventory_texts(tmp_path, 0, 1)
    df = feeds.read_feed(spark, paths, "txt")
    assert {t for _, t in df.dtypes} == {"string"}
    row = df.first()
    assert (row["value_on_hand_usd"], row["GTIN"][:5], row["date"]) == ("1.50", "00000", "2024-01-01")
    assert feeds.read_feed(spark, paths[0], "txt").count() * 2 == df.count()


def test_json_array_and_lines(spark, tmp_path):
    rows = [{"product_id": 1, "promo_flag": "Y"}, {"product_id": 2, "promo_flag": None}]
    (tmp_path / "array.json").write_text(json.dumps(rows))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    array = feeds.read_feed(spark, str(tmp_path / "array.json"), "json")
    lines = feeds.read_feed(spark, str(tmp_path / "lines.json"), "json", json_lines=True)
    assert sorted(map(tuple, array.collect())) == sorted(map(tuple, lines.collect())) == [("1", "Y"), ("2", None)]


@pytest.mark.parametrize("fmt", feeds.FORMATS)
def test_feed_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("1", "a|b,c"), ("2", 'say "x"')], "k string, v string")
    path = str(tmp_path / fmt)
    feeds.write_feed(df, path, fmt)
    back = feeds.read_feed(spark, path, fmt, json_lines=True).select("k", "v")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        feeds.read_feed(spark, "x", "xml")
    with pytest.raises(ValueError):
        feeds.write_feed(spark.range(1), "x", "xml")


def test_star_feed_with_an_empty_dimension_file(spark, tmp_path):
    for name, text in {
        "p1.csv": "id,product\n1,one\n", "p2.csv": "id,product\n", "s.csv": "id,store\n5,five\n",
        "f.csv": "date,store,product,sales_qty\n2024-01-01,5,1,3\n",
    }.items():
        (tmp_path / name).write_text(text)
    at = lambda *names: [str(tmp_path / n) for n in names]
    star = feeds.read_star_feed(spark, at("p1.csv", "p2.csv"), at("s.csv"), at("f.csv"), "csv")
    joined = star.sales.join(star.products, "product_id").join(star.stores, "store_id")
    assert joined.select("product", "store", "sales_qty").first()[:] == ("one", "five", "3")


def test_partition_rows(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, n int")
    assert [r["n"] for r in feeds.partition_rows(df, "2024-01-02").collect()] == [2]
    with pytest.raises(ValueError, match="2024-01-03"):
        feeds.partition_rows(df, "2024-01-03")


def test_new_files_are_strictly_newer_than_the_cursor(spark, tmp_path):
    for i, name in enumerate("abc"):
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep").write_text("x")
    first = files.detect_new_files(spark, str(tmp_path))
    assert [os.path.basename(p) for p in first.paths] == ["a", "b", "c"]
    assert first.cursor == datetime.fromtimestamp(1_700_000_002, tz=timezone.utc)
    middle = datetime.fromtimestamp(1_700_000_001, tz=timezone.utc)
    assert [os.path.basename(p) for p in files.detect_new_files(spark, str(tmp_path), middle).paths] == ["c"]
    nothing = files.detect_new_files(spark, str(tmp_path), first.cursor)
    assert nothing == files.NewFiles([], first.cursor)


def test_processed_partitions_are_not_run_again(spark):
    found = files.partitions_in(spark.createDataFrame([("d1",), ("d1",), ("d2",)], "date string"))
    first = files.partitions_to_run(found, None, "stock")
    assert {r["run_key"] for r in first.collect()} == {"stock_d1", "stock_d2"}
    ledger = first.filter("partition_key = 'd1'")
    assert [r["partition_key"] for r in files.partitions_to_run(found, ledger, "stock").collect()] == ["d2"]
    assert files.partitions_to_run(found, ledger, "stock", reprocess=True).count() == 2


def test_master_is_unique_repeatable_and_a_sample(spark):
    dim = products(spark, "/root/testdata/sf0.01")
    other = dim.withColumn("product", F.concat(F.lit("a "), "product"))
    built = master.build_master([dim, other], master.PRODUCT_MASTER, master.PRODUCT_KEY)
    again = master.build_master([other, dim], master.PRODUCT_MASTER, master.PRODUCT_KEY)
    rows = built.collect()
    assert sorted(rows) == sorted(again.collect())
    assert len({r["item_gtin"] for r in rows}) == len(rows)
    assert 0.25 < len(rows) / dim.count() < 0.35
    assert all(r["prod_name"].startswith("a ") for r in rows)
    whole = master.build_master([dim], master.PRODUCT_MASTER, master.PRODUCT_KEY, fraction=1.0)
    assert whole.count() == dim.count()
    assert master.corporate(built).columns[0] == "corp_item_gtin"


def test_append_accepts_new_columns(spark):
    path = work_dir(spark)
    assert tables.load_table(spark, path) is None
    assert tables.load_or_empty(spark, path, {"a": STRING}).columns == ["a"]
    tables.append_table(spark.createDataFrame([("1", "x")], "a string, day string"), path, ["day"])
    tables.append_table(spark.createDataFrame([("2", "n", "y")], "a string, b string, day string"), path, ["day"])
    got = {(r["a"], r["b"], r["day"]) for r in tables.load_table(spark, path).collect()}
    assert got == {("1", None, "x"), ("2", "n", "y")}


def test_unreadable_tables_are_not_taken_for_missing_ones(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        tables.load_table(spark, str(tmp_path / "broken.parquet"))


SALES = "day date, id string, code string, n long"


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(date(2024, 1, d), i, "cds_1", d) for d in (1, 2) for i in "ab"]
    by, keys = ["code", "day"], ["day", "id"]
    tables.upsert_table(spark.createDataFrame(rows, SALES), path, keys, by)
    untouched = sorted((tmp_path / "t" / "code=cds_1" / "day=2024-01-01").glob("*.parquet"))
    change = spark.createDataFrame([(date(2024, 1, 2), "b", "cds_1", 20), (date(2024, 1, 3), "c", "cds_1", 30)], SALES)
    for _ in range(2):
        tables.upsert_table(change, path, keys, by)
        got = {(str(r["day"]), r["id"], r["n"]) for r in tables.load_table(spark, path).collect()}
        assert got == {
            ("2024-01-01", "a", 1), ("2024-01-01", "b", 1), ("2024-01-02", "a", 2),
            ("2024-01-02", "b", 20), ("2024-01-03", "c", 30),
        }
    assert sorted((tmp_path / "t" / "code=cds_1" / "day=2024-01-01").glob("*.parquet")) == untouched


def test_upsert_refuses_duplicates_and_missing_partitions(spark, tmp_path):
    twice = spark.createDataFrame([(date(2024, 1, 1), "a", "c", 1)] * 2, SALES)
    with pytest.raises(ValueError, match="not unique"):
        tables.upsert_table(twice, str(tmp_path / "t"), ["day", "id"], ["code"])
    with pytest.raises(ValueError, match="partition"):
        tables.upsert_table(twice, str(tmp_path / "t"), ["day", "id"], [])


def test_upsert_of_nothing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(date(2024, 1, 1), "a", "c", 1)], SALES)
    tables.upsert_table(one, path, ["day", "id"], ["code"])
    tables.upsert_table(one.limit(0), path, ["day", "id"], ["code"])
    assert tables.load_table(spark, path).count() == 1


def test_empty_frame(spark):
    assert empty(spark, {"a": STRING}).dtypes == [("a", "string")]


def test_providers_write_one_table_side_by_side(spark, tmp_path):
    from functools import partial

    from tillhouse.session import together

    path = str(tmp_path / "shared")

    def load(code, run):
        rows = spark.createDataFrame([(f"p{i}", f"r{run}", code) for i in range(20 * run, 20 * run + 30)], "id string, v string, code string")
        tables.upsert_table(rows, path, ["code", "id"], ["code"])

    for run in range(3):
        together(*[partial(load, code, run) for code in ("a", "b", "c", None)])
    got = {(r["code"], r["id"]): r["v"] for r in tables.load_table(spark, path).collect()}
    assert got == {(c, f"p{i}"): f"r{min(2, i // 20)}" for c in ("a", "b", "c", None) for i in range(70)}


def test_scratch_files_are_removed(spark):
    from tillhouse.session import exists, scratch, written

    with scratch(spark) as folder:
        assert written(spark.range(3)).count() == 3 and exists(spark, folder)
    assert not exists(spark, folder)


@pytest.mark.parametrize("fmt", ["json", "csv", "txt"])
def test_text_feeds_are_stored_compressed(spark, tmp_path, fmt):
    df = spark.range(2000).selectExpr("cast(id as string) id", "repeat('the same attribute on every sale', 5) note").coalesce(1)
    feeds.write_feed(df, str(tmp_path / fmt), fmt)
    files = list((tmp_path / fmt).glob("part-*"))
    assert all(f.name.endswith(".gz") for f in files) and sum(f.stat().st_size for f in files) < 2000 * 160 / 8
    assert feeds.read_feed(spark, str(tmp_path / fmt), fmt, json_lines=True).select("id", "note").exceptAll(df).isEmpty()
