"""Files sent again, and attributes as VARIANT."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillhouse.functions.columns import attribute, attribute_kinds, attributes_json, attributes_variant
from tillhouse.session import written
from tillhouse.streaming import ingest


def test_a_file_sent_again_adds_nothing_and_old_rows_are_not_late(spark, tmp_path):
    landing, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    sends = [spark.range(0, 50).select("id", day(0).alias("date")), spark.range(30, 80).select("id", day(0).alias("date"))]
    sends += [sends[0], spark.range(80, 90).select("id", day(-4000).alias("date"))]  # old sales that come last
    for rows in sends:
        rows.write.mode("append").parquet(landing)
        fresh = ingest.without_resent(ingest.stream_feed(spark, landing, "parquet", rows.schema, files_per_batch=1))
        ingest.append_stream(fresh, out, check).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(90))


def test_rows_are_told_apart_by_the_named_columns_null_included(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    rows.write.parquet(str(tmp_path / "in"))
    fresh = ingest.without_resent(ingest.stream_feed(spark, str(tmp_path / "in"), "parquet", rows.schema), ["k"])
    ingest.append_stream(fresh, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted((r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str) == [1, None]


@pytest.fixture
def dims(spark):
    return spark.createDataFrame([(1, ("x", 7, None)), (2, ("7", None, "it's")), (3, None)], "id int, extra_attributes struct<a string, n int, `q[ s` string>")


def test_variant_from_struct_and_from_text_agree(dims):
    for form in (dims, attributes_json(dims)):
        got = written(attributes_variant(form))
        assert dict(got.dtypes)["extra_attributes"] == "variant"
        picked = got.select("id", attribute("a", "string"), attribute("n", "bigint"), attribute("q[ s", "string"), attribute("none", "int"))
        assert sorted(map(tuple, picked.collect())) == [(1, "x", 7, None, None), (2, "7", None, "it's", None), (3, None, None, None, None)]
        assert attribute_kinds(got).first()[0].startswith("OBJECT<a: STRING, n: BIGINT")
    assert attributes_variant(got).schema == got.schema


def test_a_field_of_another_kind_fails_or_is_null(dims):
    got = attributes_variant(dims.filter("id = 1"))
    assert got.select(attribute("a", "int", tolerant=True)).first()[0] is None
    with pytest.raises(Exception, match="VARIANT"):
        got.select(attribute("a", "int")).collect()
    assert attributes_variant(got.drop("extra_attributes")).first()["extra_attributes"] is None
