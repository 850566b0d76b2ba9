from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import columns as c
from tillhouse.functions.periods import first_midnight, period_end, period_end_date, period_start


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return df.select(expr.alias("x")).first()["x"]


def test_provider_code_is_not_prefixed_twice():
    assert c.provider_code(1001) == "cds_1001"
    assert c.provider_code("cds_1001") == "cds_1001"


@pytest.mark.parametrize(
    ("code", "id_", "expected"),
    [("cds_1001", "7", "10017"), ("cds_scd_1", "x", "1x"), ("cds_1001", None, None)],
)
def test_global_id_strips_a_character_set(spark, code, id_, expected):
    df = spark.createDataFrame([(code, id_)], "data_provider_code string, id string")
    assert df.select(c.global_id("id").alias("x")).first()["x"] == expected


def test_surrogate_key_treats_null_as_empty_and_keeps_fields_apart(spark):
    df = spark.createDataFrame([("a|", "b"), ("a", "|b"), (None, "b"), ("", "b")], "x string, y string")
    keys = [r["k"] for r in df.select(c.surrogate_key(["x", "y"]).alias("k")).collect()]
    assert keys[0] != keys[1]
    assert keys[2] == keys[3]


def test_md5_key_is_the_published_form(spark):
    assert one(spark, c.surrogate_key(["x", "y"], "md5"), x="a", y="b") == 938760983661274987


def test_unknown_key_algorithm():
    with pytest.raises(ValueError):
        c.surrogate_key([], "sha1")


def test_parse_is_strict_unless_tolerant(spark):
    assert one(spark, c.parse(F.col("x"), "date"), x="2024-02-29") == date(2024, 2, 29)
    with pytest.raises(Exception, match="(?i)cast|parse"):
        one(spark, c.parse(F.col("x"), "bigint"), x="abc")
    with pytest.raises(Exception, match="(?i)pars"):
        one(spark, c.parse(F.col("x"), "date"), x="29.02.2024")
    assert one(spark, c.parse(F.col("x"), "bigint", tolerant=True), x="abc") is None
    assert one(spark, c.parse(F.col("x"), ("bigint", "string")), x="007") == "7"


def test_selectors_and_prefix(spark):
    df = spark.createDataFrame([(1, "a", 2.0, date(2024, 1, 1))], "i int, s string, d double, t date")
    assert c.non_strings(df) == ["i", "d", "t"]
    assert c.numerics(df) == ["i", "d"]
    assert c.prefix_columns(df, "source", ["s"]).columns == ["source_i", "s", "source_d", "source_t"]


def test_attributes_json_keeps_nulls(spark):
    df = spark.createDataFrame([(("a", None),)], "extra_attributes struct<x:string,y:string>")
    assert c.attributes_json(df).first()[0] == '{"x":"a","y":null}'
    without = c.attributes_json(spark.range(1))
    assert without.schema["extra_attributes"].dataType.simpleString() == "string"
    assert without.first()["extra_attributes"] is None


@pytest.mark.parametrize(
    ("day", "week", "month"),
    [
        ("2024-03-03", "2024-03-04", "2024-04-01"),  # Sunday
        ("2024-03-04", "2024-03-11", "2024-04-01"),  # Monday
        ("2023-12-31", "2024-01-01", "2024-01-01"),
        ("2024-01-01", "2024-01-08", "2024-02-01"),
        ("2024-02-29", "2024-03-04", "2024-03-01"),
    ],
)
def test_period_labels(spark, day, week, month):
    d = F.lit(day).cast("date")
    assert str(one(spark, period_end(d, "1w"))) == week
    assert str(one(spark, period_end(d, "1mo"))) == month
    plain = date.fromisoformat(day)
    assert str(period_end_date(plain, "1w")) == week
    assert str(period_end_date(plain, "1mo")) == month
    assert period_start(plain, "1w") <= plain


def test_unknown_period():
    with pytest.raises(ValueError):
        period_start(date(2024, 1, 1), "1y")


@pytest.mark.parametrize(
    ("at", "expected"),
    [(datetime(2024, 1, 1), date(2024, 1, 1)), (datetime(2024, 1, 1, 0, 0, 1), date(2024, 1, 2))],
)
def test_first_midnight(spark, at, expected):
    assert one(spark, first_midnight(c.instant(at))) == expected
