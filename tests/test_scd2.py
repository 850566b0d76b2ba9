"""Dimension versions over several batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillhouse.operators.dedupe import latest_per_key
from tillhouse.operators.scd2 import current_versions, snapshot, version_delta, with_surrogate_key
from tillhouse.operators.union import upserted
from tillhouse.session import written

SCHEMA = "prod_id string, created_at_utc_datetime timestamp, source_name string, note string"
DAYS = [datetime(2024, 1, d) for d in (1, 2, 3, 4)]
TRACKED = ["source_name"]


def batch(spark, at, **names):
    rows = [(k, at, v, f"note {at.day}") for k, v in names.items()]
    return spark.createDataFrame(rows, SCHEMA)


def apply(dim, incoming, at, **options):
    delta = written(version_delta(incoming, dim, TRACKED, "prod_id", "prod_key", at, **options))
    return delta, written(delta if dim is None else upserted(dim, delta, ["prod_id", "prod_key"]))


def states(dim):
    return sorted(
        (r["prod_id"], r["source_name"], r["is_current"], r["valid_from"].year, r["valid_to"] and r["valid_to"].day)
        for r in dim.collect()
    )


def assert_invariants(dim):
    by_id = {}
    for r in dim.collect():
        by_id.setdefault(r["prod_id"], []).append(r)
    for versions in by_id.values():
        versions.sort(key=lambda r: r["valid_from"])
        assert sum(r["is_current"] for r in versions) <= 1
        for one, two in zip(versions, versions[1:]):
            assert one["valid_to"] == two["valid_from"]
        assert all(r["valid_to"] is None or r["valid_from"] < r["valid_to"] for r in versions)
        assert versions[0]["valid_from"].year == 1900


def test_three_batches_and_a_replay(spark):
    first = batch(spark, DAYS[0], same="s", changed="A", gone="g")
    _, dim = apply(None, first, DAYS[0])
    assert states(dim) == [
        ("changed", "A", True, 1900, None), ("gone", "g", True, 1900, None), ("same", "s", True, 1900, None),
    ]

    second = batch(spark, DAYS[1], same="s", changed="B", new="n")
    delta, dim = apply(dim, second, DAYS[1])
    assert states(delta) == [
        ("changed", "A", False, 1900, 2), ("changed", "B", True, 2024, None), ("new", "n", True, 1900, None),
    ]
    assert ("gone", "g", True, 1900, None) in states(dim)
    assert_invariants(dim)

    replay, again = apply(dim, second, DAYS[2])
    assert replay.isEmpty()
    assert states(again) == states(dim)

    reverted = batch(spark, DAYS[3], changed="A")
    delta, _ = apply(dim, reverted, DAYS[3])
    assert delta.isEmpty(), "an earlier state is already stored"


def test_reopened_versions(spark):
    dim = None
    for day, name in zip(DAYS, "ABAA"):
        delta, dim = apply(dim, batch(spark, day, changed=name), day, reopen_reverted=True)
    assert delta.isEmpty()
    assert states(dim) == [
        ("changed", "A", False, 1900, 2), ("changed", "A", True, 2024, None), ("changed", "B", False, 2024, 3),
    ]
    assert_invariants(dim)
    assert dim.select("prod_key").distinct().count() == 3


def test_latest_row_of_a_batch_wins(spark):
    rows = batch(spark, DAYS[0], p="old").unionByName(batch(spark, DAYS[1], p="new"))
    _, dim = apply(None, rows, DAYS[1])
    assert states(dim) == [("p", "new", True, 1900, None)]


def test_equal_attributes_of_two_entities_stay_apart(spark):
    _, dim = apply(None, batch(spark, DAYS[0], one="x", two="x"), DAYS[0])
    assert dim.select("prod_key").distinct().count() == 2


def test_keys_are_stable_across_column_orders(spark):
    df = spark.createDataFrame([("p", "a", "b")], "prod_id string, source_x string, corp_y string")
    one = with_surrogate_key(df, ["source_x"], "prod_id", "k").first()["k"]
    two = with_surrogate_key(df.select("corp_y", "source_x", "prod_id"), ["source_x"], "prod_id", "k").first()["k"]
    assert one == two
    changed = with_surrogate_key(df.withColumn("corp_y", F.lit("c")), ["source_x"], "prod_id", "k").first()["k"]
    assert changed != one, "corporate columns are tracked too"


def test_missing_tracked_column(spark):
    with pytest.raises(ValueError, match="source_gone"):
        with_surrogate_key(spark.range(1), ["source_gone"], "id", "k")


def test_attribute_struct_may_gain_fields(spark):
    base = "prod_id string, created_at_utc_datetime timestamp, source_name string, extra_attributes struct<{}>"
    one = spark.createDataFrame([("p", DAYS[0], "A", ("1",))], base.format("x:string"))
    two = spark.createDataFrame([("p", DAYS[1], "B", ("2", "3"))], base.format("x:string,y:string"))
    _, dim = apply(None, one, DAYS[0])
    delta, dim = apply(dim, two, DAYS[1])
    found = {r["source_name"]: r["extra_attributes"].asDict() for r in delta.collect()}
    assert found == {"A": {"x": "1", "y": None}, "B": {"x": "2", "y": "3"}}


def test_current_and_snapshot(spark):
    _, dim = apply(None, batch(spark, DAYS[0], p="A"), DAYS[0])
    _, dim = apply(dim, batch(spark, DAYS[2], p="B"), DAYS[2])
    assert [r["source_name"] for r in current_versions(dim).collect()] == ["B"]
    assert [r["source_name"] for r in snapshot(dim, DAYS[1]).collect()] == ["A"]
    assert [r["source_name"] for r in snapshot(dim, DAYS[2]).collect()] == ["B"]


def test_random_histories_equal_a_plain_replay(spark):
    rnd = random.Random(7)
    dim, expected = None, {}
    for step in range(4):
        at = DAYS[0] + timedelta(days=step)
        names = {f"p{i}": rnd.choice("ABC") for i in range(20) if rnd.random() < 0.6}
        _, dim = apply(dim, batch(spark, at, **names), at)
        for entity, name in names.items():
            known = expected.setdefault(entity, {})
            if name not in known:
                for state in known.values():
                    state[1] = state[1] or at
                known[name] = [at if known else datetime(1900, 1, 1), None]
    found = {(r["prod_id"], r["source_name"]): [r["valid_from"], r["valid_to"]] for r in dim.collect()}
    assert found == {(e, n): span for e, known in expected.items() for n, span in known.items()}


def test_dedupe_ties_do_not_depend_on_order(spark):
    rows = [("p", DAYS[0], v, None) for v in "cab"]
    for order in (rows, rows[::-1]):
        out = latest_per_key(spark.createDataFrame(order, SCHEMA).repartition(3), ["prod_id"])
        assert [r["source_name"] for r in out.collect()] == ["a"]


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.createDataFrame([("p", DAYS[0], "a", "n")], SCHEMA)
    plan = latest_per_key(df, ["prod_id"])._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial
