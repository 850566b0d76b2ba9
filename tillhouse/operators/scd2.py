"""Slowly changing dimensions, type 2, with hashed surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import EPOCH, fit, instant, starting_with, surrogate_key
from tillhouse.functions.periods import valid_on
from tillhouse.operators.dedupe import latest_per_key
from tillhouse.operators.union import null_safe_join

VALIDITY = ["is_current", "valid_from", "valid_to"]


def tracked_columns(df: DataFrame, tracked: Sequence[str]) -> list[str]:
    """The configured columns plus all corporate ones, sorted so that keys are stable."""
    columns = sorted({*tracked, *starting_with(df, "corp_")})
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"tracked columns {missing} are not among {df.columns}")
    return columns


def with_surrogate_key(
    df: DataFrame, tracked: Sequence[str], natural_key: str, key: str, algorithm: str = "xxhash64"
) -> DataFrame:
    """Add ``key``, a hash of the natural key and the tracked values.

    With the natural key in the hash two entities with equal attributes stay apart.
    """
    columns = [natural_key, *tracked_columns(df, tracked)]
    return df.withColumn(key, surrogate_key(columns, algorithm))


def _open_from(start: Column) -> dict[str, Column]:
    return {
        "is_current": F.lit(True),
        "valid_from": start,
        "valid_to": F.lit(None).cast("timestamp"),
    }


def initial_versions(
    incoming: DataFrame,
    tracked: Sequence[str],
    natural_key: str,
    key: str,
    algorithm: str = "xxhash64",
    one_each: bool = False,
) -> DataFrame:
    """First load: one current version per entity, valid since 1900."""
    batch = incoming if one_each else latest_per_key(incoming, [natural_key])
    keyed = with_surrogate_key(batch, tracked, natural_key, key, algorithm)
    return keyed.withColumns(_open_from(instant(EPOCH)))


def version_delta(
    incoming: DataFrame,
    existing: DataFrame | None,
    tracked: Sequence[str],
    natural_key: str,
    key: str,
    as_of: datetime,
    reopen_reverted: bool = False,
    algorithm: str = "xxhash64",
    one_each: bool = False,
) -> DataFrame:
    """Rows to upsert into the dimension on (natural key, key): opened and expired versions.

    Of several rows of an entity in one batch the latest counts; pass ``one_each`` if
    there is only one, to save the exchange that finds it. A row whose key is
    already stored changes nothing, so replaying a batch gives an empty delta; that
    also holds for an entity that goes back to an earlier state. With
    ``reopen_reverted`` changes are found against the current version instead, and the
    key is drawn from the state and its start, so such an entity gets a new version.
    Entities missing from the batch are left alone. A null natural key is an entity like any
    other, so it too has one current version and an empty delta on replay.
    """
    if existing is None:
        return initial_versions(incoming, tracked, natural_key, key, algorithm, one_each)
    start = instant(as_of)
    batch = incoming if one_each else latest_per_key(incoming, [natural_key])
    keyed = with_surrogate_key(batch, tracked, natural_key, key, algorithm)
    keyed = keyed.withColumns(_open_from(start))
    layout = existing.limit(0).unionByName(keyed.limit(0), allowMissingColumns=True).schema

    current = existing.filter("is_current")
    old = F.struct(*[F.col(c) for c in existing.columns]).alias("_old")
    if reopen_reverted:
        state = surrogate_key([natural_key, *tracked_columns(keyed, tracked)], algorithm)
        stored_state = current.select(natural_key, old, state.alias("_old_state"))
        paired = null_safe_join(keyed.withColumn("_state", state), stored_state, [natural_key], "left")
        paired = paired.filter(~F.col("_state").eqNullSafe(F.col("_old_state")))
        # A first version has the usual key; a later one also depends on its start.
        later = paired.withColumn("_start", start).withColumn(
            "_later_key", surrogate_key(["_state", "_start"], algorithm)
        )
        first = F.col("_old").isNull()
        paired = later.withColumn(key, F.when(first, F.col(key)).otherwise(F.col("_later_key")))
    else:
        fresh = null_safe_join(keyed, existing.select(natural_key, key), [natural_key, key], "left_anti")
        paired = null_safe_join(fresh, current.select(natural_key, old), [natural_key], "left")

    # One pass writes both rows of a change: the new version and the expired old one.
    is_update = F.col("_old").isNotNull()
    sides = F.when(is_update, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = paired.withColumn("_expire", F.explode(sides))
    opened = {f.name: f.dataType for f in keyed.schema}
    stored = {f.name: f.dataType for f in existing.schema}
    expired = {"is_current": F.lit(False), "valid_to": start}
    columns = []
    for field in layout:
        name = field.name
        new = fit(F.col(name), opened.get(name), field.dataType) if name in opened else F.lit(None)
        if name == "valid_from":
            new = F.when(is_update, start).otherwise(instant(EPOCH))
        old = fit(F.col("_old")[name], stored.get(name), field.dataType) if name in stored else F.lit(None)
        old = expired.get(name, old)
        columns.append(F.when(F.col("_expire"), old).otherwise(new).cast(field.dataType).alias(name))
    return rows.select(*columns)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def snapshot(dim: DataFrame, at: datetime) -> DataFrame:
    """Versions valid at an instant."""
    return dim.filter(valid_on(instant(at)))
