"""Unions by name, and keyed upserts as a function of two frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.columns import fit
from tillhouse.schemas import Columns


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named keys, of which nulls match; the keys are kept once."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys])
    return left.join(named, same, how).drop(*[f"_right_{k}" for k in keys])


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def relaxed_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name: missing columns are null, numbers widen, text beats any other type."""
    kinds: dict[str, set] = {}
    for df in frames:
        for f in df.schema:
            kinds.setdefault(f.name, set()).add(f.dataType)
    as_text = {
        c
        for c, types in kinds.items()
        if len(types) > 1 and T.StringType() in types and all(_plain(t) for t in types)
    }
    cast = [
        df.select([F.col(c).cast("string").alias(c) if c in as_text else F.col(c) for c in df.columns])
        for df in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def to_declared(df: DataFrame, columns: Columns) -> DataFrame:
    """The declared columns in order, cast to their types; columns unknown to the model follow."""
    have = {f.name: f.dataType for f in df.schema}
    declared = [
        fit(F.col(c), have.get(c), t).alias(c) if c in have else F.lit(None).cast(t).alias(c)
        for c, t in columns.items()
    ]
    return df.select(*declared, *[c for c in df.columns if c not in columns])


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str], added: DataFrame | None = None) -> DataFrame:
    """Target rows whose key is not in the source, plus all source rows.

    The source must be unique on the keys (``dedupe.require_unique``). A null key matches a
    null key, so that applying a source twice changes nothing. ``added`` is the source as it goes into the result, if
    something is to watch it there.
    """
    kept = null_safe_join(target, source.select(*keys), keys, "left_anti")
    return kept.unionByName(source if added is None else added, allowMissingColumns=True)
