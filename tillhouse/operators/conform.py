"""Mapping of a provider's columns onto the declared model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import global_id, parse
from tillhouse.schemas import PROVENANCE, in_model

# target column -> (source column, type or chain of types)
FieldMap = Mapping[str, tuple[str, str | tuple[str, ...]]]


def check_extras(table: str, extras: Sequence[str]) -> None:
    """Columns packed as non-standard must not be columns of the model."""
    standard = [c for c in extras if in_model(table, c)]
    if standard:
        raise ValueError(f"{standard} are standard columns of {table}; map them directly")


def pack(extras: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in extras]).alias("extra_attributes")


def conform(
    bronze: DataFrame,
    table: str,
    fields: FieldMap,
    extras: Sequence[str] = (),
    tolerant: bool = False,
) -> DataFrame:
    """Select, rename, cast and pack in one projection, carrying the provenance columns."""
    check_extras(table, extras)
    mapped = [parse(F.col(src), kind, tolerant).alias(name) for name, (src, kind) in fields.items()]
    packed = [pack(extras)] if extras else []
    return bronze.select(*mapped, *[F.col(c) for c in PROVENANCE], *packed)


def rejects(bronze: DataFrame, fields: FieldMap) -> DataFrame:
    """Rows with a value that does not parse, with the names of the failing columns."""
    failing = [
        F.when(F.col(src).isNotNull() & parse(F.col(src), kind, tolerant=True).isNull(), F.lit(src))
        for src, kind in fields.values()
    ]
    marked = bronze.withColumn("rejected_columns", F.array_distinct(F.array_compact(F.array(*failing))))
    return marked.filter(F.size("rejected_columns") > 0)


def with_global_ids(df: DataFrame, *id_columns: str) -> DataFrame:
    return df.withColumns({c: global_id(c) for c in id_columns})


def of_provider(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col("data_provider_code") == code)
