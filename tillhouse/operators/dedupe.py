"""Distinct rows and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INGESTED = "created_at_utc_datetime"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct, structs included. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str = INGESTED) -> DataFrame:
    """The newest row of each key; ties go to the smallest remaining values, column by column.

    The rank filter is pushed below the exchange, so each task ships one row per key
    and a key with very many copies never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys and c != newest]
    order = [F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not duplicated_keys(df, keys).isEmpty():
        raise ValueError(f"rows are not unique on {list(keys)}")
    return df
