"""Raw layer: everything as text, tagged with provider, security group and ingestion."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import as_text, instant, non_strings, provider_code


def strings_only(df: DataFrame) -> DataFrame:
    """Every column as text; doubles in plain decimal form, as files of text would hold them."""
    others = set(non_strings(df))
    return df.select([as_text(df, c).alias(c) if c in others else F.col(c) for c in df.columns])


def with_security(df: DataFrame, secure_group_key: int) -> DataFrame:
    return df.withColumn("secure_group_key", F.lit(secure_group_key).cast("int"))


def with_provider(df: DataFrame, provider_id: int | str) -> DataFrame:
    return df.withColumn("data_provider_code", F.lit(provider_code(provider_id)))


def with_ingestion(df: DataFrame, data_source: str, as_of: datetime) -> DataFrame:
    """Ingestion time, its date (a low-cardinality partition column) and the source name."""
    at = instant(as_of)
    return df.withColumns(
        {
            "created_at_utc_datetime": at,
            "created_at_date": F.to_date(at),
            "data_source": F.lit(data_source),
        }
    )


def to_bronze(
    df: DataFrame, provider_id: int | str, secure_group_key: int, data_source: str, as_of: datetime
) -> DataFrame:
    """One narrow projection over the scan; nothing is shuffled."""
    return (
        df.transform(strings_only)
        .transform(with_security, secure_group_key)
        .transform(with_provider, provider_id)
        .transform(with_ingestion, data_source, as_of)
    )
