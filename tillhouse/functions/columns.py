"""Identifiers, keys, parsing, column selection and attribute packing."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = datetime(1900, 1, 1, tzinfo=timezone.utc)  # start of an entity's first version
PROVIDER_PREFIX = "cds_"


def instant(value: datetime) -> Column:
    """A UTC instant as a literal; a naive value is taken as UTC."""
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return F.lit(aware.astimezone(timezone.utc))


def provider_code(provider_id: int | str) -> str:
    """``1001`` and ``cds_1001`` both give ``cds_1001``."""
    text = str(provider_id)
    return text if text.startswith("cds") else f"{PROVIDER_PREFIX}{text}"


def global_id(id_column: str) -> Column:
    """Provider number followed by the provider's own id; null id gives null.

    The leading characters c, d, s and _ are stripped as a set, not as a prefix.
    """
    number = F.ltrim(F.col("data_provider_code"), F.lit(PROVIDER_PREFIX))
    return F.concat(number, F.col(id_column))


def surrogate_key(columns: list[str], algorithm: str = "xxhash64") -> Column:
    """A 64-bit key of the values of ``columns`` taken as text, null as empty.

    ``xxhash64`` hashes the fields one by one, so a separator inside a value cannot
    make two different rows equal. ``md5`` gives keys other engines can recompute:
    the first 15 hex digits of the digest of the values joined with ``|``.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    if algorithm == "xxhash64":
        return F.xxhash64(*texts)
    if algorithm == "md5":
        digest = F.md5(F.concat_ws("|", *texts))
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown key algorithm {algorithm!r}")


def _parse_date(text: Column, tolerant: bool) -> Column:
    """The plain cast is several times faster than the pattern, but would take other layouts too."""
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    usual = (F.length(text) == 10) & dashes
    if tolerant:
        return F.when(usual, text.try_cast("date")).otherwise(F.try_to_date(text, "yyyy-MM-dd"))
    return F.when(usual, text.cast("date")).otherwise(F.to_date(text, "yyyy-MM-dd"))


def parse(column: Column, types: str | tuple[str, ...], tolerant: bool = False) -> Column:
    """Cast through ``types`` in order; dates are ``yyyy-MM-dd``.

    A value that does not parse fails the job, or gives null when ``tolerant``.
    """
    for name in (types,) if isinstance(types, str) else types:
        if name == "date":
            column = _parse_date(column, tolerant)
        else:
            column = column.try_cast(name) if tolerant else column.cast(name)
    return column


def as_text(df: DataFrame, name: str) -> Column:
    """A column as text. Doubles never get an exponent between 1e-12 and 1e28, where all their digits fit a decimal."""
    column, text = F.col(name), F.col(name).cast("string")
    if not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return text
    size = F.abs(column)
    digits = F.when(size >= 1, column.cast("decimal(38,10)").cast("string")).otherwise(column.cast("decimal(38,30)").cast("string"))
    plain = F.regexp_replace(F.regexp_replace(digits, r"0+$", ""), r"\.$", ".0")
    return F.when(text.contains("E") & (size >= 1e-12) & (size < 1e28), plain).otherwise(text)


def non_strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.StringType)]


def numerics(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def starting_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str]) -> DataFrame:
    """Rename every column to ``<prefix>_<name>`` except those in ``keep``."""
    kept = set(keep)
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c not in kept})


def attributes_json(df: DataFrame, column: str = "extra_attributes") -> DataFrame:
    """Turn the attribute struct into JSON text that keeps null fields.

    Frames without the column get a null one; text is left as it is.
    """
    if column not in df.columns:
        return df.withColumn(column, F.lit(None).cast("string"))
    if isinstance(df.schema[column].dataType, T.StructType):
        text = F.to_json(F.col(column), {"ignoreNullFields": "false"})
        return df.withColumn(column, text)
    return df


def _as_struct(value: Column, actual: T.StructType, wanted: T.StructType) -> Column:
    have = {f.name for f in actual.fields}
    fields = [
        (value[f.name] if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wanted.fields
    ]
    return F.when(value.isNotNull(), F.struct(*fields))


def fit(value: Column, actual: T.DataType | None, wanted: T.DataType) -> Column:
    """``value`` as type ``wanted``: absent gives null, structs are matched by field name."""
    if actual is None:
        return F.lit(None).cast(wanted)
    if actual == wanted:
        return value
    if isinstance(wanted, T.StructType) and isinstance(actual, T.StructType):
        return _as_struct(value, actual, wanted)
    return value.cast(wanted)


def attributes_variant(df: DataFrame, column: str = "extra_attributes") -> DataFrame:
    """The attributes as VARIANT, from the struct or from JSON text: a column of one type for all providers, whose fields
    ``attribute`` takes out typed without parsing text again. Frames without the column get a null one; fields that are
    null stay, and a text that is no JSON fails the job."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(None).cast("variant"))
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return df.withColumn(column, F.when(F.col(column).isNotNull(), F.to_variant_object(column)))
    return df.withColumn(column, F.parse_json(column)) if isinstance(kind, T.StringType) else df


def attribute(name: str, kind: str, column: str = "extra_attributes", tolerant: bool = False) -> Column:
    """A field of the attributes as ``kind``. Absent and null fields give null; one of another kind fails the job, or gives null when ``tolerant``."""
    if "'" in name:
        raise ValueError(f"a path to {name!r} cannot be written")
    path = f"$['{name}']"
    return (F.try_variant_get if tolerant else F.variant_get)(F.col(column), path, kind)


def attribute_kinds(df: DataFrame, column: str = "extra_attributes") -> DataFrame:
    """One row with the fields that the attributes of all rows hold, and their types."""
    return df.agg(F.schema_of_variant_agg(column).alias("attribute_schema"))
