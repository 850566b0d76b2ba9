"""Declared tables of the model, and the check of a frame against them."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
DATE, INSTANT, FLAG = T.DateType(), T.TimestampType(), T.BooleanType()
ANY_STRUCT = T.StructType([])  # accepts every struct, whatever its fields

Columns = dict[str, T.DataType]

# Column names and types of the data model.
PROVENANCE: Columns = {
    "created_at_utc_datetime": INSTANT,
    "created_at_date": DATE,
    "data_source": STRING,
    "data_provider_code": STRING,
    "secure_group_key": T.IntegerType(),
}
VALIDITY: Columns = {"is_current": FLAG, "valid_from": INSTANT, "valid_to": INSTANT}

PROD_DIM: Columns = {
    "prod_id": STRING,
    **PROVENANCE,
    "prod_key": LONG,
    **VALIDITY,
    "source_prod_name": STRING,
    "source_sector": STRING,
    "source_category": STRING,
    "source_subcategory": STRING,
    "source_item_gtin": LONG,
    "source_item_description": STRING,
    "source_prod_launch_date": DATE,
    "corp_prod_name": STRING,
    "corp_sector": STRING,
    "corp_subcategory": STRING,
    "corp_category": STRING,
    "corp_item_description": STRING,
    "extra_attributes": ANY_STRUCT,
}

SITE_DIM: Columns = {
    "site_id": STRING,
    **PROVENANCE,
    "site_key": LONG,
    **VALIDITY,
    "source_global_location_number": LONG,
    "source_site_name": STRING,
    "source_address": STRING,
    "source_channel": STRING,
    "source_latitude": DOUBLE,
    "source_longitude": DOUBLE,
    "source_city": STRING,
    "source_state": STRING,
    "source_county": STRING,
    "source_country": STRING,
    "corp_site_name": STRING,
    "corp_address": STRING,
    "corp_channel": STRING,
    "corp_latitude": DOUBLE,
    "corp_longitude": DOUBLE,
    "corp_city": STRING,
    "corp_state": STRING,
    "corp_county": STRING,
    "corp_country": STRING,
    "extra_attributes": ANY_STRUCT,
}

STORE_FACT: Columns = {
    "time_period_end_date": DATE,
    "prod_id": STRING,
    "site_id": STRING,
    **PROVENANCE,
    "prod_key": LONG,
    "site_key": LONG,
    "pos_sales_units": LONG,
    "pos_sales_value_usd": DOUBLE,
    "pos_sales_value_lc": DOUBLE,
    "returned_qty": LONG,
    "returned_value_usd": DOUBLE,
    "returned_value_lc": DOUBLE,
    "inventory_qty_on_hand": LONG,
    "inventory_qty_on_order": LONG,
    "inventory_value_on_hand_usd": DOUBLE,
    "inventory_value_on_hand_lc": DOUBLE,
    "extra_attributes": ANY_STRUCT,
    "at_masked_pos_sales_units": LONG,
    "at_masked_pos_sales_value_usd": DOUBLE,
    "at_masked_pos_sales_value_lc": DOUBLE,
}

PROD_DIM_REQUIRED = ["prod_key", "prod_id", *PROVENANCE, "is_current", "valid_from"]
SITE_DIM_REQUIRED = ["site_key", "site_id", *PROVENANCE, "is_current", "valid_from"]
STORE_FACT_REQUIRED = [
    "site_id", "prod_id", "time_period_end_date", *PROVENANCE, "prod_key", "site_key",
]

SILVER: dict[str, Columns] = {
    "prod_dim": PROD_DIM, "site_dim": SITE_DIM, "store_fact": STORE_FACT,
}
REQUIRED: dict[str, list[str]] = {
    "prod_dim": PROD_DIM_REQUIRED,
    "site_dim": SITE_DIM_REQUIRED,
    "store_fact": STORE_FACT_REQUIRED,
}


def _gold(columns: Columns) -> Columns:
    """Gold holds ``extra_attributes`` as JSON text, in the last column."""
    return {n: t for n, t in columns.items() if n != "extra_attributes"} | {
        "extra_attributes": STRING
    }


GOLD: dict[str, Columns] = {table: _gold(columns) for table, columns in SILVER.items()}

# Keys that identify one row of each table (upserts, integrity).
FACT_KEYS = ["time_period_end_date", "prod_id", "site_id"]
TABLE_KEYS: dict[str, list[str]] = {
    "prod_dim": ["prod_id", "prod_key"],
    "site_dim": ["site_id", "site_key"],
    "store_fact": FACT_KEYS,
}


def empty(spark: SparkSession, columns: Columns) -> DataFrame:
    """A frame with the declared columns and no rows."""
    nothing = spark.range(1).where(F.lit(False))  # folds away, also inside unions
    return nothing.select(*[F.lit(None).cast(t).alias(n) for n, t in columns.items()])


def in_model(table: str, column: str) -> bool:
    """Whether ``column`` is a standard column of a silver table."""
    if table not in SILVER:
        raise NotImplementedError(f"no declared table named {table!r}")
    return column in SILVER[table]


@dataclass(frozen=True)
class SchemaReport:
    passed: bool
    missing_cols: list[str] = field(default_factory=list)
    type_mismatches: list[dict[str, str]] = field(default_factory=list)
    unexpected_cols: list[str] = field(default_factory=list)

    def as_dict(self) -> dict:
        return asdict(self)


def _accepts(expected: T.DataType, actual: T.DataType) -> bool:
    if isinstance(expected, T.StructType) and not expected.fields:
        return isinstance(actual, T.StructType)
    return expected == actual


def check_schema(schema: T.StructType, expected: Columns, required: list[str]) -> SchemaReport:
    """Compare a frame's schema with the declared one. Runs no job.

    A frame passes when no required column is missing, every known column has the
    declared type, and no unknown column is present.
    """
    actual = {f.name: f.dataType for f in schema.fields}
    missing = sorted(c for c in required if c not in actual)
    unexpected = sorted(c for c in actual if c not in expected)
    mismatched = [
        {"col": c, "expected": t.simpleString(), "actual": actual[c].simpleString()}
        for c, t in expected.items()
        if c in actual and not _accepts(t, actual[c])
    ]
    passed = not (missing or unexpected or mismatched)
    return SchemaReport(passed, missing, mismatched, unexpected)
