"""The providers: who they are and how their columns map to the model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from tillhouse.functions.columns import provider_code
from tillhouse.operators.conform import FieldMap

# Provider ids, names, security groups and places.
DIRECTORY = {
    1001: {"name": "carretwo_fr", "sgk": 110011, "region": "Europe", "country": "France"},
    1002: {"name": "lidlo_de", "sgk": 110012, "region": "Europe", "country": "Germany"},
    1003: {"name": "targetto_us", "sgk": 110013, "region": "North America", "country": "United States"},
}


@dataclass(frozen=True)
class Provider:
    id: int
    name: str
    region: str
    country: str
    secure_group_key: int  # 0 = open to everyone
    data_source: str
    feed_format: str
    fact: FieldMap
    prod: FieldMap
    site: FieldMap
    tracked_prod: tuple[str, ...]
    tracked_site: tuple[str, ...]
    mask: str | None = None
    fact_extras: tuple[str, ...] = ()
    prod_extras: tuple[str, ...] = ()
    site_extras: tuple[str, ...] = ()
    date_column: str = "date"
    partitioned_by_date: bool = False
    json_lines: bool = False  # a JSON feed comes as lines, which can be split, not as one array per file
    split_arrays: bool = False  # large JSON arrays, read by many tasks a file

    @property
    def code(self) -> str:
        return provider_code(self.id)


def provider(provider_id: int, directory: Mapping[int, Mapping] = DIRECTORY, **mapping) -> Provider:
    """Combine a directory entry with column mappings.

    An unknown provider is an error; one without a security group is open (key 0).
    """
    entry = directory[provider_id]
    return Provider(
        id=provider_id,
        name=entry["name"],
        region=entry["region"],
        country=entry["country"],
        secure_group_key=entry.get("sgk", 0),
        **mapping,
    )


# Ids sent as integers in some files and as text in others are brought to one form,
# the same in facts and dimensions.
NUMBER_AS_TEXT = ("bigint", "string")

# Source column -> model column, per provider.
SALES_FEED = provider(
    1001,
    data_source="uploader",
    feed_format="parquet",
    fact={
        "time_period_end_date": ("date", "date"),
        "prod_id": ("product_id", "string"),
        "site_id": ("store_id", NUMBER_AS_TEXT),
        "pos_sales_units": ("sales_qty", "bigint"),
        "pos_sales_value_usd": ("sales_value_usd", "double"),
    },
    prod={"prod_id": ("product_id", "string"), "prod_name": ("product", "string")},
    site={"site_id": ("store_id", NUMBER_AS_TEXT), "site_name": ("store", "string")},
    tracked_prod=("source_prod_name",),
    tracked_site=("source_site_name",),
    mask="value",
)

_FULL_PRODUCT: FieldMap = {
    "prod_id": ("product_id", "string"),
    "prod_name": ("product", "string"),
    "sector": ("sector", "string"),
    "category": ("category", "string"),
    "item_gtin": ("GTIN", "bigint"),
    "item_description": ("description", "string"),
    "prod_launch_date": ("launch_date", "date"),
}
_FULL_SITE: FieldMap = {
    "site_id": ("store_id", "string"),
    "site_name": ("store", "string"),
    "global_location_number": ("global_location_number", "bigint"),
    "address": ("address", "string"),
    "channel": ("channel", "string"),
    "latitude": ("latitude", "double"),
    "longitude": ("longitude", "double"),
    "city": ("city", "string"),
}
_TRACKED_PRODUCT = (
    "source_prod_name", "source_sector", "source_category",
    "source_item_gtin", "source_item_description", "source_prod_launch_date",
)
_TRACKED_SITE = (
    "source_global_location_number", "source_site_name", "source_address", "source_channel",
    "source_latitude", "source_longitude", "source_city",
)

WIDE_SALES_FEED = provider(
    1002,
    data_source="uploader",
    feed_format="parquet",
    fact={
        "time_period_end_date": ("date", "date"),
        "prod_id": ("product_id", "string"),
        "site_id": ("store_id", "string"),
        "pos_sales_units": ("sales_qty", "bigint"),
        "pos_sales_value_usd": ("sales_value_usd", "double"),
        "pos_sales_value_lc": ("sales_value_local_currency", "double"),
        "returned_qty": ("return_amount", "bigint"),
        "returned_value_lc": ("return_value_local_currency", "double"),
    },
    prod=_FULL_PRODUCT,
    site=_FULL_SITE,
    tracked_prod=_TRACKED_PRODUCT,
    tracked_site=_TRACKED_SITE,
    mask="volume",
)

INVENTORY_FEED = provider(
    1003,
    data_source="delta-share",
    feed_format="txt",
    fact={
        "time_period_end_date": ("date", "date"),
        "prod_id": ("product_id", "string"),
        "site_id": ("store_id", "string"),
        "inventory_qty_on_hand": ("inventory_qty", "bigint"),
        "inventory_qty_on_order": ("units_on_order", "bigint"),
        "inventory_value_on_hand_usd": ("value_on_hand_usd", "double"),
        "inventory_value_on_hand_lc": ("value_on_hand_local_currency", "double"),
    },
    prod=_FULL_PRODUCT,
    site=_FULL_SITE,
    tracked_prod=_TRACKED_PRODUCT,
    tracked_site=_TRACKED_SITE,
    fact_extras=(
        "safety_stock_qty", "cycle_count_variance_qty", "inventory_accuracy_pct", "days_of_supply",
        "shrinkage_qty", "reserved_qty_for_online", "backroom_qty",
    ),
    prod_extras=(
        "product_id", "logo_present_on_pack", "package_material", "shelf_life_days",
        "is_bundle", "brand_marketing_tier", "num_components",
    ),
    site_extras=(
        "store_id", "store_manager_name", "store_opening_date", "format_subtype",
        "store_square_footage", "lease_type", "parking_spaces", "micro_fulfillment_enabled",
    ),
    partitioned_by_date=True,
)

PROVIDERS: dict[int, Provider] = {p.id: p for p in (SALES_FEED, WIDE_SALES_FEED, INVENTORY_FEED)}
