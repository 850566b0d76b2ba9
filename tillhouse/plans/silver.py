"""From bronze rows to silver dimensions and facts of one provider."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tillhouse.functions.columns import prefix_columns
from tillhouse.operators.bronze import to_bronze
from tillhouse.operators.conform import conform, with_global_ids
from tillhouse.operators.dedupe import distinct_rows, latest_per_key
from tillhouse.operators.joins import DEFAULT_LIMITS, JoinLimits, enrich, point_in_time_join
from tillhouse.operators.masking import apply_mask
from tillhouse.operators.scd2 import version_delta
from tillhouse.plans.providers import Provider
from tillhouse.schemas import FACT_KEYS
from tillhouse.sources.master import REQUIRED_ANYWHERE


def bronze(feed: DataFrame, who: Provider, as_of: datetime) -> DataFrame:
    return to_bronze(feed, who.id, who.secure_group_key, who.data_source, as_of)


def _dimension(
    rows: DataFrame,
    existing: DataFrame | None,
    master: DataFrame | None,
    tracked: tuple[str, ...],
    natural_key: str,
    key: str,
    master_key: str,
    as_of: datetime,
    limits: JoinLimits,
    **options,
) -> DataFrame:
    # Attributes repeat on every sale: copies go by hash before anything is sorted.
    one_each = latest_per_key(distinct_rows(rows), [natural_key])
    dim = prefix_columns(one_each, "source", [*REQUIRED_ANYWHERE, "extra_attributes"])
    if master is not None and f"source_{master_key}" in dim.columns:
        dim = enrich(dim, master, f"source_{master_key}", f"corp_{master_key}", limits)
    dim = with_global_ids(dim, natural_key)
    return version_delta(dim, existing, tracked, natural_key, key, as_of, one_each=True, **options)


def prod_dim_delta(
    raw: DataFrame,
    who: Provider,
    existing: DataFrame | None,
    master: DataFrame | None,
    as_of: datetime,
    limits: JoinLimits = DEFAULT_LIMITS,
    **options,
) -> DataFrame:
    """Changed and new product versions in bronze rows, enriched with master data by GTIN.

    Providers that send no GTIN are not enriched. Options go to ``version_delta``.
    """
    rows = conform(raw, "prod_dim", who.prod, who.prod_extras)
    return _dimension(
        rows, existing, master, who.tracked_prod, "prod_id", "prod_key", "item_gtin",
        as_of, limits, **options,
    )


def site_dim_delta(
    raw: DataFrame,
    who: Provider,
    existing: DataFrame | None,
    master: DataFrame | None,
    as_of: datetime,
    limits: JoinLimits = DEFAULT_LIMITS,
    **options,
) -> DataFrame:
    """Changed and new site versions, enriched with master data by global location number."""
    rows = conform(raw, "site_dim", who.site, who.site_extras)
    return _dimension(
        rows, existing, master, who.tracked_site, "site_id", "site_key", "global_location_number",
        as_of, limits, **options,
    )


def keyed_days(
    raw: DataFrame,
    who: Provider,
    prod_dim: DataFrame,
    site_dim: DataFrame,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Daily facts without masks: one row per date, product and site, with version keys.

    Of several rows with the same key the latest ingested counts. The only exchange is
    the one that drops copies; with dimensions that fit in memory the key lookups
    shuffle nothing. A fact without a product or site version fails the job.
    """
    facts = conform(raw, "store_fact", who.fact, who.fact_extras)
    facts = with_global_ids(latest_per_key(facts, FACT_KEYS), "prod_id", "site_id")
    facts = point_in_time_join(facts, prod_dim, "prod_id", "prod_key", limits=limits)
    return point_in_time_join(facts, site_dim, "site_id", "site_key", limits=limits)


def day_fact(
    raw: DataFrame,
    who: Provider,
    prod_dim: DataFrame,
    site_dim: DataFrame,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Daily facts with version keys and, for masked providers, moving averages by series."""
    facts = keyed_days(raw, who, prod_dim, site_dim, limits)
    return apply_mask(facts, who.mask, "daily") if who.mask else facts
