"""Small feeds in the providers' own layouts, written as plain files."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pandas as pd

START = date(2024, 1, 1)
PRODUCTS, STORES = 3, 2


def _days(first: int, last: int):
    return [(START + timedelta(days=d)).isoformat() for d in range(first, last)]


def _grid(first, last):
    return [
        {"date": d, "store": f"Store_{s:03d}", "product": f"Product {p}", "product_id": p, "store_id": s}
        for d in _days(first, last)
        for s in range(STORES)
        for p in range(PRODUCTS)
    ]


def _units(row) -> int:
    return (int(row["date"][-2:]) * 7 + row["product_id"] * 3 + row["store_id"]) % 50


def _product(p, name=None):
    return {
        "product": name or f"Product {p}", "category": "Shampoos", "sector": "Beauty", "launch_date": "2020-02-29",
        "GTIN": f"{p + 1:013d}", "description": f"text | {p}",
    }


def _store(s):
    return {
        "city": f"City {s}", "address": f"{s} Main St", "channel": "Online", "latitude": 1.5 + s,
        "longitude": -2.25, "global_location_number": f"{s + 1:013d}",
    }


def daily_sales(folder: Path, first: int, last: int) -> list[str]:
    """One parquet per day, narrow."""
    folder.mkdir(parents=True, exist_ok=True)
    paths = []
    for offset in range(first, last):
        rows = _grid(offset, offset + 1)
        for r in rows:
            r["sales_qty"] = _units(r)
            r["sales_value_usd"] = round(_units(r) * 1.25, 2)
        path = folder / f"daily_{rows[0]['date'].replace('-', '')}.parquet"
        pd.DataFrame(rows).to_parquet(path)
        paths.append(str(path))
    return paths


def all_dates(folder: Path, first: int, last: int, names=None) -> str:
    """One parquet with many dates and all attributes."""
    folder.mkdir(parents=True, exist_ok=True)
    rows = _grid(first, last)
    for r in rows:
        r |= _product(r["product_id"], (names or {}).get(r["product_id"])) | _store(r["store_id"])
        r |= {
            "sales_qty": _units(r), "sales_value_usd": _units(r) * 2.0, "sales_value_local_currency": _units(r) * 1.5,
            "return_amount": 1, "return_value_local_currency": 0.5,
        }
    path = folder / f"all_dates_{first}.parquet"
    pd.DataFrame(rows).to_parquet(path)
    return str(path)


def inventory_texts(folder: Path, first: int, last: int) -> list[str]:
    """One pipe-delimited text file per store."""
    folder.mkdir(parents=True, exist_ok=True)
    paths = []
    for s in range(STORES):
        rows = [r for r in _grid(first, last) if r["store_id"] == s]
        for r in rows:
            r |= _product(r["product_id"]) | _store(s)
            r["description"] = "plain"
            r |= {
                "inventory_qty": _units(r), "units_on_order": 3, "value_on_hand_usd": "1.50",
                "value_on_hand_local_currency": 2.5, "safety_stock_qty": 4, "cycle_count_variance_qty": -1,
                "inventory_accuracy_pct": 0.975, "days_of_supply": 12.5, "shrinkage_qty": 0,
                "reserved_qty_for_online": 9, "backroom_qty": 11, "logo_present_on_pack": "Y",
                "package_material": "PET", "shelf_life_days": 90, "is_bundle": "N", "brand_marketing_tier": "Tier1",
                "num_components": 1, "store_manager_name": "Ann", "store_opening_date": "1999-09-09",
                "format_subtype": "Mini", "store_square_footage": 100, "lease_type": "Owned", "parking_spaces": 5,
                "micro_fulfillment_enabled": "Y",
            }
        path = folder / f"sales_{first}_{s}.txt"
        pd.DataFrame(rows).to_csv(path, sep="|", index=False)
        paths.append(str(path))
    return paths


def masters(folder: Path) -> tuple[str, str]:
    folder.mkdir(parents=True, exist_ok=True)
    product, site = folder / "product.parquet", folder / "site.parquet"
    pd.DataFrame(
        [{"item_gtin": 1, "prod_name": "Corp 0", "sector": "S", "category": "C", "item_description": "D"}]
    ).to_parquet(product)
    pd.DataFrame(
        [{"global_location_number": 2, "site_name": "Corp 1", "address": "A", "channel": "Ch", "latitude": 1.0, "longitude": 2.0}]
    ).to_parquet(site)
    return str(product), str(site)
