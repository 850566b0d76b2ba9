"""Calendar periods of roll-ups and validity intervals."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

GRANULARITY = {"1w": "weekly", "1mo": "monthly"}


def period_end(date: Column, period: str) -> Column:
    """The exclusive end of the period holding ``date``: next Monday, or next first of month."""
    if period == "1w":
        return F.date_add(F.trunc(date, "week"), 7)
    if period == "1mo":
        return F.add_months(F.trunc(date, "month"), 1)
    raise ValueError(f"unknown period {period!r}, use one of {list(GRANULARITY)}")


def period_start(day: date, period: str) -> date:
    """First day of the period holding ``day``."""
    if period == "1w":
        return day - timedelta(days=day.weekday())
    if period == "1mo":
        return day.replace(day=1)
    raise ValueError(f"unknown period {period!r}, use one of {list(GRANULARITY)}")


def period_end_date(day: date, period: str) -> date:
    """``period_end`` of a plain date."""
    span = timedelta(days=7 if period == "1w" else 32)
    return period_start(period_start(day, period) + span, period)


def first_midnight(at: Column) -> Column:
    """The first date whose midnight is not before the instant ``at``."""
    day = F.to_date(at)
    return F.when(at > day.cast("timestamp"), F.date_add(day, 1)).otherwise(day)


def valid_on(at: Column, valid_from: str = "valid_from", valid_to: str = "valid_to") -> Column:
    """Half-open validity: from <= at < to, where a null end is open."""
    end = F.col(valid_to)
    return (at >= F.col(valid_from)) & (end.isNull() | (at < end))
