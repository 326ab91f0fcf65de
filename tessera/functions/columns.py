"""Small column builders shared by the silver derivations."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_upper(name: str) -> Column:
    """DRV1: ``trim(upper(x))`` (spaces only)."""
    return F.trim(F.upper(F.col(name)))


def clean_lower(name: str) -> Column:
    """DRV2: ``trim(lower(x))``."""
    return F.trim(F.lower(F.col(name)))


def guarded_pct(num: Column, den: Column, guard: Column, scale: int) -> Column:
    """``guard > 0 ? round(num / den * 100, scale) : 0`` (DRV4, DRV8, DRV10, DRV16)."""
    return F.when(guard > 0, F.round(num / den * 100, scale)).otherwise(F.lit(0.0))


def as_of_literal(as_of: _dt.datetime | _dt.date | str | None) -> Column:
    """The reference instant for age computations: ``current_timestamp()``
    unless a fixed instant is injected (tests, reproducible reruns)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        return F.to_timestamp(F.lit(as_of))
    return F.lit(as_of)


def days_since(event: str, as_of: Column) -> Column:
    """DRV7/DRV26: ``event IS NOT NULL ? datediff(as_of, event) : 0``."""
    return F.when(F.col(event).isNotNull(), F.datediff(as_of, F.col(event))).otherwise(F.lit(0))


def ymd(ts: str) -> Column:
    """DRV27/DRV28: ``date_format(ts, 'yyyy-MM-dd')`` as a string."""
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def processing_parts(ts: str = "processing_timestamp", date_as_string: bool = True) -> dict[str, Column]:
    """DRV28 (batch, date as string) and DRV34 (stream, date as DATE)."""
    t = F.col(ts)
    return {
        "processing_date": ymd(ts) if date_as_string else F.to_date(t),
        "processing_hour": F.hour(t),
        "processing_day_of_week": F.dayofweek(t),
        "processing_month": F.month(t),
        "processing_year": F.year(t),
    }


def modulo_code(text: Column | str, n: int, k: int = 0) -> Column:
    """PRJ3: ``abs(whole number in the text) % n + k``; NULL where the text holds
    no number of an int's range. Widened first: the least int has no int abs."""
    c = F.col(text) if isinstance(text, str) else text
    return F.abs(c.try_cast("int").cast("bigint")) % F.lit(n).cast("bigint") + F.lit(k).cast("bigint")
