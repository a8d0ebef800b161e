"""Date and timestamp expressions. All timestamps are UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_timestamp(text: Column) -> Column:
    """ISO text to timestamp; unreadable text becomes null."""
    return F.try_to_timestamp(text)


def utc_date(text: Column) -> Column:
    """Trading day of an ISO text. Through a timestamp: a direct cast to date would take
    the local day of a text with an offset."""
    return F.to_date(F.try_to_timestamp(text))


def day_part(bound: str) -> str:
    """The date of an ISO bound such as ``2024-01-31T23:59:59Z``."""
    return bound.split("T")[0]


def days_before(day: dt.date | str, days: int) -> str:
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return (day - dt.timedelta(days=days)).isoformat()
