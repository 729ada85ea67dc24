"""Date and time keys. All of them follow the session zone, pinned to UTC."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only accepted date form.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MONTH_PATTERN = r"^[0-9]{4}-[0-9]{2}$"


def parse_date(value: str | dt.date) -> dt.date:
    """``YYYY-MM-DD`` as a date; anything else is an error."""
    if isinstance(value, dt.date):
        return value
    if not re.match(DATE_PATTERN, value):
        raise ValueError(f"not a YYYY-MM-DD date: {value!r}")
    return dt.date.fromisoformat(value)


def parse_month(value: str) -> dt.date:
    """First day of a ``YYYY-MM`` month."""
    if not re.match(MONTH_PATTERN, value):
        raise ValueError(f"not a YYYY-MM month: {value!r}")
    return dt.date.fromisoformat(f"{value}-01")


def valid_date(text: Column) -> Column:
    """The date a text names, or NULL when it is not a real ``YYYY-MM-DD`` date."""
    return F.when(text.rlike(DATE_PATTERN), F.try_to_date(text, "yyyy-MM-dd"))


def utc_timestamp(value: Column) -> Column:
    """Coerce a text, date or timestamp to a UTC timestamp."""
    return value.cast("timestamp")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def lookback_start(date: Column, days: int) -> Column:
    """First day of the ``days`` long lookback that ends on ``date``."""
    return F.date_sub(date, days - 1)


def month_days(date: Column) -> Column:
    """Every day of the month that holds ``date``."""
    first = F.trunc(date, "month")
    return F.sequence(first, F.last_day(date), F.expr("interval 1 day"))


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def day_bucket(ts: Column) -> Column:
    return F.to_date(ts)


def month_bucket(ts: Column) -> Column:
    return F.trunc(ts, "month")
