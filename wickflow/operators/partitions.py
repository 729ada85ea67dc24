"""Which raw partitions exist, which dates are complete, which are closed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickflow.functions.calendar import parse_date
from wickflow.schemas import RAW_PARTITIONS


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The given date, or today in UTC."""
    return F.current_date() if as_of is None else F.lit(parse_date(as_of))


def raw_partitions(raw: DataFrame) -> DataFrame:
    """Distinct ``(exchange, symbol, date)``."""
    return raw.select(*RAW_PARTITIONS).distinct()


def symbols_by_date(partitions: DataFrame) -> DataFrame:
    """The symbols present on each date, in name order."""
    return partitions.groupBy("date").agg(
        F.sort_array(F.collect_set("symbol")).alias("symbols")
    )


def complete_dates(partitions: DataFrame, symbols: Iterable[str]) -> DataFrame:
    """Dates that hold every one of ``symbols``."""
    wanted = sorted(set(symbols))
    return (
        partitions.filter(F.col("symbol").isin(wanted))
        .groupBy("date")
        .agg(F.countDistinct("symbol").alias("n"))
        .filter(F.col("n") == len(wanted))
        .select("date")
    )


def next_gold_date(
    partitions: DataFrame, symbols: Iterable[str], as_of: dt.date | str | None = None
) -> DataFrame:
    """One row: today when it is complete, else the newest complete date, else NULL."""
    date = F.col("date")
    today = F.max(F.when(date == as_of_date(as_of), date))
    return complete_dates(partitions, symbols).agg(F.coalesce(today, F.max(date)).alias("date"))


def closed_partitions(
    partitions: DataFrame,
    pending: DataFrame,
    closed: DataFrame,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Partitions to mark closed now.

    Their date is before ``as_of``, none of their files is still pending, and
    they are not marked yet.
    """
    return (
        partitions.filter(F.col("date") < as_of_date(as_of))
        .select(*RAW_PARTITIONS)
        .distinct()
        .join(pending, RAW_PARTITIONS, "left_anti")
        .join(closed, RAW_PARTITIONS, "left_anti")
    )
