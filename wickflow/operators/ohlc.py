"""OHLC bars and per-day statistics from candles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickflow.functions.calendar import day_bucket, hour_bucket, month_bucket

# grain -> (bucket column, bucket expression, whether the bar has an average)
GRAINS = {
    "hour": ("hour_ts", hour_bucket, True),
    "day": ("date", day_bucket, False),
    "month": ("month", month_bucket, True),
}


def ohlc(candles: DataFrame, grain: str, keys: Iterable[str] = ("symbol",)) -> DataFrame:
    """Bars by key and hour, day or month of the candle close time.

    First and last price come from ``min_by`` / ``max_by`` on the close time, so
    no sort is needed, the result does not depend on the order rows arrive in,
    and every aggregate combines before the one shuffle: a frequent symbol
    sends one row per bucket and map task.
    """
    name, bucket, averaged = GRAINS[grain]
    keys = list(keys)
    prices = [
        F.min_by("open", "candle_close_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *([F.avg("close").alias("avg_price")] if averaged else []),
        F.max_by("close", "candle_close_time").alias("close"),
    ]
    return candles.groupBy(*keys, bucket(F.col("candle_close_time")).alias(name)).agg(*prices)


def bar_parts(candles: DataFrame, keys: Iterable[str] = ("symbol",)) -> DataFrame:
    """What an hour of candles adds to any bar that holds it: first and last price with
    their times, extremes, and sum and count of the closes."""
    return candles.groupBy(*keys, hour_bucket(F.col("candle_close_time")).alias("hour_ts")).agg(
        F.min("candle_close_time").alias("open_at"),
        F.min_by("open", "candle_close_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("close").alias("close_sum"),
        F.count("close").alias("close_count"),
        F.max("candle_close_time").alias("close_at"),
        F.max_by("close", "candle_close_time").alias("close"),
    )


def merged_bars(parts: DataFrame, grain: str, keys: Iterable[str] = ("symbol",)) -> DataFrame:
    """The bars that ``ohlc`` makes of the candles, from their parts."""
    name, bucket, averaged = GRAINS[grain]
    average = F.try_divide(F.sum("close_sum"), F.sum("close_count")).alias("avg_price")
    return parts.groupBy(*keys, bucket(F.col("hour_ts")).alias(name)).agg(
        F.min_by("open", "open_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *([average] if averaged else []),
        F.max_by("close", "close_at").alias("close"),
    )


def daily_stats(candles: DataFrame) -> DataFrame:
    """Candle count, lowest and highest price by date of the candle *start*."""
    return (
        candles.groupBy(day_bucket(F.col("candle_start_time")).alias("date"))
        .agg(
            F.count("*").alias("candle_count"),
            F.min("low").alias("daily_low"),
            F.max("high").alias("daily_high"),
        )
        .orderBy("date")
    )
