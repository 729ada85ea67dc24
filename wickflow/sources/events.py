"""One-minute candles built from a table of timestamped values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickflow.schemas import RAW_COLUMNS


def candles_from_events(events: DataFrame, exchange: str = "test") -> DataFrame:
    """Each event type is a symbol; its values in one minute make a candle.

    Minutes without events have no candle. The aggregate combines on the map
    side, so a frequent event type costs no more to shuffle than a rare one. Time
    and id are packed into one number: ordered by a struct, the aggregate would sort.
    """
    start = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    order = F.expr(
        "CAST(unix_micros(CAST(ts AS TIMESTAMP)) AS DECIMAL(18,0)) * 10000000000000000000BD"
        " + coalesce(event_id, -9223372036854775807)"
    )
    bars = events.groupBy(F.col("event_type").alias("symbol"), start.alias("candle_start_time")).agg(
        F.max("ts").cast("timestamp").alias("event_time"),
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
    )
    return bars.select(
        F.lit(exchange).alias("exchange"),
        "symbol",
        F.lit("1m").alias("interval"),
        "event_time",
        "candle_start_time",
        (F.col("candle_start_time") + F.expr("interval 59.999 seconds")).alias(
            "candle_close_time"
        ),
        "open",
        "high",
        "low",
        "close",
        F.lit(True).alias("is_closed"),
        F.col("event_time").alias("ingestion_timestamp"),
    ).select(*RAW_COLUMNS)
