"""Live ingest: kline messages to the raw table.

A micro-batch takes the place of an in-memory buffer, and its trigger that of the
flush interval. What was read is in the checkpoint, so a stopped or lost job goes
on without losing or repeating a message. Late candles are never dropped: there is
no watermark, and a candle goes to the partition of its own start date.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wickflow.functions.kline import EXCHANGE, INTERVAL, SYMBOLS, judge_klines, parse_klines
from wickflow.plans.landing import stream_batch, write_batch
from wickflow.session import configure
from wickflow.sources.raw import with_start_date
from wickflow.streaming.buffer import buffered

# Fixed value: seconds between two flushes.
FLUSH_SECONDS = 300


def message_stream(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """Messages from text files, one per line, as they arrive under ``path``.

    ``max_files`` bounds a micro-batch.
    """
    # the default leaves out files a week older than the newest
    source = spark.readStream.option("maxFilesPerTrigger", max_files).option("maxFileAge", "36500d")
    return source.text(path)


def ingest(
    messages: DataFrame,
    raw_path: str,
    checkpoint: str,
    symbols: Iterable[str] = SYMBOLS,
    interval: str = INTERVAL,
    exchange: str = EXCHANGE,
    bad_prices: str = "drop",
    flush_seconds: int = FLUSH_SECONDS,
    drain: bool = False,
    rejected_path: str | None = None,
    flush_events: int | None = None,
) -> StreamingQuery:
    """Starts the stream from ``messages`` (a streaming ``value`` column).

    ``drain`` processes what is there and stops. Each micro-batch is a batch of the
    raw table, with one file per partition while that is small. No log of files is
    kept beside them, so landing may take them and other jobs may append. With
    ``rejected_path`` the messages that gave no candle are kept there, each with its reason;
    both outputs come from one pass over the messages.

    With ``flush_events`` a symbol's candles are held back until there are so many of them,
    or ``flush_seconds`` after the first of them, as keyed state (``streaming.buffer``);
    micro-batches then follow each other at once. What ``drain`` leaves held goes on with
    the next run.
    """
    spark = configure(messages.sparkSession)
    wait = flush_seconds if flush_events is None else 0
    trigger = {"availableNow": True} if drain else {"processingTime": f"{wait} seconds"}
    if drain and flush_events is not None:
        trigger = {"once": True}  # with timers there is always another batch to run
    if flush_events is not None and rejected_path is not None:
        raise ValueError("candles are held back, or rejected messages kept, not both in one stream")
    if rejected_path is None:
        candles = parse_klines(messages, symbols, interval, exchange, bad_prices)
        rows = with_start_date(candles if flush_events is None else buffered(candles, flush_events, flush_seconds))
    elif bad_prices == "drop":
        rows = judge_klines(messages, symbols, interval, exchange)
    else:
        raise ValueError("messages are rejected with bad_prices='drop' only")

    def flush(rows: DataFrame, number: int) -> None:
        batch = stream_batch(spark, checkpoint, number)
        if rejected_path is None:
            write_batch(rows, raw_path, batch)
            return
        rows = rows.persist()
        write_batch(with_start_date(rows.filter("reason IS NULL").select("candle.*")), raw_path, batch)
        (
            rows.filter("reason IS NOT NULL")
            .select("value", "reason", F.current_timestamp().alias("rejected_at"), F.lit(batch).alias("batch"))
            .hint("rebalance")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(rejected_path)
        )
        rows.unpersist()

    return (
        rows.writeStream.foreachBatch(flush)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def rejected_messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages that gave no candle: value, reason, rejected_at and batch."""
    return spark.read.schema("value string, reason string, rejected_at timestamp, batch string").parquet(path)
