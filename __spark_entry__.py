"""Queries of this engine on the given tables, each with SQL for the same result.

Candles are built from ``events`` (see ``wickflow.sources.events``): an event type
is a symbol, its values within a minute are a candle. Computed doubles are rounded
to 8 places on both sides, since engines add in different orders.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickflow.functions import calendar
from wickflow.functions.kline import kline_message, parse_klines, stream_names
from wickflow.operators import features as ft
from wickflow.operators import ohlc as bars
from wickflow.operators import partitions as parts
from wickflow.operators.sequence import Limits
from wickflow.plans import daystates, gold, landing
from wickflow.schemas import FEATURES, RAW_COLUMNS, RAW_TIMESTAMPS
from wickflow.session import configure, scratch_path
from wickflow.sources import index
from wickflow.sources import raw as rawsrc
from wickflow.sources.events import candles_from_events
from wickflow.streaming.ingest import ingest, message_stream
from wickflow.streaming.ingest import rejected_messages as kept_rejects
from wickflow.streaming.subscription import record, subscribe

# The training-data operators are optional: without their folder the rest works.
try:
    import corpus_pipeline
    from wickflow.llm import registry as llm
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not missing.name.startswith("wickflow.llm"):
        raise
    llm = None

SMALLEST = "/root/testdata/sf0.001"
SYMBOLS = ["click", "error", "purchase", "signup", "view"]
EXCHANGE = "test"

# Limits so low that the symbols of the given tables are split.
SPLIT = Limits(symbol_rows=500, partition_rows=20_000, chunk_rows=500)

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs and outputs ------------------------------------------------------


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return candles_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), EXCHANGE)


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rawsrc.with_start_date(candles(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> str:
    """The candles as a raw table on disk; its path."""
    path = scratch_path(spark, "raw")
    landing.append_raw(candles(spark, sf_dir), path)
    return path


def newest_date(raw: DataFrame) -> dt.date:
    return parts.next_gold_date(parts.raw_partitions(raw), SYMBOLS).first().date


def shown(df: DataFrame, rounded: bool = False) -> DataFrame:
    """Timestamps without zone and, where computed, doubles at 8 places."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif rounded and isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 8)
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- raw candles -------------------------------------------------------------


def raw_candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(candles(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per candle, and as many of each kind that has to be left out."""
    number = F.unix_millis("candle_start_time")
    texts = [
        kline_message(),
        kline_message(closed=False),
        kline_message(symbol=F.concat("symbol", F.lit("_other"))),
        kline_message(interval=F.lit("5m")),
        F.to_json(F.struct(F.lit(None).alias("result"), number.alias("id"))),
        F.concat(F.lit("{no json "), number),
    ]
    return candles(spark, sf_dir).select(F.explode(F.array(*texts)).alias("value"))


def parse_kline(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_klines(
        messages(spark, sf_dir), SYMBOLS, exchange=EXCHANGE, ingested_at=F.timestamp_millis("E")
    )
    return shown(parsed)


def nanos_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps as the integers that nanosecond files hold, and back."""
    rows = candles(spark, sf_dir)
    nanos = rows.withColumns({c: F.unix_micros(c) * 1000 + 999 for c in RAW_TIMESTAMPS})
    return shown(rawsrc.nanos_to_micros(nanos).select(*RAW_COLUMNS))


def calendar_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date keys and date arithmetic for every candle date."""
    key = calendar.date_key(F.col("candle_start_time")).alias("date_key")
    date = calendar.valid_date(F.col("date_key"))
    return (
        candles(spark, sf_dir)
        .select(key)
        .distinct()
        .select(
            "date_key",
            calendar.month_key(date).alias("month_key"),
            calendar.lookback_start(date, gold.LOOKBACK_DAYS).alias("lookback_start"),
            F.size(calendar.month_days(date)).alias("days_in_month"),
            F.element_at(calendar.month_days(date), -1).alias("month_end"),
            calendar.valid_date(F.concat("date_key", F.lit("x"))).alias("not_a_date"),
        )
    )


# --- slices ------------------------------------------------------------------


def slice_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dated(spark, sf_dir)
    return shown(rawsrc.raw_slice(raw, date=newest_date(raw)))


def slice_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dated(spark, sf_dir)
    return shown(rawsrc.raw_slice(raw, month=rawsrc.month_of(newest_date(raw))))


def slice_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dated(spark, sf_dir)
    return shown(rawsrc.raw_slice(raw, date=newest_date(raw), lookback_days=7))


# --- bars --------------------------------------------------------------------


def ohlc_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(bars.ohlc(candles(spark, sf_dir), "hour"), rounded=True)


def ohlc_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(bars.ohlc(candles(spark, sf_dir), "day"))


def ohlc_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(bars.ohlc(candles(spark, sf_dir), "month"), rounded=True)


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.daily_stats(candles(spark, sf_dir))


def daily_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statistics as ad-hoc SQL over a glob of raw files, all symbols."""
    path = stored(spark, sf_dir)
    files = spark.read.option("basePath", path).parquet(f"{path}/exchange=*/symbol=*/date=*")
    return spark.sql(
        """
        SELECT to_date(candle_start_time) AS date, count(*) AS candle_count,
               min(low) AS daily_low, max(high) AS daily_high
        FROM {files} GROUP BY to_date(candle_start_time) ORDER BY date
        """,
        files=files,
    )


# --- features ----------------------------------------------------------------


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ft.returns(candles(spark, sf_dir)), rounded=True)


def moving_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ft.moving_averages(candles(spark, sf_dir)), rounded=True)


def volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ft.volatility(candles(spark, sf_dir)).drop("log_return_1"), rounded=True)


def rsi_14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ft.rsi(candles(spark, sf_dir)), rounded=True)


def ema_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ft.ema(candles(spark, sf_dir)), rounded=True)


def ema_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EMAs of groups of bounded size: parts of a symbol, each with a carry."""
    return shown(ft.ema(candles(spark, sf_dir), limits=SPLIT), rounded=True)


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ft.add_calendar(candles(spark, sf_dir).select(*ft.INPUTS)))


def feature_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of all candles."""
    return shown(ft.features(candles(spark, sf_dir)), rounded=True)


def feature_history_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same beyond the limit on a symbol's rows in one task."""
    return shown(ft.features(candles(spark, sf_dir), SPLIT), rounded=True)


def feature_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of the newest complete date, over its 60-day lookback."""
    raw = dated(spark, sf_dir)
    return shown(ft.feature_snapshot(raw, newest_date(raw), gold.LOOKBACK_DAYS), rounded=True)


# --- partitions --------------------------------------------------------------


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions read off the paths of the raw files."""
    files = rawsrc.raw_files(spark, stored(spark, sf_dir))
    return rawsrc.inventory(files).select("exchange", "symbol", "date").distinct()


def symbols_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parts.symbols_by_date(parts.raw_partitions(dated(spark, sf_dir)))
    return found.select("date", F.array_join("symbols", ",").alias("symbols"))


def complete_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.complete_dates(parts.raw_partitions(dated(spark, sf_dir)), SYMBOLS)


def next_gold_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.next_gold_date(parts.raw_partitions(dated(spark, sf_dir)), SYMBOLS)


def closed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left out: the last days, partitions with a high above 300, those marked before."""
    raw = dated(spark, sf_dir)
    return parts.closed_partitions(
        parts.raw_partitions(raw),
        pending=raw.filter("high > 300"),
        closed=raw.filter("date < DATE '2024-01-05'"),
        as_of="2024-01-25",
    )


# --- jobs --------------------------------------------------------------------


def ingest_stream_to_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in text files through the stream into the raw table."""
    incoming, raw = scratch_path(spark, "messages"), scratch_path(spark, "raw")
    messages(spark, sf_dir).write.text(incoming)
    query = ingest(
        message_stream(spark, incoming),
        raw,
        scratch_path(spark, "ingest-checkpoint"),
        SYMBOLS,
        exchange=EXCHANGE,
        drain=True,
    )
    query.awaitTermination()
    return shown(rawsrc.raw_table(spark, raw).drop("ingestion_timestamp"))


def ingest_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams recorded in two rounds and read through a subscription after each."""
    recorded, raw = scratch_path(spark, "streams"), scratch_path(spark, "raw")
    checkpoint = scratch_path(spark, "ingest-checkpoint")
    names = dict(zip(SYMBOLS, stream_names(SYMBOLS, "1m"), strict=True))
    rows = candles(spark, sf_dir).replace(names, subset=["symbol"]).withColumnRenamed("symbol", "stream")
    rows = rows.withColumn("symbol", F.substring_index("stream", "@", 1))
    for own in ("minute(candle_start_time) < 30", "minute(candle_start_time) >= 30"):
        record(rows.filter(own).select("stream", kline_message().alias("value")), recorded)
        stream = subscribe(spark, recorded, SYMBOLS)
        ingest(stream, raw, checkpoint, SYMBOLS, exchange=EXCHANGE, drain=True).awaitTermination()
    return shown(rawsrc.raw_table(spark, raw).drop("ingestion_timestamp"))


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that gave no candle, by reason, as the stream kept them beside the candles."""
    incoming, raw, rejected = (scratch_path(spark, n) for n in ("messages", "raw", "rejected"))
    bad_price = F.regexp_replace("value", '"c":"[^"]*"', '"c":"none"')
    every = messages(spark, sf_dir)
    every.unionByName(every.filter(F.col("value").contains('"x":true')).select(bad_price.alias("value"))).write.text(incoming)
    query = ingest(
        message_stream(spark, incoming),
        raw,
        scratch_path(spark, "ingest-checkpoint"),
        SYMBOLS,
        exchange=EXCHANGE,
        drain=True,
        rejected_path=rejected,
    )
    query.awaitTermination()
    return kept_rejects(spark, rejected).groupBy("reason").agg(F.count("*").alias("n"))


def land_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after every batch came twice, first with other prices, the first copy
    having been archived."""
    incoming, raw = scratch_path(spark, "incoming"), scratch_path(spark, "raw")
    checkpoint, archive = scratch_path(spark, "land-checkpoint"), scratch_path(spark, "archive")
    rows = dated(spark, sf_dir)
    for delivered in (rows.withColumn("close", F.col("close") + 1), rows):
        landing.write_batch(delivered, incoming, "batch-1")
        landing.land_files(spark, incoming, raw, checkpoint, archive, named_folders=True)
    return shown(rawsrc.raw_table(spark, raw))


def partition_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each partition holds, from the index kept by two writes and a landing."""
    incoming, raw = scratch_path(spark, "incoming"), scratch_path(spark, "raw")
    rows = dated(spark, sf_dir)
    landing.append_raw(rows.filter("minute(candle_start_time) < 20"), raw)
    landing.append_raw(rows.filter("minute(candle_start_time) >= 40"), raw)
    landing.append_raw(rows.filter("minute(candle_start_time) BETWEEN 20 AND 39"), incoming)
    paths = scratch_path(spark, "land-checkpoint"), scratch_path(spark, "archive")
    landing.land_files(spark, incoming, raw, *paths, named_folders=True)
    return shown(index.partition_index(spark, raw).drop("n_batches", "changed"))


def feature_snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot from stored day states, after late candles in the middle of the lookback."""
    raw = scratch_path(spark, "raw")
    rows = dated(spark, sf_dir)
    newest = newest_date(rows)
    late = (F.col("date") == F.lit(newest - dt.timedelta(days=9))) & (F.hour("candle_start_time") < 12)
    landing.append_raw(rows.filter(~late), raw)
    daystates.update_states(spark, raw, EXCHANGE, newest - dt.timedelta(days=gold.LOOKBACK_DAYS - 1), newest)
    landing.append_raw(rows.filter(late), raw)
    found = daystates.snapshot_from_states(spark, raw, newest, EXCHANGE, gold.LOOKBACK_DAYS)
    return shown(found, rounded=True)


def land_archive_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions marked closed after two deliveries, the newest day being the second."""
    incoming, raw, closed = (scratch_path(spark, n) for n in ("incoming", "raw", "closed"))
    checkpoint, archive = scratch_path(spark, "land-checkpoint"), scratch_path(spark, "archive")
    everything = dated(spark, sf_dir)
    newest = newest_date(everything)

    def run() -> None:
        landing.land_archive_mark(
            spark, incoming, raw, checkpoint, archive, closed, newest, named_folders=True
        )

    landing.append_raw(everything.filter(F.col("date") < F.lit(newest)), incoming)
    run()
    landing.append_raw(everything.filter(F.col("date") == F.lit(newest)), incoming)
    run()
    return landing.closed_table(spark, closed)


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars published by runs for two dates, the second one run twice."""
    raw, out = stored(spark, sf_dir), scratch_path(spark, "gold")
    last = newest_date(rawsrc.raw_table(spark, raw))
    for date in (last - dt.timedelta(days=1), last, last):
        table = rawsrc.raw_table(spark, raw)
        tables = gold.gold_tables(table, date, SYMBOLS)
        gold.publish(tables, out, date, EXCHANGE)

    def bar(name: str, start: str, average: str) -> DataFrame:
        return gold.gold_table(spark, out, name).select(
            F.lit(name).alias("table_name"),
            "symbol",
            F.col(start).cast("timestamp_ntz").alias("bucket"),
            *("open", "high", "low", "close"),
            F.round(F.expr(average), 8).alias("avg_price"),
        )

    return (
        bar("hourly_ohlc", "hour_ts", "avg_price")
        .unionByName(bar("daily_ohlc", "date", "CAST(NULL AS DOUBLE)"))
        .unionByName(bar("monthly_ohlc", "month", "avg_price"))
    )


def refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table after one refresh step that chose its own date."""
    raw, out = stored(spark, sf_dir), scratch_path(spark, "gold")
    gold.refresh(spark, raw, out, SYMBOLS, EXCHANGE)
    table = gold.gold_table(spark, out, "features").select(*FEATURES.fieldNames())
    return shown(table, rounded=True)


def refresh_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest feature slice, published before late candles came and refreshed for them."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "gold")
    rows = dated(spark, sf_dir)
    newest = newest_date(rows)
    late = (F.col("date") == F.lit(newest - dt.timedelta(days=3))) & (F.hour("candle_start_time") >= 12)
    landing.append_raw(rows.filter(~late), raw)
    gold.gold_run(spark, raw, out, newest, SYMBOLS, EXCHANGE)
    landing.append_raw(rows.filter(late), raw)
    gold.refresh_stale(spark, raw, out, EXCHANGE)
    table = gold.gold_table(spark, out, "features").select(*FEATURES.fieldNames())
    return shown(table, rounded=True)


def bars_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly bars merged from stored hours, after more candles came."""
    raw = scratch_path(spark, "raw")
    rows = dated(spark, sf_dir)
    early = F.hour("candle_start_time") < 12
    first, last = rows.agg(F.min("date"), F.max("date")).first()
    for own in (rows.filter(early), rows.filter(~early)):
        landing.append_raw(own, raw)
        parts = daystates.stored_parts(spark, raw, EXCHANGE, first, last)
    return shown(bars.merged_bars(parts, "month"), rounded=True)


def collect_land_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through ingest, landing, closed marks and a refresh: the feature table."""
    incoming, landed, raw, out = (scratch_path(spark, n) for n in ("messages", "in", "raw", "gold"))
    messages(spark, sf_dir).write.text(incoming)
    checkpoint = scratch_path(spark, "ingest-checkpoint")
    stream = message_stream(spark, incoming)
    ingest(stream, landed, checkpoint, SYMBOLS, exchange=EXCHANGE, drain=True).awaitTermination()
    rest = (scratch_path(spark, n) for n in ("land-checkpoint", "archive", "closed"))
    landing.land_archive_mark(spark, landed, raw, *rest, named_folders=True)
    gold.refresh(spark, raw, out, SYMBOLS, EXCHANGE)
    table = gold.gold_table(spark, out, "features").select(*FEATURES.fieldNames())
    return shown(table, rounded=True)


# --- SQL ---------------------------------------------------------------------

CANDLES = """
WITH RECURSIVE candles AS (
    SELECT 'test' AS exchange, event_type AS symbol, '1m' AS "interval",
           max(ts) AS event_time,
           date_trunc('minute', ts) AS candle_start_time,
           date_trunc('minute', ts) + to_milliseconds(59999) AS candle_close_time,
           arg_min(value, (ts, event_id)) AS open, max(value) AS high,
           min(value) AS low, arg_max(value, (ts, event_id)) AS close,
           true AS is_closed, max(ts) AS ingestion_timestamp
    FROM events GROUP BY event_type, date_trunc('minute', ts)
),
raw AS (SELECT *, CAST(candle_start_time AS DATE) AS date FROM candles),
complete AS (
    SELECT date FROM raw
    WHERE symbol IN ('click', 'error', 'purchase', 'signup', 'view')
    GROUP BY date HAVING count(DISTINCT symbol) = 5
),
chosen AS (
    SELECT coalesce(max(CASE WHEN date = current_date THEN date END), max(date)) AS date
    FROM complete
),
lookback AS (
    SELECT raw.* FROM raw, chosen
    WHERE raw.date BETWEEN chosen.date - 59 AND chosen.date
),
numbered AS (
    SELECT symbol, candle_close_time, close,
           row_number() OVER (PARTITION BY symbol ORDER BY candle_close_time) AS rn
    FROM {source}
),
ema AS (
    SELECT symbol, candle_close_time, close, rn,
           close AS ema_5, close AS ema_15, close AS ema_30, close AS ema_60
    FROM numbered WHERE rn = 1
    UNION ALL
    SELECT n.symbol, n.candle_close_time, n.close, n.rn,
           (1 - 2.0::DOUBLE / 6) * e.ema_5 + 2.0::DOUBLE / 6 * n.close,
           (1 - 2.0::DOUBLE / 16) * e.ema_15 + 2.0::DOUBLE / 16 * n.close,
           (1 - 2.0::DOUBLE / 31) * e.ema_30 + 2.0::DOUBLE / 31 * n.close,
           (1 - 2.0::DOUBLE / 61) * e.ema_60 + 2.0::DOUBLE / 61 * n.close
    FROM ema e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1
),
moves AS (
    -- a logarithm of zero or less is NULL here, as in Spark
    SELECT *, CASE WHEN close / nullif(lag(close) OVER w, 0) > 0
                   THEN ln(close / nullif(lag(close) OVER w, 0)) END AS log_return_1,
           (close - lag(close, 5) OVER w) / nullif(lag(close, 5) OVER w, 0) AS return_5,
           greatest(coalesce(close - lag(close) OVER w, 0), 0) AS gain,
           greatest(coalesce(lag(close) OVER w - close, 0), 0) AS loss
    FROM numbered WINDOW w AS (PARTITION BY symbol ORDER BY candle_close_time)
),
features AS (
    SELECT m.symbol, m.candle_close_time AS ts, m.close,
           round(log_return_1, 8) AS log_return_1, round(return_5, 8) AS return_5,
           round(avg(m.close) OVER w5, 8) AS ma_5, round(avg(m.close) OVER w15, 8) AS ma_15,
           round(avg(m.close) OVER w30, 8) AS ma_30, round(avg(m.close) OVER w60, 8) AS ma_60,
           round(ema_5, 8) AS ema_5, round(ema_15, 8) AS ema_15,
           round(ema_30, 8) AS ema_30, round(ema_60, 8) AS ema_60,
           round(stddev_samp(log_return_1) OVER w5, 8) AS vol_5,
           round(stddev_samp(log_return_1) OVER w15, 8) AS vol_15,
           round(stddev_samp(log_return_1) OVER w30, 8) AS vol_30,
           round(stddev_samp(log_return_1) OVER w60, 8) AS vol_60,
           round(CASE WHEN avg(loss) OVER w14 = 0 THEN 100.0
                ELSE 100 - 100 / (1 + avg(gain) OVER w14 / nullif(avg(loss) OVER w14, 0))
           END, 8) AS rsi_14,
           CAST(hour(m.candle_close_time) AS INTEGER) AS hour_of_day,
           CAST(dayofweek(m.candle_close_time) + 1 AS INTEGER) AS day_of_week
    FROM moves m JOIN ema e ON e.symbol = m.symbol AND e.rn = m.rn
    WINDOW w5 AS (PARTITION BY m.symbol ORDER BY m.candle_close_time
                  ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
           w14 AS (PARTITION BY m.symbol ORDER BY m.candle_close_time
                   ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING),
           w15 AS (PARTITION BY m.symbol ORDER BY m.candle_close_time
                   ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING),
           w30 AS (PARTITION BY m.symbol ORDER BY m.candle_close_time
                   ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING),
           w60 AS (PARTITION BY m.symbol ORDER BY m.candle_close_time
                   ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)
)
"""

RAW_SELECT = """SELECT exchange, symbol, "interval", {event_time}, candle_start_time,
    candle_close_time, open, high, low, close, is_closed{rest} FROM candles"""

BAR = """arg_min(open, candle_close_time) AS open, max(high) AS high, min(low) AS low,
    arg_max(close, candle_close_time) AS close"""

STATS = """SELECT CAST(candle_start_time AS DATE) AS date, count(*) AS candle_count,
    min(low) AS daily_low, max(high) AS daily_high FROM candles GROUP BY 1 ORDER BY 1"""

CLOSED = "SELECT DISTINCT exchange, symbol, date FROM raw WHERE date < DATE '2024-01-25'"


def _feature(*names: str) -> str:
    return f"SELECT symbol, ts AS candle_close_time, close, {', '.join(names)} FROM features"


def _sql(query: str, source: str = "candles") -> str:
    return CANDLES.replace("{source}", source) + query


def oracle_sql() -> dict[str, str]:
    spans = (5, 15, 30, 60)
    ema = _sql(_feature(*(f"ema_{n}" for n in spans)))
    snapshot = _sql(
        "SELECT features.* FROM features, chosen WHERE CAST(ts AS DATE) = chosen.date", "lookback"
    )
    milliseconds = "date_trunc('millisecond', event_time) AS "
    found = {
        "raw_candles_1m": _sql("SELECT * FROM candles"),
        "parse_kline": _sql(
            RAW_SELECT.format(
                event_time=milliseconds + "event_time",
                rest=", " + milliseconds + "ingestion_timestamp",
            )
        ),
        "nanos_normalised": _sql("SELECT * FROM candles"),
        "calendar_keys": _sql(
            """SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date_key,
                strftime(date, '%Y-%m') AS month_key, CAST(date - 59 AS DATE) AS lookback_start,
                CAST(day(last_day(date)) AS INTEGER) AS days_in_month,
                last_day(date) AS month_end, CAST(NULL AS DATE) AS not_a_date FROM raw"""
        ),
        "slice_day": _sql("SELECT raw.* FROM raw, chosen WHERE raw.date = chosen.date"),
        "slice_month": _sql(
            """SELECT raw.* FROM raw, chosen
               WHERE raw.date BETWEEN date_trunc('month', chosen.date) AND last_day(chosen.date)"""
        ),
        "slice_lookback": _sql(
            """SELECT raw.* FROM raw, chosen
               WHERE raw.date BETWEEN chosen.date - 6 AND chosen.date"""
        ),
        "ohlc_hourly": _sql(
            f"""SELECT symbol, date_trunc('hour', candle_close_time) AS hour_ts, {BAR},
                round(avg(close), 8) AS avg_price FROM candles GROUP BY 1, 2"""
        ),
        "ohlc_daily": _sql(
            f"""SELECT symbol, CAST(candle_close_time AS DATE) AS date, {BAR}
                FROM candles GROUP BY 1, 2"""
        ),
        "ohlc_monthly": _sql(
            f"""SELECT symbol, CAST(date_trunc('month', candle_close_time) AS DATE) AS month, {BAR},
                round(avg(close), 8) AS avg_price FROM candles GROUP BY 1, 2"""
        ),
        "daily_stats": _sql(STATS),
        "daily_stats_sql": _sql(STATS),
        "returns": _sql(_feature("log_return_1", "return_5")),
        "moving_averages": _sql(_feature(*(f"ma_{n}" for n in spans))),
        "volatility": _sql(_feature(*(f"vol_{n}" for n in spans))),
        "rsi_14": _sql(_feature("rsi_14")),
        "ema_native": ema,
        "ema_grouped": ema,
        "calendar_features": _sql(_feature("hour_of_day", "day_of_week")),
        "feature_history": _sql("SELECT * FROM features"),
        "feature_history_split": _sql("SELECT * FROM features"),
        "feature_snapshot": snapshot,
        "raw_inventory": _sql("SELECT DISTINCT exchange, symbol, date FROM raw"),
        "symbols_by_date": _sql(
            "SELECT date, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols "
            "FROM raw GROUP BY date"
        ),
        "complete_dates": _sql("SELECT date FROM complete"),
        "next_gold_date": _sql("SELECT date FROM chosen"),
        "closed_partitions": _sql(
            CLOSED
            + """ AND date >= DATE '2024-01-05'
                  AND (symbol, date) NOT IN (SELECT (symbol, date) FROM raw WHERE high > 300)"""
        ),
        "ingest_stream_to_raw": _sql(
            RAW_SELECT.format(
                event_time=milliseconds + "event_time",
                rest=", CAST(candle_start_time AS DATE) AS date",
            )
        ),
        "rejected_messages": _sql(
            """SELECT reason, count(*) AS n FROM candles, (VALUES ('open candle'), ('other symbol'),
                ('other interval'), ('no kline'), ('not json'), ('other symbol'), ('other interval'),
                ('bad c')) AS r(reason) GROUP BY reason"""
        ),
        "land_redelivered": _sql("SELECT * FROM raw"),
        "partition_index": _sql(
            """SELECT exchange, symbol, date, count(*) AS n_rows, min(candle_start_time) AS first_start,
                max(candle_close_time) AS last_close_time,
                arg_max(close, candle_close_time) AS last_close
            FROM raw GROUP BY ALL"""
        ),
        "feature_snapshot_incremental": snapshot,
        "land_archive_mark": _sql(
            "SELECT DISTINCT exchange, symbol, date FROM raw WHERE date < (SELECT max(date) FROM raw)"
        ),
        "gold_roundtrip": _sql(
            f"""SELECT 'hourly_ohlc' AS table_name, symbol,
                    date_trunc('hour', candle_close_time) AS bucket, {BAR},
                    round(avg(close), 8) AS avg_price
                FROM raw, chosen WHERE raw.date BETWEEN chosen.date - 1 AND chosen.date
                GROUP BY 1, 2, 3
                UNION ALL
                SELECT 'daily_ohlc', symbol, date_trunc('day', candle_close_time), {BAR}, NULL
                FROM raw, chosen WHERE raw.date BETWEEN chosen.date - 1 AND chosen.date
                GROUP BY 1, 2, 3
                UNION ALL
                SELECT 'monthly_ohlc', symbol, date_trunc('month', candle_close_time), {BAR},
                    round(avg(close), 8)
                FROM raw, chosen
                WHERE date_trunc('month', raw.date)
                    IN (date_trunc('month', chosen.date), date_trunc('month', chosen.date - 1))
                GROUP BY 1, 2, 3"""
        ),
        "refresh": snapshot,
        "refresh_stale": snapshot,
        "collect_land_refresh": snapshot,
    }
    found["bars_from_parts"] = found["ohlc_monthly"]
    found["ingest_subscription"] = found["ingest_stream_to_raw"]
    if llm is not None:
        found |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    listed = [
        raw_candles_1m,
        parse_kline,
        nanos_normalised,
        calendar_keys,
        slice_day,
        slice_month,
        slice_lookback,
        ohlc_hourly,
        ohlc_daily,
        ohlc_monthly,
        daily_stats,
        daily_stats_sql,
        returns,
        moving_averages,
        volatility,
        rsi_14,
        ema_native,
        ema_grouped,
        calendar_features,
        feature_history,
        feature_history_split,
        feature_snapshot,
        raw_inventory,
        symbols_by_date,
        complete_dates,
        next_gold_date,
        closed_partitions,
        ingest_stream_to_raw,
        ingest_subscription,
        rejected_messages,
        land_redelivered,
        partition_index,
        feature_snapshot_incremental,
        land_archive_mark,
        gold_roundtrip,
        refresh,
        refresh_stale,
        bars_from_parts,
        collect_land_refresh,
    ]
    found = {query.__name__: query for query in listed}
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the feature snapshot of the newest date."""
    return feature_snapshot(spark, SMALLEST)
