"""Stored day states and bar parts: what each day's candles add to the gold tables.

A raw partition's candles are summed up once: for features (see
``wickflow.operators.states``), those that close on the next date apart from the others,
and for bars, by hour. The snapshot of a date then composes the small rows of its lookback
and reads the candles of that date alone; bars of days and months read no candles at all.
What is stored carries the time at which the index last saw its partition change, so a
late candle makes that of its own date stale and nothing else.

It lies beside the table's rows, in folders that its listings skip.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickflow.functions.calendar import parse_date
from wickflow.operators.features import FRAME_ROWS, INPUTS, feature_snapshot, features_after
from wickflow.operators.ohlc import bar_parts
from wickflow.operators.sequence import ORDER, Limits
from wickflow.operators.states import folded, known_close, nothing, summaries
from wickflow.schemas import FEATURE_SPANS
from wickflow.session import path_exists
from wickflow.sources.index import partition_index
from wickflow.sources.raw import raw_table

FOLDER, PARTS_FOLDER = "_states", "_bar_parts"

PARTS = (
    "symbol string, hour_ts timestamp, open_at timestamp, open double, high double, low double, "
    "close_sum double, close_count bigint, close_at timestamp, close double, as_of timestamp, "
    "exchange string, date date"
)


def _held(spark: SparkSession, raw_path: str) -> DataFrame:
    """All stored states; none where there are none yet."""
    kind = spark.range(0).select(nothing(FEATURE_SPANS)).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("closes_on", T.DateType()),
            T.StructField("state", kind),
            T.StructField("first_at", T.TimestampType()),
            T.StructField("last_at", T.TimestampType()),
            T.StructField("as_of", T.TimestampType()),
            T.StructField("exchange", T.StringType()),
            T.StructField("date", T.DateType()),
        ]
    )
    path = f"{raw_path}/{FOLDER}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _window(rows: DataFrame, exchange: str, first: dt.date, last: dt.date) -> DataFrame:
    return rows.filter((F.col("exchange") == exchange) & F.col("date").between(F.lit(first), F.lit(last)))


def _updated(
    spark: SparkSession,
    raw_path: str,
    folder: str,
    held: DataFrame,
    summed_up: Callable[[DataFrame], DataFrame],
    exchange: str,
    first: dt.date,
    last: dt.date,
) -> list[dt.date]:
    """Sums up the partitions of the dates that changed since, and returns those dates.

    ``summed_up`` makes the rows to store, with symbol and date, of a slice of the table.
    """
    key = ["symbol", "date"]
    now = _window(partition_index(spark, raw_path), exchange, first, last).select(*key, "changed")
    known = _window(held, exchange, first, last).groupBy(*key).agg(F.min("as_of").alias("as_of"))
    stale = now.join(known, key, "left").filter("as_of IS NULL OR as_of < changed")
    dates = sorted(r.date for r in stale.select("date").distinct().collect())  # a lookback at most
    if not dates:
        return []
    rows = raw_table(spark, raw_path).filter((F.col("exchange") == exchange) & F.col("date").isin(dates))
    (
        summed_up(rows)
        .join(now.withColumnRenamed("changed", "as_of"), key)
        .withColumn("exchange", F.lit(exchange))
        .hint("rebalance", "exchange", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("exchange", "date")
        .parquet(f"{raw_path}/{folder}")
    )
    return dates


def _present(
    spark: SparkSession, raw_path: str, held: DataFrame, exchange: str, first: dt.date, last: dt.date
) -> DataFrame:
    """What is stored of partitions that still have rows."""
    index = _window(partition_index(spark, raw_path), exchange, first, last).select("symbol", "date")
    return _window(held, exchange, first, last).join(index, ["symbol", "date"], "left_semi")


def update_states(spark: SparkSession, raw_path: str, exchange: str, first: dt.date, last: dt.date) -> list[dt.date]:
    """Brings the states of the dates up to date, and returns those that were stale."""

    def runs(rows: DataFrame) -> DataFrame:
        rows = rows.select(*INPUTS, "date", F.to_date("candle_close_time").alias("closes_on"))
        rows = rows.withColumn("close", known_close())
        return summaries(rows, ["symbol", "date", "closes_on"], ORDER, FEATURE_SPANS, FRAME_ROWS)

    return _updated(spark, raw_path, FOLDER, _held(spark, raw_path), runs, exchange, first, last)


def stored_parts(spark: SparkSession, raw_path: str, exchange: str, first: dt.date, last: dt.date) -> DataFrame:
    """Bar parts of the dates (symbol, date, hour and what ``merged_bars`` needs), brought up
    to date first."""

    def held() -> DataFrame:
        path = f"{raw_path}/{PARTS_FOLDER}"
        if not path_exists(spark, path):
            return spark.createDataFrame([], PARTS)
        return spark.read.schema(PARTS).parquet(path)

    def parts(rows: DataFrame) -> DataFrame:
        return bar_parts(rows, ("symbol", "date"))

    _updated(spark, raw_path, PARTS_FOLDER, held(), parts, exchange, first, last)
    return _present(spark, raw_path, held(), exchange, first, last)


def snapshot_from_states(
    spark: SparkSession,
    raw_path: str,
    date: dt.date | str,
    exchange: str,
    lookback_days: int = 60,
    symbols: Iterable[str] | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """What ``feature_snapshot`` gives, from stored states and the candles of ``date``.

    States compose in the order of time, so candles of a symbol must not reach across those
    of another partition, as candles of one length never do. Where they do, and where the
    date's own candles exceed ``limits``, the whole lookback is read instead.
    """
    last = parse_date(date)
    first = last - dt.timedelta(days=lookback_days - 1)
    update_states(spark, raw_path, exchange, first, last)
    held = _present(spark, raw_path, _held(spark, raw_path), exchange, first, last)
    raw = raw_table(spark, raw_path).filter(F.col("exchange") == exchange)
    if symbols is not None:
        symbols = list(symbols)
        held, raw = (df.filter(F.col("symbol").isin(symbols)) for df in (held, raw))

    today = F.col("closes_on") == F.lit(last)
    before = F.lag("last_at").over(Window.partitionBy("symbol").orderBy("closes_on", "date"))
    checked = held.withColumn("across", F.col("first_at") <= before).filter(F.col("closes_on") <= F.lit(last))
    sizes = checked.groupBy("symbol").agg(
        F.sum(F.when(today, F.col("state.n"))).alias("n"),
        F.max(F.coalesce("across", F.lit(False))).alias("across"),
        F.collect_set(F.when(today, F.col("date"))).alias("dates"),
    )
    found = sizes.agg(F.max("n").alias("n"), F.max("across").alias("across"), F.flatten(F.collect_set("dates")).alias("dates")).first()
    if found.across or (found.n or 0) > limits.symbol_rows:
        return feature_snapshot(raw, last, lookback_days, None, limits)
    runs = F.array_sort(F.collect_list(F.struct("closes_on", "date", "state")), _in_time)
    earlier = held.filter(F.col("closes_on") < F.lit(last)).groupBy("symbol").agg(runs.alias("runs"))
    earlier = earlier.select("symbol", folded(F.col("runs"), FEATURE_SPANS, FRAME_ROWS).alias("state"))
    rows = raw.filter(F.col("date").isin(sorted(set(found.dates)))).select(*INPUTS)
    rows = rows.filter(F.to_date("candle_close_time") == F.lit(last)).withColumn("close", known_close())
    return features_after(rows, earlier, found.n or 0)


def _in_time(a, b):
    before = (a["closes_on"] < b["closes_on"]) | ((a["closes_on"] == b["closes_on"]) & (a["date"] < b["date"]))
    return F.when(before, F.lit(-1)).otherwise(F.lit(1))
