"""The gold run: four tables for one date, each replacing only its own slices.

A run writes its slices into folders of its own and then makes them current by one small
file below ``_runs``, which names the slices of all tables. Readers take of each slice the
run that was committed last, so they see all four tables of a run or none, whatever fails
in between. Folders of runs that were no longer current when a run began are removed after
its commit, so a reader may finish with the run it started on.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from wickflow.functions.calendar import parse_date
from wickflow.functions.kline import EXCHANGE, SYMBOLS
from wickflow.operators.features import feature_snapshot
from wickflow.operators.ohlc import merged_bars, ohlc
from wickflow.operators.partitions import next_gold_date
from wickflow.operators.sequence import Limits
from wickflow.plans.daystates import snapshot_from_states, stored_parts
from wickflow.schemas import DAILY_OHLC, FEATURES, HOURLY_OHLC, MONTHLY_OHLC
from wickflow.session import configure, hadoop_path, path_exists, remove_path
from wickflow.sources.index import partition_index
from wickflow.sources.raw import (
    month_of,
    raw_slice,
    raw_table,
    require_symbols,
)

# Fixed value: days the features look back, the processed date included.
LOOKBACK_DAYS = 60

# Gold slices are named by the processed date or month. A bar's own date can
# differ from it for a candle that starts before midnight and closes after.
SLICE_DATE = T.StructField("slice_date", T.DateType())
SLICE_MONTH = T.StructField("slice_month", T.StringType())
TABLES = {
    "hourly_ohlc": (HOURLY_OHLC, SLICE_DATE),
    "daily_ohlc": (DAILY_OHLC, SLICE_DATE),
    "monthly_ohlc": (MONTHLY_OHLC, SLICE_MONTH),
    "features": (FEATURES, SLICE_DATE),
}


RUNS = "_runs"
SLICE = "table_name string, exchange string, symbol string, slice string"
COMMIT = f"{SLICE}, run string, started timestamp, committed timestamp"


class EmptyOutput(RuntimeError):
    """A gold table came out without rows."""


def gold_tables(
    raw: DataFrame,
    date: dt.date | str,
    symbols: Iterable[str],
    lookback_days: int = LOOKBACK_DAYS,
    limits: Limits = Limits(),
    features: DataFrame | None = None,
    parts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The four tables for ``date``, all symbols in one plan each.

    ``features`` is given where they come from stored states, and ``parts`` of the month's
    bars where those are stored. Fails when a symbol has no raw rows in the day, the month or the lookback.
    The month and the lookback both hold the day, so the day decides.
    """
    symbols = list(symbols)
    day = raw_slice(raw, symbols, date=date)
    require_symbols(day, symbols)
    if parts is not None:
        parts = parts.filter(F.col("symbol").isin(symbols))
        of_day = parts.filter(F.col("date") == F.lit(parse_date(date)))
        bars = {g: merged_bars(parts if g == "month" else of_day, g) for g in ("hour", "day", "month")}
    else:
        month = raw_slice(raw, symbols, month=month_of(date))
        bars = {g: ohlc(month if g == "month" else day, g) for g in ("hour", "day", "month")}
    return {
        "hourly_ohlc": bars["hour"],
        "daily_ohlc": bars["day"],
        "monthly_ohlc": bars["month"],
        "features": feature_snapshot(raw, date, lookback_days, symbols, limits) if features is None else features,
    }


def write_slices(table: DataFrame, path: str, slices: list[str], run: str) -> dict[str, int]:
    """Writes ``table`` into the slices it has rows for, as those of a run; rows per symbol.

    Rows are rebalanced by slice: one file each as long as a slice is small, several when
    it is not.
    """
    written = Observation()
    (
        table.withColumn("run", F.lit(run))
        .hint("rebalance", *slices)
        .observe(written, F.count(F.lit(1)).alias("rows"), F.collect_set("symbol").alias("symbols"))
        .write.mode("append")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .partitionBy(*slices, "run")
        .parquet(path)
    )
    return written.get


def committed(spark: SparkSession, gold_path: str) -> DataFrame:
    """What each run committed: table_name, exchange, symbol, slice, run, started, committed."""
    path = f"{gold_path}/{RUNS}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(path)


def current_slices(spark: SparkSession, gold_path: str) -> DataFrame:
    """The commit that each slice of each table shows now."""
    key = ["table_name", "exchange", "symbol", "slice"]
    latest = F.max_by(F.struct("run", "started", "committed"), F.struct("committed", "run")).alias("latest")
    return committed(spark, gold_path).groupBy(*key).agg(latest).select(*key, "latest.*")


def publish(
    tables: dict[str, DataFrame],
    gold_path: str,
    date: dt.date | str,
    exchange: str = EXCHANGE,
    symbols: Iterable[str] = (),
    started: dt.datetime | None = None,
) -> dict[str, int]:
    """Writes the tables under ``gold_path`` and commits them as one; rows per table.

    Fails on a table without rows, or without rows of one of ``symbols``, and then commits
    nothing, so the tables stay as they were. ``started`` is when their input was read.
    """
    spark = next(iter(tables.values())).sparkSession
    started = started or dt.datetime.now(dt.timezone.utc)
    slice_value = {"slice_date": F.lit(parse_date(date)), "slice_month": F.lit(month_of(date))}
    named = {"slice_date": str(parse_date(date)), "slice_month": month_of(date)}
    run = f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"

    def written(name: str) -> dict:
        column = TABLES[name][1].name
        rows = tables[name].withColumns({"exchange": F.lit(exchange), column: slice_value[column]})
        return write_slices(rows, f"{gold_path}/{name}", ["exchange", "symbol", column], run)

    # small jobs, so they run side by side
    with ThreadPoolExecutor(len(tables)) as pool:
        found = dict(zip(tables, pool.map(inheritable_thread_target(spark)(written), tables), strict=True))
    slices = []
    for name, own in found.items():
        missing = set(symbols) - set(own["symbols"])
        if missing or not own["rows"]:
            for other in tables:
                _remove_runs(spark, gold_path, other, f"exchange={exchange}/*/*/run={run}")
            raise EmptyOutput(f"{name} has no rows for {date} {sorted(missing)}")
        slices += [(name, exchange, symbol, named[TABLES[name][1].name]) for symbol in own["symbols"]]
    before = [
        r.asDict()
        for r in committed(spark, gold_path)
        .join(F.broadcast(spark.createDataFrame(slices, SLICE)), ["table_name", "exchange", "symbol", "slice"])
        .select("table_name", "exchange", "symbol", "slice", "run", "committed")
        .toLocalIterator()
    ]
    now = dt.datetime.now(dt.timezone.utc)
    commit = spark.createDataFrame([(*own, run, started, now) for own in slices], COMMIT)
    commit.hint("rebalance").write.parquet(f"{gold_path}/{RUNS}/commit={run}")
    _remove_replaced(spark, gold_path, before)
    return {name: own["rows"] for name, own in found.items()}


def _remove_replaced(spark: SparkSession, gold_path: str, before: list[dict]) -> None:
    """Removes folders of runs that something replaced before this one did."""
    last: dict[tuple, tuple] = {}
    for own in before:
        key = (own["table_name"], own["exchange"], own["symbol"], own["slice"])
        last[key] = max(last.get(key, (own["committed"], own["run"])), (own["committed"], own["run"]))
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for own in before:
        key = (own["table_name"], own["exchange"], own["symbol"], own["slice"])
        if own["run"] != last[key][1]:
            column = TABLES[own["table_name"]][1].name
            values = {"exchange": own["exchange"], "symbol": own["symbol"], column: own["slice"], "run": own["run"]}
            folder = "/".join(f"{c}={escaped(v)}" for c, v in values.items())
            remove_path(spark, f"{gold_path}/{own['table_name']}/{folder}")


def _remove_runs(spark: SparkSession, gold_path: str, name: str, pattern: str) -> None:
    """Removes what a run wrote before it failed; a later run does not see it either way."""
    system, path = hadoop_path(spark, f"{gold_path}/{name}/{pattern}")
    for found in system.globStatus(path) or []:
        system.delete(found.getPath(), True)


def gold_run(
    spark: SparkSession,
    raw_path: str,
    gold_path: str,
    date: dt.date | str,
    symbols: Iterable[str] = SYMBOLS,
    exchange: str = EXCHANGE,
    lookback_days: int = LOOKBACK_DAYS,
    limits: Limits = Limits(),
) -> dict[str, int]:
    """Computes and publishes all gold tables for one date; rows per table.

    Of the lookback only days that changed since the last run are read again.
    """
    configure(spark)
    started = dt.datetime.now(dt.timezone.utc)
    symbols = list(symbols)
    raw = raw_table(spark, raw_path).filter(F.col("exchange") == exchange)
    features = snapshot_from_states(spark, raw_path, date, exchange, lookback_days, symbols, limits)
    parts = stored_parts(spark, raw_path, exchange, *_month(date))
    tables = gold_tables(raw, date, symbols, lookback_days, limits, features, parts)
    return publish(tables, gold_path, date, exchange, symbols, started)


def _month(date: dt.date | str) -> tuple[dt.date, dt.date]:
    """First and last day of the month that holds the date."""
    first = parse_date(date).replace(day=1)
    return first, (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def _slices_of(name: str, dates: Column) -> Column:
    """The table's slices of an array of dates."""
    form = "yyyy-MM" if TABLES[name][1] is SLICE_MONTH else "yyyy-MM-dd"
    return F.transform(
        dates, lambda date: F.struct(F.lit(name).alias("table_name"), F.date_format(date, form).alias("slice"))
    )


def stale_slices(
    spark: SparkSession, raw_path: str, gold_path: str, exchange: str = EXCHANGE, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """table_name, symbol and slice of the published slices whose input changed since.

    A partition of the raw table goes into the bars of its date and of its month, and into
    the features of its date and of the days that look back to it.
    """
    slices = current_slices(spark, gold_path).filter(F.col("exchange") == exchange)
    changed = partition_index(spark, raw_path).filter(F.col("exchange") == exchange).select("symbol", "date", "changed")
    date = F.col("date")
    days = F.sequence(date, F.date_add(date, lookback_days - 1))
    reach = {
        "hourly_ohlc": F.array(date),
        "daily_ohlc": F.array(date),
        "monthly_ohlc": F.array(F.trunc(date, "month")),
        "features": days,
    }
    named = [_slices_of(name, where) for name, where in reach.items()]
    affected = changed.select("symbol", "changed", F.inline(F.concat(*named)))
    key = ["table_name", "symbol", "slice"]
    latest = affected.groupBy(*key).agg(F.max("changed").alias("changed"))
    return slices.join(latest, key).filter("changed > started").select(*key)


def refresh_stale(
    spark: SparkSession,
    raw_path: str,
    gold_path: str,
    exchange: str = EXCHANGE,
    lookback_days: int = LOOKBACK_DAYS,
    limits: Limits = Limits(),
) -> list[tuple[str, str, str]]:
    """Computes the stale slices again, and no others; returns (table, slice, symbol) of each.

    One commit per slice date or month. States and bar parts are brought up to date once
    for all of them.
    """
    configure(spark)
    started = dt.datetime.now(dt.timezone.utc)
    stale = stale_slices(spark, raw_path, gold_path, exchange, lookback_days)
    found = sorted((r.slice, r.table_name, r.symbol) for r in stale.toLocalIterator())
    for name, own in groupby(found, key=lambda r: r[0]):
        wanted: dict[str, list[str]] = {}
        for _, table, symbol in own:
            wanted.setdefault(table, []).append(symbol)
        date = name if "monthly_ohlc" not in wanted else f"{name}-01"
        parts = stored_parts(spark, raw_path, exchange, *_month(date))
        of_day = parts.filter(F.col("date") == F.lit(parse_date(date)))
        tables = {}
        for table, symbols in wanted.items():
            if table == "features":
                tables[table] = snapshot_from_states(spark, raw_path, date, exchange, lookback_days, symbols, limits)
            else:
                grain = {"hourly_ohlc": "hour", "daily_ohlc": "day", "monthly_ohlc": "month"}[table]
                rows = parts if grain == "month" else of_day
                tables[table] = merged_bars(rows.filter(F.col("symbol").isin(symbols)), grain)
        publish(tables, gold_path, date, exchange, started=started)
    return [(table, name, symbol) for name, table, symbol in found]


def refresh(
    spark: SparkSession,
    raw_path: str,
    gold_path: str,
    symbols: Iterable[str] = SYMBOLS,
    exchange: str = EXCHANGE,
    as_of: dt.date | str | None = None,
    date: dt.date | str | None = None,
    lookback_days: int = LOOKBACK_DAYS,
) -> dt.date | None:
    """One refresh step: choose the date and run it, or do nothing.

    The choice reads the raw table's index only. Returns the date, or None when no date
    is complete or there is no table yet. Runs again on the same raw rows change nothing.
    """
    configure(spark)
    symbols = list(symbols)
    if date is None:
        held = partition_index(spark, raw_path).filter(F.col("exchange") == exchange)
        date = next_gold_date(held, symbols, as_of).first().date
        if date is None:
            return None
    date = parse_date(date)
    gold_run(spark, raw_path, gold_path, date, symbols, exchange, lookback_days)
    return date


def gold_table(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    """A published table, as its last runs committed it: its columns, then exchange and slice."""
    schema, slice_column = TABLES[name]
    own = [T.StructField("exchange", T.StringType()), slice_column]
    full = T.StructType([*schema.fields, *own, T.StructField("run", T.StringType())])
    path = f"{gold_path}/{name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, *own]))
    current = current_slices(spark, gold_path).filter(F.col("table_name") == name)
    current = current.select("exchange", "symbol", F.col("slice").cast(slice_column.dataType).alias(slice_column.name), "run")
    rows = spark.read.schema(full).parquet(path)
    rows = rows.join(current, ["exchange", "symbol", slice_column.name, "run"], "left_semi")
    return rows.select(*schema.fieldNames(), *(f.name for f in own))
