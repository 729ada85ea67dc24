"""Readers of the raw candle table and the slices the gold jobs work on.

Two layouts are read. ``raw_table`` is the one this package writes, partitioned
by ``exchange=/symbol=/date=`` and the batch that wrote the rows. ``landed_files`` reads plain
``exchange/symbol/date`` folders, which carry no column names. Both end in the
raw columns plus ``date``, the UTC date of the candle start.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickflow.functions.calendar import parse_date, parse_month
from wickflow.schemas import RAW_CANDLES, RAW_COLUMNS, RAW_TIMESTAMPS
from wickflow.session import configure

# Fixed value: layout of a raw file's path.
RAW_FILE_PATTERN = r"([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})/.*\.parquet$"
HIVE_FILE_PATTERN = (
    r"exchange=([^/]+)/symbol=([^/]+)/date=(\d{4}-\d{2}-\d{2})/.*\.parquet$"
)


# Raw files with timestamps in nanoseconds.
NANO_CANDLES = T.StructType(
    [T.StructField(f.name, T.LongType()) if f.name in RAW_TIMESTAMPS else f for f in RAW_CANDLES]
)


class EmptySlice(RuntimeError):
    """A slice that must hold rows holds none."""


def raw_table(spark: SparkSession, path: str, batches: bool = False) -> DataFrame:
    """The partitioned raw table, with ``batches`` also the batch that wrote each row; the
    schema is stated, so no footer is read for it."""
    own = [T.StructField("date", T.DateType()), T.StructField("batch", T.StringType())]
    schema = T.StructType(RAW_CANDLES.fields + own[: 1 + batches])
    return spark.read.schema(schema).parquet(path).select(*RAW_COLUMNS, *(f.name for f in own[: 1 + batches]))


def landed_files(
    spark: SparkSession,
    base: str,
    exchange: str = "*",
    symbols: Iterable[str] = ("*",),
    dates: Iterable[dt.date | str] = ("*",),
    nanoseconds: bool = False,
) -> DataFrame:
    """Raw rows from plain ``exchange/symbol/date`` folders.

    Symbols and dates become one path glob, so other folders are not listed.
    ``nanoseconds`` reads files whose timestamps were written in nanoseconds,
    which Spark only accepts as integers, in a session of its own.
    """
    glob = "{}/{}/{{{}}}/{{{}}}/*.parquet".format(
        base.rstrip("/"), exchange, ",".join(symbols), ",".join(str(d) for d in dates)
    )
    if nanoseconds:
        rows = nanos_to_micros(nanos_session(spark).read.schema(NANO_CANDLES).parquet(glob))
    else:
        rows = spark.read.schema(RAW_CANDLES).parquet(glob)
    date = F.regexp_extract(F.col("_metadata.file_path"), RAW_FILE_PATTERN, 3)
    return rows.withColumn("date", F.to_date(date)).select(*RAW_COLUMNS, "date")


def nanos_session(spark: SparkSession) -> SparkSession:
    """A session that reads nanosecond timestamps as integers; ``spark`` stays as it is."""
    session = configure(spark.newSession())
    session.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return session


def nanos_to_micros(rows: DataFrame) -> DataFrame:
    """Integer nanosecond columns as timestamps; the last three digits are cut off."""
    longs = [f.name for f in rows.schema if f.name in RAW_TIMESTAMPS and f.dataType == T.LongType()]
    return rows.withColumns(
        {name: F.timestamp_micros(F.expr(f"{name} div 1000")) for name in longs}
    )


def with_start_date(candles: DataFrame) -> DataFrame:
    """Adds the raw table's partition date."""
    return candles.withColumn("date", F.to_date("candle_start_time"))


def slice_day(raw: DataFrame, date: dt.date | str, symbols: Iterable[str] | None = None) -> DataFrame:
    """One day."""
    return _of_symbols(raw, symbols).filter(F.col("date") == F.lit(parse_date(date)))


def slice_month(raw: DataFrame, month: str, symbols: Iterable[str] | None = None) -> DataFrame:
    """All days of a ``YYYY-MM`` month, those after the processed date included."""
    first = F.lit(parse_month(month))
    return _of_symbols(raw, symbols).filter(F.col("date").between(first, F.last_day(first)))


def slice_lookback(
    raw: DataFrame, date: dt.date | str, days: int, symbols: Iterable[str] | None = None
) -> DataFrame:
    """The ``days`` days that end on ``date``, that day included."""
    if days < 1:
        raise ValueError("a lookback has at least one day")
    last = parse_date(date)
    first = last - dt.timedelta(days=days - 1)
    return _of_symbols(raw, symbols).filter(F.col("date").between(F.lit(first), F.lit(last)))


def _of_symbols(raw: DataFrame, symbols: Iterable[str] | None) -> DataFrame:
    return raw if symbols is None else raw.filter(F.col("symbol").isin(list(symbols)))


def raw_slice(
    raw: DataFrame,
    symbols: Iterable[str] | None = None,
    date: dt.date | str | None = None,
    month: str | None = None,
    lookback_days: int | None = None,
    allow_empty: bool = True,
) -> DataFrame:
    """A day, a lookback or a month, by the arguments given.

    Unless ``allow_empty``, a slice without rows fails, and so does one without rows of a
    symbol that was asked for; only the partition columns are read to know.
    """
    if date and lookback_days:
        found = slice_lookback(raw, date, lookback_days, symbols)
    elif date:
        found = slice_day(raw, date, symbols)
    elif month:
        found = slice_month(raw, month, symbols)
    else:
        raise ValueError("a slice needs a date, a date with lookback_days, or a month")
    if not allow_empty:
        if symbols is not None:
            require_symbols(found, symbols)
        elif found.isEmpty():
            raise EmptySlice("no raw rows in the slice")
    return found


def require_symbols(sliced: DataFrame, symbols: Iterable[str]) -> None:
    """Fails when a symbol has no rows in the slice.

    Reads the partition column only; the answer has one row per wanted symbol.
    """
    wanted = set(symbols)
    found = {r.symbol for r in sliced.select("symbol").distinct().collect()}
    if wanted - found:
        raise EmptySlice(f"no raw rows for {sorted(wanted - found)}")


def month_of(date: dt.date | str) -> str:
    """``YYYY-MM`` of a date."""
    return parse_date(date).strftime("%Y-%m")


def raw_files(spark: SparkSession, base: str) -> DataFrame:
    """Every Parquet file below ``base``, from the listing: ``path``, and the same as ``file``,
    in the form of ``_metadata.file_path``, ``length`` and time of modification."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select(
            "path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")
        )
    )


def inventory(files: DataFrame, pattern: str = HIVE_FILE_PATTERN) -> DataFrame:
    """``(exchange, symbol, date, path)`` of the files whose path fits the layout."""
    path = F.col("path")
    return files.filter(path.rlike(pattern)).select(
        F.regexp_extract(path, pattern, 1).alias("exchange"),
        F.regexp_extract(path, pattern, 2).alias("symbol"),
        F.to_date(F.regexp_extract(path, pattern, 3)).alias("date"),
        path,
    )
