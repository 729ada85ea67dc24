import datetime as dt
import shutil

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wickflow.functions.calendar import parse_date, parse_month, utc_timestamp
from wickflow.plans.landing import append_raw
from wickflow.schemas import RAW_COLUMNS, RAW_TIMESTAMPS
from wickflow.sources import raw

from conftest import candle


@pytest.fixture
def dated(frame):
    days = ["2023-11-02", "2023-11-03", "2023-12-31", "2024-01-01", "2024-02-01", "2024-02-28",
            "2024-02-29", "2024-03-01"]
    rows = [candle(s, f"{d}T12:00:00", 1) for d in days for s in ("BTCUSDT", "ETHUSDT")]
    return raw.with_start_date(frame(rows))


def days(df):
    return sorted({r.date.isoformat() for r in df.collect()})


def test_day(dated):
    assert days(raw.raw_slice(dated, date="2024-02-29")) == ["2024-02-29"]
    assert raw.raw_slice(dated, ["BTCUSDT"], date="2024-02-29").count() == 1


def test_month_has_days_after_the_processed_one(dated):
    month = raw.month_of("2024-02-01")
    assert days(raw.raw_slice(dated, month=month)) == ["2024-02-01", "2024-02-28", "2024-02-29"]


def test_lookback_counts_the_date_and_crosses_the_year(dated):
    got = days(raw.raw_slice(dated, date="2024-01-01", lookback_days=60))
    assert got == ["2023-11-03", "2023-12-31", "2024-01-01"]
    assert days(raw.raw_slice(dated, date="2024-01-01", lookback_days=1)) == ["2024-01-01"]


def test_bad_arguments(dated):
    with pytest.raises(ValueError):
        raw.raw_slice(dated)
    with pytest.raises(ValueError):
        raw.raw_slice(dated, date="2024-1-1")
    with pytest.raises(ValueError):
        raw.raw_slice(dated, date="2024-02-30")
    with pytest.raises(ValueError):
        raw.slice_lookback(dated, "2024-01-01", 0)
    with pytest.raises(ValueError):
        parse_month("2024-13")
    assert parse_date("2024-02-29") == dt.date(2024, 2, 29)


def test_empty_slice_is_an_error(dated):
    day = raw.raw_slice(dated, ["BTCUSDT"], date="2024-02-29")
    raw.require_symbols(day, ["BTCUSDT"])
    with pytest.raises(raw.EmptySlice, match="ETHUSDT"):
        raw.require_symbols(day, ["BTCUSDT", "ETHUSDT"])


def test_slices_prune_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    append_raw(frame([candle("BTCUSDT", f"2024-01-0{d}T00:00:00", d) for d in range(1, 6)]), path)
    sliced = raw.raw_slice(raw.raw_table(spark, path), ["BTCUSDT"], date="2024-01-02", lookback_days=2)
    assert sliced.count() == 2
    assert len(sliced.inputFiles()) == 5
    plan = sliced.select("close")._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in partition_filters and "symbol" in partition_filters
    assert "ReadSchema: struct<close:double>" in plan


def plain_file(folder, symbol, date, unit, count=2):
    """A file as the collector's pandas writes it, in exchange/symbol/date folders."""
    start = pd.Timestamp(f"{date}T00:00:00.000000123", tz="UTC") + pd.to_timedelta(range(count), "min")
    rows = pd.DataFrame({c: "x" for c in RAW_COLUMNS}, index=range(count))
    rows = rows.assign(exchange="binance", symbol=symbol, interval="1m", is_closed=True,
                       open=1.0, high=2.0, low=0.5, close=1.5)
    for name in RAW_TIMESTAMPS:
        rows[name] = start
    target = folder / "binance" / symbol / date
    target.mkdir(parents=True, exist_ok=True)
    table = pa.Table.from_pandas(rows, preserve_index=False)
    pq.write_table(table, target / "f.parquet", coerce_timestamps=unit, allow_truncated_timestamps=True)


def test_plain_folders_with_nanoseconds(spark, tmp_path):
    for symbol in ("BTCUSDT", "ETHUSDT"):
        for date in ("2026-01-13", "2026-01-14"):
            plain_file(tmp_path, symbol, date, None)
    rows = raw.landed_files(spark, str(tmp_path), "binance", ["BTCUSDT"], ["2026-01-14", "2026-01-15"],
                            nanoseconds=True)
    got = rows.orderBy("candle_start_time").selectExpr("unix_micros(candle_start_time) AS t", "date").collect()
    first = int(pd.Timestamp("2026-01-14", tz="UTC").value // 1000)
    assert [r.t for r in got] == [first, first + 60_000_000]
    assert {r.date for r in got} == {dt.date(2026, 1, 14)}


def test_plain_folders_with_microseconds(spark, tmp_path):
    plain_file(tmp_path, "BTCUSDT", "2026-01-13", "us")
    plain_file(tmp_path, "ETHUSDT", "2026-01-13", "us", count=3)
    rows = raw.landed_files(spark, str(tmp_path))
    assert rows.count() == 5 and days(rows) == ["2026-01-13"]


def test_inventory_skips_other_files(spark, tmp_path):
    plain_file(tmp_path, "BTCUSDT", "2026-01-13", "us")
    day = tmp_path / "binance" / "BTCUSDT" / "2026-01-13"
    (day / "_SUCCESS").write_text("ok")
    (day.parent / "no-date").mkdir()
    shutil.copy(day / "f.parquet", day.parent / "no-date")
    files = raw.raw_files(spark, str(tmp_path))
    assert files.count() == 2
    found = raw.inventory(files, raw.RAW_FILE_PATTERN).collect()
    assert [(r.exchange, r.symbol, r.date) for r in found] == [("binance", "BTCUSDT", dt.date(2026, 1, 13))]


def test_utc_timestamp(spark):
    text = spark.sql("SELECT '2024-01-01T05:00:00+05:00' AS t")
    row = text.select(utc_timestamp(F.col("t")).alias("t"))
    assert row.selectExpr("unix_seconds(t) AS s").first().s == 1704067200
