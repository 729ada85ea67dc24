"""Snapshots from stored day states against those of the whole lookback."""

import datetime as dt
import os
import shutil

import pytest

from wickflow.operators.features import feature_snapshot
from wickflow.operators.sequence import Limits
from wickflow.plans import daystates
from wickflow.plans.landing import append_raw
from wickflow.sources.raw import raw_table

from conftest import candle, series
from test_features import assert_close, collected, holed, walk

DAY = dt.date(2024, 1, 4)


def compared(spark, raw, days=3, limits=Limits(), symbols=None):
    got = collected(daystates.snapshot_from_states(spark, raw, DAY, "binance", days, symbols, limits))
    expected = collected(feature_snapshot(raw_table(spark, raw), DAY, days, symbols))
    assert list(got.symbol) == list(expected.symbol) and list(got.ts) == list(expected.ts) and len(got)
    assert_close(got, expected.drop(columns=["symbol", "ts"]))
    return got


@pytest.fixture
def raw(frame, tmp_path):
    rows = (
        series("LONG", walk(19, 5000), start="2024-01-01T00:00:00")
        + series("HALF", walk(26, 3000), start="2024-01-01T23:30:30")  # candles across midnight
        + series("SHORT", walk(20, 60), start="2024-01-03T23:30:00")
        + series("NEW", walk(21, 40), start="2024-01-04T08:00:00")
        + series("GONE", walk(22, 40), start="2024-01-02T08:00:00")
        + series("GAP", walk(27, 90), start="2024-01-02T08:00:00", step_minutes=97)
    )
    append_raw(frame(rows), str(tmp_path / "raw"))
    return str(tmp_path / "raw")


def test_states_give_the_snapshot_and_are_kept(spark, raw):
    dates = [DAY - dt.timedelta(days=d) for d in (2, 1, 0)]
    assert daystates.update_states(spark, raw, "binance", dates[0], DAY) == dates
    compared(spark, raw)
    assert daystates.update_states(spark, raw, "binance", dates[0], DAY) == []
    compared(spark, raw, symbols=["LONG", "SHORT"])
    compared(spark, raw, limits=Limits(500, 20_000, 500))


def test_a_late_candle_makes_its_own_date_stale(spark, frame, raw):
    compared(spark, raw)
    late = [candle("GAP", "2024-01-03T12:00:00", 400.0), candle("GONE", "2024-01-03T12:00:00", 5)]
    append_raw(frame(late), raw)
    changed = daystates.update_states(spark, raw, "binance", DAY - dt.timedelta(days=2), DAY)
    assert changed == [dt.date(2024, 1, 3)]
    compared(spark, raw)


def test_missing_closes(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    rows = holed(frame(series("A", walk(28, 4500), start="2024-01-01T06:00:00") + series("B", walk(29, 30), start="2024-01-04T00:00:00")), 4)
    append_raw(rows, path)
    compared(spark, path)


def test_candles_that_reach_across_others_are_read_again(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    rows = series("A", walk(30, 4500), start="2024-01-01T06:00:00")
    rows += [candle("A", "2024-01-03T23:50:00", 77.0, seconds=1_200)]
    append_raw(frame(rows), path)
    compared(spark, path)


def test_only_the_date_is_read_once_states_are_there(spark, raw):
    expected = compared(spark, raw, symbols=["LONG", "HALF"])
    for symbol in ("LONG", "HALF"):
        own = f"{raw}/exchange=binance/symbol={symbol}"
        for folder in os.listdir(own):  # HALF has a candle that starts the day before
            if folder != "date=2024-01-04" and not (symbol == "HALF" and folder == "date=2024-01-03"):
                shutil.rmtree(f"{own}/{folder}")
    found = daystates.snapshot_from_states(spark, raw, DAY, "binance", 3, ["LONG", "HALF"])
    assert_close(collected(found), expected.drop(columns=["symbol", "ts"]))


def test_bars_come_from_parts(spark, frame, raw):
    from wickflow.operators.ohlc import merged_bars, ohlc

    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 31)

    def shown(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    for _ in range(2):
        parts = daystates.stored_parts(spark, raw, "binance", first, last)
        table = raw_table(spark, raw)
        for grain in ("hour", "day", "month"):
            assert shown(merged_bars(parts, grain)) == shown(ohlc(table, grain))
        day = merged_bars(parts.filter("date = '2024-01-03'"), "day")
        assert shown(day) == shown(ohlc(table.filter("date = '2024-01-03'"), "day"))  # HALF closes on the fourth too
        append_raw(frame([candle("GONE", "2024-01-03T23:59:30", 9), candle("HALF", "2024-01-02T03:00:15", 999)]), raw)
    months = shown(merged_bars(daystates.stored_parts(spark, raw, "binance", first, last), "month"))
    for folder in os.listdir(raw):
        if not folder.startswith("_"):  # the bars need no candles any more
            shutil.rmtree(f"{raw}/{folder}")
    assert shown(merged_bars(daystates.stored_parts(spark, raw, "binance", first, last), "month")) == months
