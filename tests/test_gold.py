import datetime as dt
import os

import pytest

from wickflow.plans import gold
from wickflow.plans.landing import append_raw
from wickflow.schemas import FEATURES
from wickflow.sources.raw import EmptySlice

from conftest import candle, series

PAIR = ["BTCUSDT", "ETHUSDT"]


@pytest.fixture
def paths(frame, tmp_path):
    raw = str(tmp_path / "raw")
    for day in ("2024-01-30", "2024-01-31", "2024-02-01"):
        rows = []
        for symbol, base in (("BTCUSDT", 100), ("ETHUSDT", 10)):
            rows += series(symbol, [base + i % 7 for i in range(90)], start=f"{day}T10:00:00")
        append_raw(frame(rows), raw)
    return raw, str(tmp_path / "gold")


def listing(path):
    return sorted(
        os.path.relpath(os.path.join(folder, f), path)
        for folder, _, files in os.walk(path)
        for f in files
        if not f.endswith(".crc")
    )


def content(spark, out):
    return {
        name: sorted(map(str, gold.gold_table(spark, out, name).collect())) for name in gold.TABLES
    }


def test_run_writes_four_tables_in_their_slices(spark, paths):
    raw, out = paths
    counts = gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    assert counts == {"hourly_ohlc": 4, "daily_ohlc": 2, "monthly_ohlc": 2, "features": 180}
    files = [f for f in listing(out) if not f.startswith("_runs")]
    assert not [f for f in files if "_SUCCESS" in f]
    assert all(os.path.basename(os.path.dirname(f)).startswith("run=") for f in files)
    folders = {os.path.dirname(os.path.dirname(f)) for f in files}
    assert "monthly_ohlc/exchange=binance/symbol=BTCUSDT/slice_month=2024-01" in folders
    assert "features/exchange=binance/symbol=ETHUSDT/slice_date=2024-01-31" in folders
    assert len(files) == len(folders) == 8
    assert gold.gold_table(spark, out, "features").columns[:20] == FEATURES.fieldNames()


def test_rerun_changes_nothing_and_other_slices_stay(spark, paths):
    raw, out = paths
    gold.gold_run(spark, raw, out, "2024-01-30", PAIR)
    gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    before = content(spark, out)
    gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    assert content(spark, out) == before
    dates = gold.gold_table(spark, out, "daily_ohlc").select("slice_date").distinct().collect()
    assert sorted(r.slice_date.day for r in dates) == [30, 31]


def test_month_and_late_rows(spark, frame, paths):
    raw, out = paths
    gold.gold_run(spark, raw, out, "2024-01-30", PAIR)
    append_raw(frame([candle("BTCUSDT", "2024-01-30T23:00:00", 999)]), raw)
    gold.gold_run(spark, raw, out, "2024-01-30", PAIR)
    month = gold.gold_table(spark, out, "monthly_ohlc").filter("symbol = 'BTCUSDT'").first()
    assert month.high == 999 and month.close == 100 + 89 % 7
    day = gold.gold_table(spark, out, "daily_ohlc").filter("symbol = 'BTCUSDT'").first()
    assert day.close == 999


def test_missing_symbol_stops_the_run(spark, paths):
    raw, out = paths
    with pytest.raises(EmptySlice):
        gold.gold_run(spark, raw, out, "2024-01-31", [*PAIR, "DOGEUSDT"])
    assert not os.path.exists(out)


def test_one_empty_table_leaves_all_as_they_were(spark, frame, paths):
    raw, out = paths
    gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    before = content(spark, out)
    append_raw(frame([candle("BTCUSDT", "2024-01-31T23:00:00", 999)]), raw)
    tables = gold.gold_tables(gold.raw_table(spark, raw), "2024-01-31", PAIR)
    for gone in ("true", "symbol = 'ETHUSDT'"):
        lacking = tables | {"features": tables["features"].filter(f"NOT ({gone})")}
        with pytest.raises(gold.EmptyOutput, match="features"):
            gold.publish(lacking, out, "2024-01-31", symbols=PAIR)
        assert content(spark, out) == before


def test_empty_output_replaces_nothing(spark, paths):
    raw, out = paths
    gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    before = content(spark, out)
    empty = gold.gold_table(spark, out, "daily_ohlc").drop("exchange", "slice_date").limit(0)
    with pytest.raises(gold.EmptyOutput):
        gold.publish({"daily_ohlc": empty}, out, "2024-01-31")
    assert content(spark, out) == before


def test_refresh_chooses_its_date(spark, frame, paths):
    raw, out = paths
    append_raw(frame([candle("BTCUSDT", "2024-02-02T00:00:00", 1)]), raw)
    assert gold.refresh(spark, raw, out, PAIR, as_of="2024-02-02") == dt.date(2024, 2, 1)
    assert gold.refresh(spark, raw, out, PAIR, as_of="2024-01-31") == dt.date(2024, 1, 31)
    assert gold.refresh(spark, raw, out, PAIR, date="2024-01-30") == dt.date(2024, 1, 30)
    assert gold.refresh(spark, raw, out, [*PAIR, "DOGEUSDT"]) is None
    got = gold.gold_table(spark, out, "features").select("slice_date").distinct().count()
    assert got == 3


def test_readers_see_all_tables_of_a_run_or_none(spark, frame, paths, monkeypatch):
    raw, out = paths
    gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    before = content(spark, out)
    append_raw(frame([candle("BTCUSDT", "2024-01-31T23:00:00", 999)]), raw)
    write = gold.write_slices

    def third_fails(table, path, *rest):
        if path.endswith("monthly_ohlc"):
            raise OSError("disk full")
        return write(table, path, *rest)

    monkeypatch.setattr(gold, "write_slices", third_fails)
    with pytest.raises(OSError):
        gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    assert content(spark, out) == before
    monkeypatch.setattr(gold, "write_slices", write)
    gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    after = content(spark, out)
    assert all(after[name] != before[name] for name in gold.TABLES)


def test_replaced_runs_go_one_run_later(spark, paths):
    raw, out = paths
    for _ in range(4):
        gold.gold_run(spark, raw, out, "2024-01-31", PAIR)
    folder = f"{out}/daily_ohlc/exchange=binance/symbol=BTCUSDT/slice_date=2024-01-31"
    assert len(os.listdir(folder)) == 2
    assert gold.gold_table(spark, out, "daily_ohlc").count() == 2


def test_a_late_candle_refreshes_what_it_reaches(spark, frame, paths):
    raw, out = paths
    dates = ("2024-01-30", "2024-01-31", "2024-02-01")
    for date in dates:
        gold.gold_run(spark, raw, out, date, PAIR, lookback_days=2)
    assert gold.refresh_stale(spark, raw, out, lookback_days=2) == []
    before = {r.run for r in gold.current_slices(spark, out).collect()}
    append_raw(frame([candle("BTCUSDT", "2024-01-30T09:00:00", 999)]), raw)
    assert sorted(gold.refresh_stale(spark, raw, out, lookback_days=2)) == [
        ("daily_ohlc", "2024-01-30", "BTCUSDT"),
        ("features", "2024-01-30", "BTCUSDT"),
        ("features", "2024-01-31", "BTCUSDT"),
        ("hourly_ohlc", "2024-01-30", "BTCUSDT"),
        ("monthly_ohlc", "2024-01", "BTCUSDT"),
    ]
    assert gold.refresh_stale(spark, raw, out, lookback_days=2) == []
    kept = gold.current_slices(spark, out).collect()
    assert len(kept) == 22 and sum(r.run not in before for r in kept) == 5
    whole = out + "-again"
    for date in dates:
        gold.gold_run(spark, raw, whole, date, PAIR, lookback_days=2)
    assert content(spark, out) == content(spark, whole)
