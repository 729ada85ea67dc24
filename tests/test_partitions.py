import datetime as dt

import pytest

from wickflow.operators import partitions as parts

D = dt.date
PAIR = ["BTCUSDT", "ETHUSDT"]


@pytest.fixture
def table(spark):
    def make(*rows):
        return spark.createDataFrame(
            [("binance", s, D.fromisoformat(d)) for s, d in rows],
            "exchange string, symbol string, date date",
        )

    return make


def both(*dates):
    return [(s, d) for d in dates for s in PAIR]


def chosen(df, as_of):
    return parts.next_gold_date(df, PAIR, as_of).collect()


def test_symbols_and_complete_dates(table):
    df = table(*both("2024-01-01"), ("BTCUSDT", "2024-01-02"), ("BTCUSDT", "2024-01-02"),
               ("DOGE", "2024-01-01"))
    found = {r.date: r.symbols for r in parts.symbols_by_date(df).collect()}
    assert found == {D(2024, 1, 1): ["BTCUSDT", "DOGE", "ETHUSDT"], D(2024, 1, 2): ["BTCUSDT"]}
    assert [r.date for r in parts.complete_dates(df, PAIR).collect()] == [D(2024, 1, 1)]


def test_today_is_preferred_over_a_newer_date(table):
    df = table(*both("2024-01-01", "2024-01-02", "2024-01-03"))
    assert chosen(df, "2024-01-02")[0].date == D(2024, 1, 2)


def test_newest_complete_date_otherwise(table):
    df = table(*both("2024-01-01", "2024-01-03"), ("BTCUSDT", "2024-01-04"))
    assert chosen(df, "2024-01-04")[0].date == D(2024, 1, 3)
    assert chosen(df, "2024-02-01")[0].date == D(2024, 1, 3)


def test_a_future_date_counts_as_newest(table):
    df = table(*both("2024-01-01", "2099-01-01"))
    assert chosen(df, "2024-01-02")[0].date == D(2099, 1, 1)


def test_no_eligible_date(table):
    rows = chosen(table(("BTCUSDT", "2024-01-01")), "2024-01-01")
    assert len(rows) == 1 and rows[0].date is None


def test_closed_partitions(table):
    there = table(*both("2024-01-01", "2024-01-02", "2024-01-03"))
    pending = table(("BTCUSDT", "2024-01-01"), ("BTCUSDT", "2024-01-01"))
    closed = table(("ETHUSDT", "2024-01-02"))
    got = parts.closed_partitions(there, pending, closed, "2024-01-03").collect()
    assert sorted((r.symbol, r.date.day) for r in got) == [("BTCUSDT", 2), ("ETHUSDT", 1)]
    assert parts.closed_partitions(there, pending, closed).count() == 4
