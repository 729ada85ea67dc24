import random

from pyspark.sql import functions as F

from wickflow.operators.ohlc import daily_stats, ohlc
from wickflow.schemas import DAILY_OHLC, HOURLY_OHLC, MONTHLY_OHLC

from conftest import candle, series


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_schemas(frame):
    rows = frame(series("A", [1, 2]))
    for grain, schema in (("hour", HOURLY_OHLC), ("day", DAILY_OHLC), ("month", MONTHLY_OHLC)):
        got = ohlc(rows, grain).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]


def test_bar_values(frame):
    rows = frame(
        [
            candle("A", "2024-01-01T10:00:00", 2, open=1, high=5, low=0.5),
            candle("A", "2024-01-01T10:30:00", 3, open=2, high=4, low=0.25),
            candle("A", "2024-01-01T11:00:00", 9, open=8, high=9, low=7),
        ]
    )
    hours = ohlc(rows, "hour").orderBy("hour_ts").drop("symbol", "hour_ts").collect()
    assert [tuple(r) for r in hours] == [(1.0, 5.0, 0.25, 2.5, 3.0), (8.0, 9.0, 7.0, 9.0, 9.0)]
    assert tuple(ohlc(rows, "day").drop("symbol", "date").first()) == (1.0, 9.0, 0.25, 9.0)


def test_order_and_partitioning_do_not_matter(frame):
    rng = random.Random(1)
    closes = [rng.randrange(400) / 4 for _ in range(200)]  # sums are exact
    rows = series("A", closes) + series("B", range(1, 90))
    expected = rows_of(ohlc(frame(rows), "hour"))
    random.Random(2).shuffle(rows)
    assert rows_of(ohlc(frame(rows).repartition(7), "hour")) == expected


def test_day_is_the_aggregate_of_its_hours(frame):
    rng = random.Random(3)
    closes = [rng.uniform(1, 9) for _ in range(3000)]
    rows = frame(series("A", closes))
    hours = ohlc(rows, "hour")
    again = hours.groupBy("symbol", F.to_date("hour_ts").alias("date")).agg(
        F.min_by("open", "hour_ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "hour_ts").alias("close"),
    )
    assert rows_of(again) == rows_of(ohlc(rows, "day"))


def test_buckets_follow_the_close_time_and_stats_the_start(frame):
    rows = frame([candle("A", "2024-01-31T23:59:30", 1)])
    assert ohlc(rows, "day").first().date.isoformat() == "2024-02-01"
    assert ohlc(rows, "month").first().month.isoformat() == "2024-02-01"
    assert daily_stats(rows).first().date.isoformat() == "2024-01-31"


def test_copies_enter_the_average(frame):
    rows = series("A", [1, 4]) + series("A", [1])
    assert ohlc(frame(rows), "hour").first().avg_price == 2.0


def test_one_shuffle_no_sort(frame):
    plan = ohlc(frame(series("A", [1])), "hour")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan
