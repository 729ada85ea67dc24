import math
import random

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import Window

from wickflow.operators import features as ft
from wickflow.operators import states
from wickflow.operators.sequence import ORDER, Limits
from wickflow.schemas import FEATURES, FEATURE_SPANS

from conftest import series

SPLIT = Limits(symbol_rows=500, partition_rows=1_500, chunk_rows=500)


def walk(seed, n, start=100.0):
    rng = random.Random(seed)
    closes = [start]
    for _ in range(n - 1):
        closes.append(closes[-1] * math.exp(rng.gauss(0, 0.01)))
    return closes


def collected(df, time="ts"):
    return df.toPandas().sort_values(["symbol", time]).reset_index(drop=True)


def brute_force(closes):
    """The features from their definitions, row by row."""
    close = pd.Series(closes, dtype=float)
    change = close.diff()
    lr = np.log(close / close.shift(1))
    gain, loss = change.clip(lower=0).fillna(0.0), (-change).clip(lower=0).fillna(0.0)
    out = pd.DataFrame({"log_return_1": lr, "return_5": (close - close.shift(5)) / close.shift(5)})
    for n in FEATURE_SPANS:
        out[f"ma_{n}"] = [close[max(0, i - n):i].mean() if i else np.nan for i in range(len(close))]
        out[f"vol_{n}"] = [lr[max(0, i - n):i].std(ddof=1) for i in range(len(close))]
        out[f"ema_{n}"] = close.ewm(span=n, adjust=False).mean()
    rsi = []
    for i in range(len(close)):
        g, l = gain[max(0, i - 14):i], loss[max(0, i - 14):i]
        rsi.append(np.nan if not len(g) else 100.0 if l.mean() == 0 else
                   100 - 100 / (1 + g.mean() / l.mean()))
    out["rsi_14"] = rsi
    return out


def assert_close(got, expected):
    for name in expected.columns:
        np.testing.assert_allclose(got[name].astype(float), expected[name].astype(float),
                                   rtol=1e-9, atol=1e-12, err_msg=name)


def test_hand_made_case(frame):
    got = collected(ft.features(frame(series("A", [10, 11, 11, 9, 9.5, 12]))))
    nan = float("nan")
    np.testing.assert_allclose(got.ma_5, [nan, 10.0, 10.5, 10.6667, 10.25, 10.1], atol=5e-5)
    np.testing.assert_allclose(got.vol_5, [nan, nan, nan, 0.0674, 0.1511, 0.1312], atol=5e-5)
    np.testing.assert_allclose(got.rsi_14, [nan, 100, 100, 100, 33.3333, 42.8571], atol=5e-5)


def test_schema_and_calendar(frame):
    df = ft.features(frame(series("A", [1, 2], start="2024-01-07T23:58:00")))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in FEATURES]
    assert [(r.hour_of_day, r.day_of_week) for r in df.collect()] == [(23, 1), (23, 1)]


def test_against_brute_force_with_gaps(frame):
    closes = walk(1, 180)
    rows = series("A", closes, step_minutes=37) + series("B", walk(2, 3))
    got = collected(ft.features(frame(rows)))
    assert_close(got[got.symbol == "A"].reset_index(drop=True), brute_force(closes))
    assert_close(got[got.symbol == "B"].reset_index(drop=True), brute_force(walk(2, 3)))


def test_zero_divisor_gives_null(frame):
    got = collected(ft.features(frame(series("A", [0, 5, 5, 5, 5, 5, 6]))))
    assert pd.isna(got.log_return_1[1]) and pd.isna(got.return_5[5]) and got.return_5[6] == 0.2


def test_flat_prices(frame):
    got = collected(ft.features(frame(series("A", [7.1] * 70))))
    assert (got.vol_60[2:].dropna() == 0).all()
    assert (got.rsi_14[1:] == 100).all()


def pandas_ema(rows, spans):
    table = collected(rows.select("symbol", "candle_close_time", "close"), "candle_close_time")
    close = table.groupby("symbol").close
    return pd.DataFrame({
        f"ema_{s}": close.transform(lambda c, s=s: c.ewm(span=s, adjust=False).mean()) for s in spans})


@pytest.mark.parametrize("spans", [(1, 2, 3), (5, 15, 30, 60), (200, 1000)])
def test_ema_equals_pandas(frame, spans):
    rows = frame(series("A", walk(4, 700)) + series("B", walk(5, 40, 1e-6)) + series("C", [3]))
    native = collected(ft.ema(rows, spans), "candle_close_time")
    grouped = pandas_ema(rows, spans)
    assert_close(native, grouped[[f"ema_{s}" for s in spans]])


def test_ema_of_closes_that_are_not_positive(frame):
    rows = frame(series("A", [0.0, -3.5, 1e9] + walk(6, 300)))
    native = collected(ft.ema(rows), "candle_close_time")
    grouped = pandas_ema(rows, FEATURE_SPANS)
    assert_close(native, grouped[[f"ema_{s}" for s in FEATURE_SPANS]])


def test_order_and_partitioning_do_not_matter(frame):
    rows = series("A", walk(7, 150)) + series("B", walk(8, 70))
    expected = collected(ft.features(frame(rows)))
    random.Random(9).shuffle(rows)
    pd.testing.assert_frame_equal(collected(ft.features(frame(rows).repartition(5))), expected)


def test_split_sequence_gives_the_same_features(frame):
    """One symbol far above the limit, one just above, small ones, a single row."""
    rows = frame(
        series("HOT", walk(10, 4000)) + series("MID", walk(11, 600))
        + series("LOW", walk(12, 30)) + series("ONE", [5.0])
    )
    whole, split = collected(ft.features(rows)), collected(ft.features(rows, SPLIT))
    assert len(split) == len(whole) == 4631
    assert_close(split, whole.drop(columns=["symbol", "ts"]))


def test_split_sequence_holds_every_copy_of_a_candle(frame):
    """A third of all rows are copies of one candle."""
    rows = series("A", walk(13, 1400)) + series("A", [50.0], start="2024-01-01T10:00:00") * 700
    whole = ft.features(frame(rows)).toPandas().sort_values(["ts", "close", "ema_60", "ma_60"])
    split = ft.features(frame(rows), SPLIT).toPandas().sort_values(["ts", "close", "ema_60", "ma_60"])
    assert len(split) == 2100
    assert_close(split.reset_index(drop=True),
                 whole.reset_index(drop=True).drop(columns=["symbol", "ts"]))


def test_split_emas_alone(frame):
    rows = frame(series("A", walk(14, 1300)) + series("B", walk(15, 200)))
    whole = collected(ft.ema(rows, (2, 60, 400)), "candle_close_time")
    split = collected(ft.ema(rows, (2, 60, 400), SPLIT), "candle_close_time")
    assert_close(split, whole[["ema_2", "ema_60", "ema_400"]])
    assert_close(split[["ema_60"]], pandas_ema(rows, (60,))[["ema_60"]])


def holed(rows, seed, head=3):
    """The rows with closes missing, as NULL or NaN: the first ones, single ones and runs."""
    from pyspark.sql import functions as F

    nth = (F.unix_timestamp("candle_close_time") / 60).cast("long") % 1_000_000
    first = F.min(nth).over(Window.partitionBy("symbol"))
    gone = (nth - first < head) | (F.pmod(F.hash(nth, F.lit(seed)), F.lit(9)) == 0) | (F.pmod(nth, F.lit(131)) < 40)
    lost = F.when(nth % 2 == 0, F.lit(None)).otherwise(F.lit(math.nan))
    return rows.withColumn("close", F.when(gone, lost).otherwise(F.col("close")))


@pytest.mark.parametrize("limits", [Limits(), SPLIT])
def test_a_missing_close_keeps_its_row_in_every_feature(frame, limits):
    rows = holed(frame(series("A", walk(31, 1300)) + series("B", walk(32, 40))), 1)
    whole = collected(ft.features(rows, limits))
    assert len(whole) == 1340 and whole.close.isna().sum() > 300
    for symbol in "AB":
        own = whole[whole.symbol == symbol].reset_index(drop=True)
        assert_close(own, brute_force(own.close))
    for call, names in (
        (ft.returns, ["log_return_1", "return_5"]),
        (ft.moving_averages, [f"ma_{n}" for n in FEATURE_SPANS]),
        (ft.volatility, [f"vol_{n}" for n in FEATURE_SPANS]),
        (ft.rsi, ["rsi_14"]),
        (ft.ema, [f"ema_{n}" for n in FEATURE_SPANS]),
    ):
        assert_close(collected(call(rows, limits=limits), "candle_close_time"), whole[names])


def test_a_symbol_without_any_close(frame):
    rows = holed(frame(series("A", walk(33, 20))), 1, head=20)
    got = collected(ft.features(rows))
    assert len(got) == 20 and got[["ema_5", "ma_5", "vol_5"]].isna().all().all()


@pytest.mark.parametrize("runs", [1, 7, 61, 600])
def test_states_compose_to_the_same_emas(spark, frame, monkeypatch, runs):
    from pyspark.sql import functions as F

    monkeypatch.setattr(states, "FAN", 4)
    closes = walk(34, 600)
    rows = holed(frame(series("A", closes)), 2).select("symbol", "candle_close_time", states.known_close().alias("close"))
    minute = ((F.unix_timestamp("candle_close_time") - 1704067200) / 60).cast("long")
    rows = rows.withColumn("run", F.floor(minute * runs / 600).cast("long"))
    of_runs = states.summaries(rows, ["symbol", "run"], ORDER, (5, 60), 61)
    before = states.exclusive_prefixes(of_runs, "run", runs, (5, 60), 61).orderBy("run").collect()
    table = rows.orderBy("candle_close_time").toPandas()
    assert len(before) == runs
    for row in before:
        past = table[table.run < row.run].close
        assert row.before.n == len(past) and row.before.closes == [
            None if math.isnan(c) else c for c in past[::-1][:61]]
        if past.notna().any():
            for s in (5, 60):
                ended = row.before[f"held_{s}"] * row.before.first_close + row.before[f"added_{s}"]
                assert math.isclose(ended, past.ewm(span=s, adjust=False).mean().iloc[-1], rel_tol=1e-9)


def test_split_keeps_rows_without_a_symbol(frame):
    rows = frame(series(None, walk(24, 1300)) + series("B", walk(25, 700)))
    whole, split = collected(ft.features(rows)), collected(ft.features(rows, SPLIT))
    assert len(split) == len(whole) == 2000
    assert_close(split, whole.drop(columns=["symbol", "ts"]))


def test_limits_too_small_to_shrink_the_problem(frame):
    with pytest.raises(ValueError):
        ft.returns(frame(series("A", walk(16, 20))), Limits(10, 10, 10))


def test_snapshot_cuts_to_the_date_after_the_lookback(spark, frame):
    from wickflow.sources.raw import with_start_date

    closes = walk(17, 300)
    raw = with_start_date(frame(series("A", closes, start="2024-01-01T00:00:00", step_minutes=20)))
    got = collected(ft.feature_snapshot(raw, "2024-01-04", lookback_days=3))
    expected = brute_force(closes[72:288])[144:].reset_index(drop=True)
    assert len(got) == 72
    assert_close(got, expected)


def test_snapshot_equals_all_features_of_the_lookback(frame):
    """Symbols with much, little and no history, one without rows on the date."""
    from wickflow.sources.raw import slice_lookback, with_start_date

    rows = (
        series("LONG", walk(19, 3000), start="2024-01-02T00:00:00")
        + series("SHORT", walk(20, 60), start="2024-01-03T23:30:00")
        + series("NEW", walk(21, 40), start="2024-01-04T08:00:00")
        + series("GONE", walk(22, 40), start="2024-01-02T08:00:00")
        + series("NEXT", walk(23, 5), start="2024-01-05T00:00:00")
    )
    raw = with_start_date(frame(rows))
    whole = ft.features(slice_lookback(raw, "2024-01-04", 3)).filter("to_date(ts) = '2024-01-04'")
    expected = collected(whole)
    assert sorted(expected.symbol.unique()) == ["LONG", "NEW", "SHORT"]
    assert_close(collected(ft.feature_snapshot(holed(raw, 3), "2024-01-04", 3)), collected(
        ft.features(slice_lookback(holed(raw, 3), "2024-01-04", 3)).filter("to_date(ts) = '2024-01-04'")
    ).drop(columns=["symbol", "ts"]))
    for limits in (Limits(), SPLIT):
        got = collected(ft.feature_snapshot(raw, "2024-01-04", 3, limits=limits))
        assert list(got.ts) == list(expected.ts) and list(got.symbol) == list(expected.symbol)
        assert_close(got, expected.drop(columns=["symbol", "ts"]))
    some = ft.feature_snapshot(raw, "2024-01-04", 3, ["NEW"])
    assert collected(some).symbol.unique() == ["NEW"]


def test_one_shuffle_and_one_sort(frame):
    plan = ft.features(frame(series("A", walk(18, 5))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "Python" not in plan and "Pandas" not in plan
