"""Per-candle technical features: returns, means, volatility, RSI, EMAs, calendar.

Frames are ROWS, not time: a missing minute is skipped, not filled. Means,
volatility and RSI look at the rows before the current one only; returns and
EMAs include it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickflow.functions.calendar import parse_date
from wickflow.operators.ema import apply_carries, carried_over, ema_layers, finished, gap_layers
from wickflow.operators.layers import Layers, add_layers, lag, trailing
from wickflow.operators.sequence import ORDER, Limits, measure, over_symbol_rows
from wickflow.operators.states import known_close, summaries
from wickflow.schemas import FEATURE_SPANS, FEATURES, RSI_ROWS
from wickflow.sources.raw import slice_lookback

INPUTS = ["symbol", "candle_close_time", "close"]

# The longest frame holds 60 log returns, and the oldest of them reads one more row.
FRAME_ROWS = max(FEATURE_SPANS) + 1


def _steps(spans: Iterable[int]) -> list[tuple[int, int, list[int]]]:
    """``(span, shorter, backs)``: a frame of ``span`` rows is a frame of
    ``shorter`` rows and those that lie ``backs`` rows earlier."""
    spans = list(spans)
    steps = []
    for shorter, span in zip(spans, spans[1:]):
        if span % shorter:
            raise ValueError(f"{span} is not a multiple of {shorter}")
        steps.append((span, shorter, list(range(shorter, span, shorter))))
    return steps


def return_layers() -> Layers:
    """Log return over one row, simple return over five. NULL on a zero divisor."""
    return [
        {"_previous": lag("close", 1), "_fifth": lag("close", 5)},
        {
            "log_return_1": "ln(try_divide(close, _previous))",
            "return_5": "try_divide(close - _fifth, _fifth)",
        },
    ]


def mean_layers(spans: Iterable[int] = FEATURE_SPANS) -> Layers:
    """Trailing means.

    Sum and count of a frame add up those of shorter frames, so a row costs a few
    additions and not one for every row of its longest frame.
    """
    spans = list(spans)
    base = spans[0]
    layers = [
        {
            f"_sum_{base}": f"coalesce({trailing('sum(close)', base)}, 0D)",
            f"_count_{base}": trailing("count(close)", base),
        }
    ]
    for span, shorter, backs in _steps(spans):
        layers.append(
            {
                f"_{part}_{span}": " + ".join(
                    [f"_{part}_{shorter}", *(lag(f"_{part}_{shorter}", b, zero) for b in backs)]
                )
                for part, zero in (("sum", "0D"), ("count", "0L"))
            }
        )
    return [*layers, {f"ma_{n}": f"try_divide(_sum_{n}, _count_{n})" for n in spans}]


def volatility_layers(spans: Iterable[int] = FEATURE_SPANS) -> Layers:
    """Sample standard deviation of the log returns.

    Count, mean and squared deviations of a frame are merged from those of shorter
    frames. Deviations are taken from means, so large terms do not cancel.
    """
    spans = list(spans)
    base = spans[0]
    layers: Layers = [
        {"_previous": lag("close", 1)},
        {"log_return_1": "ln(try_divide(close, _previous))"},
        {
            f"_n_{base}": trailing("count(log_return_1)", base),
            f"_mean_{base}": f"coalesce({trailing('avg(log_return_1)', base)}, 0D)",
            f"_var_{base}": f"coalesce({trailing('var_pop(log_return_1)', base)}, 0D)",
        },
        {f"_dev_{base}": f"_n_{base} * _var_{base}"},
    ]
    for span, shorter, backs in _steps(spans):
        lagged = {
            f"_{part}_{shorter}_{b}": lag(f"_{part}_{shorter}", b, zero)
            for b in backs
            for part, zero in (("n", "0L"), ("mean", "0D"), ("dev", "0D"))
        }
        parts = [str(shorter), *(f"{shorter}_{b}" for b in backs)]
        count = " + ".join(f"_n_{p}" for p in parts)
        total = " + ".join(f"_n_{p} * _mean_{p}" for p in parts)
        within = " + ".join(f"_dev_{p}" for p in parts)
        between = " + ".join(f"_n_{p} * power(_mean_{p} - _mean_{span}, 2)" for p in parts)
        layers += [
            lagged,
            {
                f"_n_{span}": count,
                f"_mean_{span}": f"coalesce(try_divide({total}, {count}), 0D)",
            },
            {f"_dev_{span}": f"{within} + {between}"},
        ]
    last = {
        f"vol_{n}": f"CASE WHEN _n_{n} > 1 THEN sqrt(_dev_{n} / (_n_{n} - 1)) END" for n in spans
    }
    return [*layers, last]


def rsi_layers(rows: int = RSI_ROWS) -> Layers:
    """RSI over plain means of gains and losses.

    ``greatest`` ignores NULL, so the first row of a symbol counts as a gain and
    a loss of 0.
    """
    return [
        {"_previous": lag("close", 1)},
        {
            "_gain": "greatest(close - _previous, 0D)",
            "_loss": "greatest(_previous - close, 0D)",
        },
        {
            "_mean_gain": trailing("avg(_gain)", rows),
            "_mean_loss": trailing("avg(_loss)", rows),
        },
        {
            f"rsi_{rows}": "CASE WHEN _mean_loss = 0 THEN 100D "
            "ELSE 100 - 100 / (1 + try_divide(_mean_gain, _mean_loss)) END"
        },
    ]


def add_calendar(rows: DataFrame) -> DataFrame:
    """Hour 0-23 and day of week, 1 being Sunday, of the close time."""
    return rows.withColumns(
        {
            "hour_of_day": F.hour("candle_close_time"),
            "day_of_week": F.dayofweek("candle_close_time"),
        }
    )


def _inputs(candles: DataFrame) -> DataFrame:
    """The inputs of all candles. A missing close is NULL, in whatever form it came: its row
    stays, frames skip it as a value and count it as a row, and EMAs go on over it."""
    return candles.select(*INPUTS).withColumn("close", known_close())


def returns(candles: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return over_symbol_rows(_inputs(candles), [return_layers()], FRAME_ROWS, limits=limits)


def moving_averages(candles: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return over_symbol_rows(_inputs(candles), [mean_layers()], FRAME_ROWS, limits=limits)


def volatility(candles: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return over_symbol_rows(_inputs(candles), [volatility_layers()], FRAME_ROWS, limits=limits)


def rsi(candles: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return over_symbol_rows(_inputs(candles), [rsi_layers()], FRAME_ROWS, limits=limits)


def ema(
    candles: DataFrame, spans: Iterable[int] = FEATURE_SPANS, limits: Limits = Limits()
) -> DataFrame:
    return over_symbol_rows(_inputs(candles), spans=spans, limits=limits)


def feature_layers() -> list[Layers]:
    return [return_layers(), mean_layers(), volatility_layers(), rsi_layers()]


def features(candles: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All 20 feature columns for every candle, the first one seeding the EMAs."""
    rows = over_symbol_rows(
        _inputs(candles), feature_layers(), FRAME_ROWS, FEATURE_SPANS, limits
    )
    return _feature_table(rows)


def _feature_table(rows: DataFrame) -> DataFrame:
    return (
        add_calendar(rows)
        .withColumnRenamed("candle_close_time", "ts")
        .select(*FEATURES.fieldNames())
    )


def feature_snapshot(
    raw: DataFrame,
    date: dt.date | str,
    lookback_days: int = 60,
    symbols: Iterable[str] | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Features of the candles that close on ``date``, as of its lookback.

    Only the lookback's partitions are scanned: once to count, by two columns, and
    once for the features, which shuffles them once. Earlier
    days are summed up into one number per symbol and EMA. After that only their
    last rows are kept, those that the frames of the date reach into, so most
    window functions see little more than the date itself.
    """
    lookback = _inputs(slice_lookback(raw, date, lookback_days, symbols))
    start, end = _bounds(date)
    sizes = measure(lookback, closes=True)
    closed = F.col("candle_close_time")
    if sizes.largest > limits.symbol_rows:
        rows = features(lookback, limits)
        return rows.filter((F.col("ts") >= start) & (F.col("ts") < end))

    rows = lookback.filter(closed < end).withColumn("_today", closed >= start)
    if sizes.missing:
        earlier = summaries(rows.filter("NOT _today"), ["symbol"], ORDER, FEATURE_SPANS, FRAME_ROWS)
        return features_after(rows.filter("_today"), earlier.select("symbol", "state"), sizes.largest)
    by_part = "PARTITION BY symbol, _today"
    in_part = f"{by_part} ORDER BY candle_close_time, close"
    in_symbol = "PARTITION BY symbol ORDER BY _today, candle_close_time, close"
    rows = rows.withColumns(
        {
            "_place": F.expr(f"row_number() OVER ({in_part})"),
            "_size": F.expr(f"count(*) OVER ({by_part})"),
            "_seed": F.expr(f"first_value(close) OVER ({in_symbol})"),
        }
    )
    rows = rows.withColumns({n: F.expr(sql) for n, sql in carried_over(FEATURE_SPANS).items()})
    rows = rows.filter(f"_today OR _place > _size - {FRAME_ROWS}")
    emas = ema_layers(FEATURE_SPANS, sizes.largest, sizes.spread, seeded=False)
    rows = add_layers(rows, in_part, emas)
    rows = add_layers(rows, in_symbol, *feature_layers()).filter("_today")
    return _feature_table(apply_carries(rows, FEATURE_SPANS, "_place"))


def _bounds(date: dt.date | str) -> tuple[Column, Column]:
    """The instants at which a UTC date starts and ends."""
    midnight = dt.datetime.combine(parse_date(date), dt.time(), dt.timezone.utc)
    return F.lit(midnight), F.lit(midnight + dt.timedelta(days=1))


def features_after(rows: DataFrame, earlier: DataFrame, most_rows: int) -> DataFrame:
    """Features of ``rows`` (the inputs), given the state of each symbol's earlier rows.

    ``earlier`` has a row per symbol. The last closes it holds stand in for the rows that
    frames reach into; ``most_rows`` bounds the rows of one symbol.
    """
    given = earlier.select(F.col("symbol").alias("_of"), F.col("state").alias("before"))
    past = earlier.select("symbol", F.posexplode("state.closes").alias("_back", "close"))
    rows = rows.select(*INPUTS).withColumns({"_today": F.lit(True), "_back": F.lit(0)}).unionByName(
        past.select(
            "symbol",
            F.lit(None).cast("timestamp").alias("candle_close_time"),
            "close",
            F.lit(False).alias("_today"),
            F.col("_back"),
        )
    )
    in_symbol = "PARTITION BY symbol ORDER BY _today, _back DESC, candle_close_time, close"
    rows = add_layers(rows, in_symbol, *feature_layers()).filter("_today").drop("_today", "_back")
    rows = add_layers(rows, "PARTITION BY symbol ORDER BY candle_close_time, close", gap_layers(FEATURE_SPANS, most_rows))
    rows = rows.join(given, F.col("symbol").eqNullSafe(F.col("_of")), "left").drop("_of")
    return _feature_table(finished(rows, FEATURE_SPANS, "before"))
