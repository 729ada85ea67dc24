import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wickflow.schemas import RAW_CANDLES  # noqa: E402
from wickflow.session import configure, with_static_settings  # noqa: E402

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    session = (
        with_static_settings(SparkSession.builder.master("local[4]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def candle(symbol, start, close, open=None, high=None, low=None, seconds=59.999, exchange="binance"):
    """A raw row that starts at ``start`` (ISO text, UTC)."""
    begin = dt.datetime.fromisoformat(start).replace(tzinfo=UTC)
    end = begin + dt.timedelta(seconds=seconds)
    open = close if open is None else open
    return (
        exchange,
        symbol,
        "1m",
        end,
        begin,
        end,
        float(open),
        float(max(open, close) if high is None else high),
        float(min(open, close) if low is None else low),
        float(close),
        True,
        end,
    )


def series(symbol, closes, start="2024-01-01T00:00:00", step_minutes=1):
    """One candle per close, ``step_minutes`` apart."""
    first = dt.datetime.fromisoformat(start)
    return [
        candle(symbol, (first + dt.timedelta(minutes=i * step_minutes)).isoformat(), close)
        for i, close in enumerate(closes)
    ]


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, RAW_CANDLES)
