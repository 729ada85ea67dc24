"""Table schemas: raw one-minute candles and the four gold tables."""

from pyspark.sql import types as T

RAW_CANDLES = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("candle_start_time", T.TimestampType()),
        T.StructField("candle_close_time", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("is_closed", T.BooleanType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
    ]
)

RAW_COLUMNS = RAW_CANDLES.fieldNames()
RAW_TIMESTAMPS = [f.name for f in RAW_CANDLES if f.dataType == T.TimestampType()]

# Raw rows live under exchange / symbol / UTC date of the candle start.
RAW_PARTITIONS = ["exchange", "symbol", "date"]


def _prices(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


HOURLY_OHLC = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("hour_ts", T.TimestampType())]
    + _prices("open", "high", "low", "avg_price", "close")
)

DAILY_OHLC = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())]
    + _prices("open", "high", "low", "close")
)

MONTHLY_OHLC = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("month", T.DateType())]
    + _prices("open", "high", "low", "avg_price", "close")
)

# Frame lengths and smoothing spans of the feature table.
FEATURE_SPANS = (5, 15, 30, 60)
RSI_ROWS = 14

FEATURES = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
    + _prices(
        "close",
        "log_return_1",
        "return_5",
        *(f"ma_{n}" for n in FEATURE_SPANS),
        *(f"ema_{n}" for n in FEATURE_SPANS),
        *(f"vol_{n}" for n in FEATURE_SPANS),
        "rsi_14",
    )
    + [
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)
