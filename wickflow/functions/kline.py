"""Kline messages (nested JSON) to raw candle rows, in batch and in streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickflow.schemas import RAW_COLUMNS

# What the collector subscribes to.
EXCHANGE = "binance"
SYMBOLS = ("BTCUSDT", "ETHUSDT")
INTERVAL = "1m"

# The kline body has both `t` and `T`. A map keeps such keys apart, where a
# struct would find them ambiguous, and the message is still decoded once.
MESSAGE_TYPE = "struct<data: struct<E: bigint, k: map<string, string>>>"


def stream_names(symbols: Iterable[str], interval: str) -> list[str]:
    """Names a subscription asks for: ``<symbol>@kline_<interval>``."""
    return [f"{symbol.lower()}@kline_{interval}" for symbol in symbols]


# Milliseconds of the years 1 to 9999; other numbers are no times.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999
REQUIRED = ["event_time", "candle_start_time", "candle_close_time", "open", "high", "low", "close"]


def parse_klines(
    messages: DataFrame,
    symbols: Iterable[str] = SYMBOLS,
    interval: str = INTERVAL,
    exchange: str = EXCHANGE,
    bad_prices: str = "raise",
    ingested_at: Column | None = None,
) -> DataFrame:
    """Rows of ``messages.value`` as raw candles.

    ``value`` is text or, as message brokers deliver it, UTF-8 bytes. Messages
    without a kline body (acknowledgements, text that is not JSON), candles that
    are still open and other subscriptions are left out. A price or time that is
    missing or malformed fails the query, or drops the message when
    ``bad_prices="drop"``. Symbols are matched in any case and come out as ``symbols``
    has them.
    """
    if bad_prices not in ("raise", "drop"):
        raise ValueError("bad_prices is 'raise' or 'drop'")

    # `inline` keeps the decoded message in a row of its own: as plain columns
    # the optimizer would repeat the decoding in every filter below.
    message = F.from_json(F.col("value").cast("string"), MESSAGE_TYPE)
    body = messages.select(F.inline(F.array(message["data"])))
    wanted = {symbol.upper(): symbol for symbol in symbols}
    pairs = [F.lit(text) for pair in wanted.items() for text in pair]
    named = F.create_map(*(pairs or [F.lit(""), F.lit("")]))  # an empty map has no key type
    kept = body.filter(
        F.col("k").isNotNull()
        & (F.col("k")["x"] == "true")
        & F.upper(F.col("k")["s"]).isin(list(wanted))
        & (F.col("k")["i"] == interval)
    )

    def required(value: Column, key: str) -> Column:
        if bad_prices == "drop":
            return value
        return F.coalesce(value, F.raise_error(F.lit(f"a message without a valid {key}")))

    def cast(key: str, kind: str) -> Column:
        text = F.col("k")[key]
        return text.cast(kind) if bad_prices == "raise" else text.try_cast(kind)

    def number(key: str) -> Column:
        return required(cast(key, "double"), key)

    def instant(millis: Column, key: str) -> Column:
        in_range = F.when(millis.between(FIRST_MS, LAST_MS), millis)
        return F.timestamp_millis(required(in_range, key))

    candles = kept.select(
        F.lit(exchange).alias("exchange"),
        named[F.upper(F.col("k")["s"])].alias("symbol"),
        F.col("k")["i"].alias("interval"),
        instant(F.col("E"), "E").alias("event_time"),
        instant(cast("t", "bigint"), "t").alias("candle_start_time"),
        instant(cast("T", "bigint"), "T").alias("candle_close_time"),
        number("o").alias("open"),
        number("h").alias("high"),
        number("l").alias("low"),
        number("c").alias("close"),
        F.lit(True).alias("is_closed"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias(
            "ingestion_timestamp"
        ),
    )
    if bad_prices == "drop":
        candles = candles.dropna(subset=REQUIRED)
    return candles.select(*RAW_COLUMNS)


def judge_klines(
    messages: DataFrame,
    symbols: Iterable[str] = SYMBOLS,
    interval: str = INTERVAL,
    exchange: str = EXCHANGE,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Every message as text with the ``reason`` why it gives no candle, or without one and
    with its ``candle``, a struct of the raw columns.

    Reasons are, in this order: ``not json``, ``no kline``, ``open candle``,
    ``other symbol``, ``other interval`` and ``bad <key>`` for the first price or time that
    is missing or malformed. What is left is what ``parse_klines`` keeps.
    """
    text = F.col("value").cast("string")
    message = F.from_json(text, MESSAGE_TYPE)
    rows = messages.select(F.inline(F.array(F.struct(text.alias("value"), message["data"].alias("data")))))
    wanted = {symbol.upper(): symbol for symbol in symbols}
    pairs = [F.lit(text) for pair in wanted.items() for text in pair]
    named = F.create_map(*(pairs or [F.lit(""), F.lit("")]))
    body = F.col("data")["k"]

    def instant(millis: Column) -> Column:
        return F.timestamp_millis(F.when(millis.between(FIRST_MS, LAST_MS), millis))

    times = {"E": instant(F.col("data")["E"])} | {k: instant(body[k].try_cast("bigint")) for k in ("t", "T")}
    prices = {k: body[k].try_cast("double") for k in ("o", "h", "l", "c")}
    bad = [F.when(value.isNull(), F.lit(f"bad {key}")) for key, value in (times | prices).items()]
    reason = F.coalesce(
        F.when(body.isNull(), F.when(F.try_parse_json("value").isNull(), "not json").otherwise("no kline")),
        F.when(~F.coalesce(body["x"] == "true", F.lit(False)), "open candle"),
        F.when(~F.coalesce(F.upper(body["s"]).isin(list(wanted)), F.lit(False)), "other symbol"),
        F.when(~F.coalesce(body["i"] == interval, F.lit(False)), "other interval"),
        *bad,
    )
    values = [
        F.lit(exchange),
        F.try_element_at(named, F.upper(body["s"])),
        body["i"],
        *times.values(),
        *prices.values(),
        F.lit(True),
        F.current_timestamp() if ingested_at is None else ingested_at,
    ]
    candle = F.struct(*(v.alias(c) for c, v in zip(RAW_COLUMNS, values, strict=True)))
    judged = rows.select("value", reason.alias("reason"), candle.alias("candle"))
    return judged.withColumn("candle", F.when(F.col("reason").isNull(), F.col("candle")))


def kline_message(
    closed: bool = True, symbol: Column | str = "symbol", interval: Column | str = "interval"
) -> Column:
    """The message an exchange sends for a raw candle row: the inverse of parsing."""
    body = F.struct(
        F.unix_millis("candle_start_time").alias("t"),
        F.unix_millis("candle_close_time").alias("T"),
        (F.col(symbol) if isinstance(symbol, str) else symbol).alias("s"),
        (F.col(interval) if isinstance(interval, str) else interval).alias("i"),
        F.col("open").cast("string").alias("o"),
        F.col("high").cast("string").alias("h"),
        F.col("low").cast("string").alias("l"),
        F.col("close").cast("string").alias("c"),
        F.lit(closed).alias("x"),
    )
    event_time = F.unix_millis("event_time").alias("E")
    data = F.struct(F.lit("kline").alias("e"), event_time, body.alias("k"))
    return F.to_json(F.struct(data.alias("data")))
