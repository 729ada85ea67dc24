import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException

from wickflow.functions.kline import judge_klines, kline_message, parse_klines, stream_names
from wickflow.schemas import RAW_CANDLES, RAW_COLUMNS

from conftest import candle


def message(closed=True, **changes):
    body = {
        "t": 1768262400000,
        "T": 1768262459999,
        "s": "BTCUSDT",
        "i": "1m",
        "o": "91000.10",
        "h": "91010.00",
        "l": "90990.5",
        "c": "91005",
        "x": closed,
    }
    body.update(changes)
    return json.dumps({"stream": "any", "data": {"e": "kline", "E": 1768262460012, "k": body}})


def texts(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def test_closed_candle_is_mapped_to_the_raw_columns(spark):
    parsed = parse_klines(texts(spark, message()))
    assert parsed.columns == RAW_COLUMNS
    assert [f.dataType for f in parsed.schema] == [f.dataType for f in RAW_CANDLES]
    row = parsed.selectExpr("*", "unix_millis(candle_start_time) AS t", "unix_millis(event_time) AS e",
                            "unix_millis(candle_close_time) AS c").first()
    assert (row.t, row.c, row.e) == (1768262400000, 1768262459999, 1768262460012)
    assert (row.exchange, row.symbol, row.interval, row.is_closed) == ("binance", "BTCUSDT", "1m", True)
    assert (row.open, row.high, row.low, row.close) == (91000.10, 91010.0, 90990.5, 91005.0)
    assert row.ingestion_timestamp is not None


@pytest.mark.parametrize(
    "text",
    [
        message(closed=False),
        '{"result": null, "id": 1}',
        '{"data": {}}',
        '{"data": {"E": 1, "k": null}}',
        "{broken",
        "",
        message(s="DOGEUSDT"),
        message(i="5m"),
    ],
)
def test_other_messages_are_left_out(spark, text):
    assert parse_klines(texts(spark, text, message())).count() == 1


def test_bad_price_fails_or_is_dropped(spark):
    rows = texts(spark, message(c="n/a"), message())
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        parse_klines(rows).collect()
    assert parse_klines(rows, bad_prices="drop").count() == 1
    with pytest.raises(ValueError):
        parse_klines(rows, bad_prices="keep")


@pytest.mark.parametrize("key", ["t", "T", "o", "h", "l", "c"])
@pytest.mark.parametrize("value", [None, "abc"])
def test_required_fields_follow_the_mode(spark, key, value):
    rows = texts(spark, message(**{key: value}), message())
    with pytest.raises(PySparkException):
        parse_klines(rows).collect()
    assert parse_klines(rows, bad_prices="drop").count() == 1


def test_times_beyond_the_calendar_are_bad(spark):
    rows = texts(spark, message(t=2**63 - 1), message(T=-(2**62)), message())
    with pytest.raises(PySparkException, match="without a valid"):
        parse_klines(rows).collect()
    assert parse_klines(rows, bad_prices="drop").count() == 1


def test_values_may_be_bytes(spark):
    rows = texts(spark, message(), message(closed=False)).selectExpr("CAST(value AS BINARY) AS value")
    assert parse_klines(rows).first().symbol == "BTCUSDT"


def test_symbols_are_matched_in_upper_case(spark):
    assert parse_klines(texts(spark, message()), symbols=["btcusdt"]).count() == 1
    assert parse_klines(texts(spark, message(s="btcUsdt"))).first().symbol == "BTCUSDT"
    assert stream_names(["BTCUSDT", "ethusdt"], "1m") == ["btcusdt@kline_1m", "ethusdt@kline_1m"]


def test_messages_round_trip(frame):
    rows = frame([candle("BTCUSDT", "2024-02-29T23:59:00", 10.25, open=10, high=11.5, low=9.75)])
    parsed = parse_klines(rows.select(kline_message().alias("value")))
    names = [c for c in RAW_COLUMNS if c != "ingestion_timestamp"]
    assert parsed.select(names).collect() == rows.select(names).collect()


def test_parsing_decodes_each_message_once(spark):
    plan = parse_klines(texts(spark, message()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_every_message_is_kept_or_has_a_reason(spark):
    reasons = {
        message(): None,
        message(s="btcusdt"): None,
        message(closed=False): "open candle",
        message(x=None): "open candle",
        '{"result": null, "id": 1}': "no kline",
        '{"data": {"E": 1, "k": null}}': "no kline",
        "{broken": "not json",
        "": "not json",
        message(s="DOGEUSDT"): "other symbol",
        message(s=None): "other symbol",
        message(i="5m"): "other interval",
        message(c="x"): "bad c",
        message(o=None, c="x"): "bad o",
        message(t=10**17): "bad t",
    }
    rows = texts(spark, *reasons, None)
    judged = judge_klines(rows).collect()
    assert {r.value: r.reason for r in judged} == reasons | {None: "not json"}
    assert all((r.candle is None) == (r.reason is not None) for r in judged)
    kept = judge_klines(rows).filter("reason IS NULL").select("candle.*").drop("ingestion_timestamp")
    parsed = parse_klines(rows, bad_prices="drop").drop("ingestion_timestamp")
    assert kept.schema.simpleString() == parsed.schema.simpleString()
    assert sorted(kept.collect()) == sorted(parsed.collect())
