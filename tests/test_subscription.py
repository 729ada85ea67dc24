"""The subscribed source: offsets, restarts, streams that are not subscribed to."""

import json
import os

from wickflow.sources.raw import raw_table
from wickflow.streaming.ingest import ingest
from wickflow.streaming.subscription import Reader, subscribe

from test_parse import message


def record(base, stream, number, *texts):
    os.makedirs(f"{base}/{stream}", exist_ok=True)
    with open(f"{base}/{stream}/{number}.jsonl", "w") as file:
        file.write("".join(f"{t}\n" for t in texts))


def at(minute, symbol):
    start = json.loads(message())["data"]["k"]["t"] + 60_000 * minute
    return message(s=symbol, t=start, T=start + 59_999)


def test_a_subscription_reads_its_streams_once(spark, tmp_path):
    base, raw, checkpoint = (str(tmp_path / n) for n in ("streams", "raw", "checkpoint"))

    def run():
        ingest(subscribe(spark, base), raw, checkpoint, drain=True).awaitTermination()
        rows = raw_table(spark, raw)
        return sorted((r.symbol, r["count"]) for r in rows.groupBy("symbol").count().collect())

    record(base, "btcusdt@kline_1m", 0, at(0, "BTCUSDT"), at(1, "BTCUSDT"))
    record(base, "ethusdt@kline_1m", 0, at(0, "ETHUSDT"))
    record(base, "dogeusdt@kline_1m", 0, at(0, "DOGEUSDT"), at(0, "BTCUSDT"))
    assert run() == [("BTCUSDT", 2), ("ETHUSDT", 1)]
    record(base, "btcusdt@kline_1m", 1, at(2, "BTCUSDT"))
    assert run() == [("BTCUSDT", 3), ("ETHUSDT", 1)]
    assert run() == [("BTCUSDT", 3), ("ETHUSDT", 1)]


def test_offsets_and_replay(tmp_path):
    base = str(tmp_path)
    for k in (0, 1, 2, 4):
        record(base, "a", k, f"m{k}")
    open(f"{base}/a/3.jsonl.part", "w").close()
    reader = Reader(base, ["a", "none"], 2)
    assert reader.initialOffset() == {"a": 0, "none": 0}
    assert reader.latestOffset() == {"a": 3, "none": 0}  # 3 is missing, so 4 waits
    parts = reader.partitions({"a": 0, "none": 0}, {"a": 3, "none": 0})
    assert [list(reader.read(p)) for p in parts] == [[("a", 0, "m0"), ("a", 1, "m1")], [("a", 2, "m2")]]
    record(base, "a", 3, "m3")
    os.remove(f"{base}/a/0.jsonl")
    again = Reader(base, ["a", "none"], 2)  # after a restart
    assert again.latestOffset() == {"a": 5, "none": 0}
    (part,) = again.partitions({"a": 3, "none": 0}, {"a": 5, "none": 0})
    assert list(again.read(part)) == [("a", 3, "m3"), ("a", 4, "m4")]
