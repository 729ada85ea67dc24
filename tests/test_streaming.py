import json
import os
import time

import pytest

from wickflow.plans import landing
from wickflow.sources.raw import RAW_FILE_PATTERN, inventory, raw_files, raw_table, with_start_date

from wickflow.streaming.ingest import ingest, message_stream, rejected_messages

from conftest import candle
from test_parse import message
from test_slices import plain_file


@pytest.fixture
def job(spark, tmp_path):
    incoming, raw, checkpoint = (tmp_path / n for n in ("in", "raw", "checkpoint"))
    incoming.mkdir()

    def run(name, *messages, **options):
        run.raw = str(raw)
        (incoming / name).write_text("\n".join(messages) + "\n")
        query = ingest(message_stream(spark, str(incoming)), str(raw), str(checkpoint),
                       drain=True, **options)
        query.awaitTermination()
        return raw_table(spark, str(raw)) if raw.exists() else None

    return run


def raw_path(job):
    return job.raw


def test_only_closed_candles_reach_the_table(job):
    got = job("a.txt", message(), message(closed=False), '{"result":null,"id":1}', "{bad",
              message(c="x"), message(s="ETHUSDT"))
    assert sorted(r.symbol for r in got.collect()) == ["BTCUSDT", "ETHUSDT"]
    assert {r.date.isoformat() for r in got.collect()} == {"2026-01-13"}


def test_a_restart_neither_loses_nor_repeats(job):
    assert job("a.txt", message()).count() == 1
    assert job("b.txt", message(s="ETHUSDT")).count() == 2
    assert job("c.txt", "").count() == 2


def test_late_candles_go_to_their_own_date(job):
    day = 86_400_000
    job("a.txt", message())
    start = json.loads(message())["data"]["k"]["t"]
    got = job("b.txt", message(t=start - 40 * day, T=start - 40 * day + 59_999))
    assert sorted(r.date.isoformat() for r in got.collect()) == ["2025-12-04", "2026-01-13"]


def test_bad_price_can_stop_the_stream(job):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        job("a.txt", message(c="x"), bad_prices="raise")


def test_landing_moves_archives_and_marks_once(spark, tmp_path):
    base = tmp_path / "landing"
    names = ("raw", "checkpoint", "archive", "closed")
    raw, checkpoint, archive, closed = (str(tmp_path / n) for n in names)

    def run(as_of="2026-01-15"):
        return landing.land_archive_mark(spark, str(base), raw, checkpoint, archive, closed, as_of)

    def waiting():
        found = inventory(raw_files(spark, str(base)), RAW_FILE_PATTERN).collect()
        return sorted((r.symbol, r.date.day) for r in found)

    plain_file(base, "BTCUSDT", "2026-01-13", "us")
    plain_file(base, "ETHUSDT", "2026-01-13", "us")
    assert run() == 2
    assert waiting() == []
    plain_file(base, "BTCUSDT", "2026-01-14", "us")
    assert run() == 1
    assert run() == 0
    plain_file(base, "BTCUSDT", "2026-01-15", "us")
    assert run() == 0
    marked = landing.closed_table(spark, closed).collect()
    assert sorted((r.symbol, r.date.day) for r in marked) == [
        ("BTCUSDT", 13), ("BTCUSDT", 14), ("ETHUSDT", 13)]
    assert raw_table(spark, raw).count() == 8
    assert raw_files(spark, archive).count() == 4


def test_an_unread_file_stays_and_keeps_its_date_open(spark, tmp_path):
    base, raw, archive, closed = (str(tmp_path / n) for n in ("in", "raw", "archive", "closed"))
    plain_file(tmp_path / "in", "BTCUSDT", "2026-01-13", "us")
    plain_file(tmp_path / "in", "BTCUSDT", "2026-01-12", "us")
    bad = tmp_path / "in" / "binance" / "BTCUSDT" / "2026-01-13" / "bad.parquet"
    bad.write_text("no parquet")
    with pytest.raises(Exception):
        landing.land_files(spark, base, raw, str(tmp_path / "cp"), archive)
    marked = landing.land_archive_mark(
        spark, base, raw, str(tmp_path / "cp"), archive, closed, "2026-01-15", skip_corrupt=True)
    assert marked == 1 and bad.exists()
    assert [r.date.day for r in landing.closed_table(spark, closed).collect()] == [12]
    assert raw_table(spark, raw).count() == 4
    assert raw_files(spark, archive).count() == 2


def test_old_and_nanosecond_files_land(spark, tmp_path):
    base, raw, archive = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "archive")
    for date, age in (("2026-01-12", 400), ("2026-01-13", 8), ("2026-01-14", 0)):
        plain_file(base, "BTCUSDT", date, None)
        for file in (base / "binance" / "BTCUSDT" / date).glob("*.parquet"):
            os.utime(file, (time.time() - age * 86_400,) * 2)
    landing.land_files(spark, str(base), raw, str(tmp_path / "cp"), archive, nanoseconds=True)
    assert raw_table(spark, raw).select("date").distinct().count() == 3
    assert raw_files(spark, archive).count() == 3
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"


def test_rejected_messages_are_kept_with_their_reason(spark, job, tmp_path):
    path = str(tmp_path / "rejected")
    got = job("a.txt", message(), message(closed=False), "{bad", message(c="x"), rejected_path=path)
    assert got.count() == 1
    assert job("b.txt", "{bad", rejected_path=path).count() == 1
    found = sorted((r.reason, r.value) for r in rejected_messages(spark, path).collect())
    assert found == [("bad c", message(c="x")), ("not json", "{bad"), ("not json", "{bad"),
                     ("open candle", message(closed=False))]


def test_candles_are_held_until_enough_or_long_enough(spark, job):
    start = json.loads(message())["data"]["k"]["t"]

    def minutes(first, n, symbol="BTCUSDT"):
        return [message(s=symbol, t=start + 60_000 * i, T=start + 60_000 * i + 59_999) for i in range(first, first + n)]

    def run(name, *texts, seconds=3_600):
        job(name, *texts, flush_events=10, flush_seconds=seconds)
        path = raw_path(job)
        return sorted((r.symbol, r["count"]) for r in raw_table(spark, path).groupBy("symbol").count().collect()) \
            if os.path.exists(path) else []

    assert run("a.txt", *minutes(0, 6)) == []
    # every run is a restart: what was held is still there
    assert run("b.txt", *minutes(6, 3), *minutes(0, 4, "ETHUSDT")) == []
    assert run("c.txt", *minutes(9, 5)) == [("BTCUSDT", 14)]
    assert run("d.txt", *minutes(14, 2), seconds=1) == [("BTCUSDT", 14)]
    time.sleep(1.5)
    # ETHUSDT waits for its hour, BTCUSDT's second is over
    assert run("e.txt", *minutes(4, 1, "ETHUSDT")) == [("BTCUSDT", 16)]
    assert run("f.txt", *minutes(5, 25, "ETHUSDT")) == [("BTCUSDT", 16), ("ETHUSDT", 30)]


def test_old_messages_are_read(job, tmp_path):
    job("new.txt", message())
    (tmp_path / "in" / "old.txt").write_text(message(s="ETHUSDT") + "\n")
    os.utime(tmp_path / "in" / "old.txt", (time.time() - 400 * 86_400,) * 2)
    assert job("none.txt", "").count() == 2


def test_what_ingest_wrote_can_be_landed_and_appended_to(spark, job, frame, tmp_path):
    texts = [message(), message(s="ETHUSDT")] * 50
    job("a.txt", *texts)
    landing_folder = str(tmp_path / "raw")
    assert raw_files(spark, landing_folder).count() == 2
    landing.append_raw(frame([candle("BTCUSDT", "2026-01-12T00:00:00", 1)]), landing_folder)
    args = [str(tmp_path / n) for n in ("landed", "cp", "archive", "closed")]

    def run():
        return landing.land_archive_mark(
            spark, landing_folder, *args, "2026-01-14", named_folders=True)

    assert run() == 3
    job("b.txt", message())
    assert run() == 0
    assert raw_table(spark, args[0]).count() == 102
    assert raw_files(spark, landing_folder).count() == 0


def test_a_repeated_batch_replaces_itself(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    rows = with_start_date(frame([candle("BTCUSDT", "2026-01-12T00:00:00", 1)]))
    landing.append_raw(rows, path)
    for name in ("a", "b", "b"):
        landing.write_batch(rows, path, name)
    assert raw_table(spark, path).count() == 3


def test_append_raw_partitions_by_start_date(spark, frame, tmp_path):
    path = str(tmp_path / "raw")
    landing.append_raw(frame([candle("BTCUSDT", "2024-01-31T23:59:30", 1)]), path)
    assert raw_table(spark, path).first().date.isoformat() == "2024-01-31"
