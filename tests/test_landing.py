"""The landing ledger and the partition index."""

import os
import shutil

import pyarrow.parquet as pq
import pytest

from wickflow.plans import gold, landing
from wickflow.sources import index
from wickflow.sources.raw import raw_files, raw_table, with_start_date

from conftest import candle, series


@pytest.fixture
def job(spark, tmp_path):
    names = ("landing", "raw", "checkpoint", "archive", "closed")
    paths = {n: str(tmp_path / n) for n in names}

    def run(named_folders=False, **options):
        return landing.land_files(
            spark, paths["landing"], paths["raw"], paths["checkpoint"], paths["archive"], named_folders, **options
        )

    return paths, run


def deliver(frame, base, name, rows, date="2024-01-01"):
    """One Parquet file of that name in a plain folder."""
    folder = f"{base}/binance/BTCUSDT/{date}"
    os.makedirs(folder, exist_ok=True)
    table = frame(rows).toArrow()
    pq.write_table(table, f"{folder}/{name}", coerce_timestamps="us")
    return f"{folder}/{name}"


def closes(spark, paths):
    return sorted(r.close for r in raw_table(spark, paths["raw"]).collect())


def test_a_name_that_comes_again_replaces_its_rows(spark, frame, job):
    paths, run = job
    deliver(frame, paths["landing"], "a.parquet", series("BTCUSDT", [1, 2, 3, 4]))
    deliver(frame, paths["landing"], "b.parquet", series("BTCUSDT", [50]))
    assert run() == (2, 2, [])
    # now also a candle of the next day, and later one fewer
    later = [*series("BTCUSDT", [5, 6, 7, 8]), candle("BTCUSDT", "2024-01-02T00:00:00", 9)]
    deliver(frame, paths["landing"], "a.parquet", later)
    assert run() == (1, 1, [])
    assert closes(spark, paths) == [5, 6, 7, 8, 9, 50]
    deliver(frame, paths["landing"], "a.parquet", series("BTCUSDT", [5, 6, 7]))
    assert run() == (1, 1, [])
    assert closes(spark, paths) == [5, 6, 7, 50]
    assert run() == (0, 0, [])
    assert raw_files(spark, paths["landing"]).count() == 0
    assert raw_files(spark, paths["archive"]).count() == 4
    held = index.partition_index(spark, paths["raw"]).collect()
    assert [(r.date.day, r.n_rows, r.last_close) for r in held] == [(1, 4, 7)]


def test_a_batch_written_again_after_landing_counts_once(spark, frame, job):
    paths, run = job
    rows = with_start_date(frame(series("BTCUSDT", range(10)) + series("ETHUSDT", [1])))
    for _ in range(2):
        landing.write_batch(rows, paths["landing"], "stream-x-3")
        assert run(named_folders=True) == (2, 2, [])
        assert raw_table(spark, paths["raw"]).count() == 11
    # another batch is no repetition
    landing.write_batch(rows, paths["landing"], "stream-x-4")
    run(named_folders=True)
    assert raw_table(spark, paths["raw"]).count() == 22


def test_parts_of_a_job_may_arrive_one_by_one(spark, frame, job, tmp_path):
    paths, run = job
    rows = with_start_date(frame(series("BTCUSDT", range(10))))
    landing.write_batch(rows, str(tmp_path / "made"), "stream-x-1")
    source = next(r.path for r in raw_files(spark, str(tmp_path / "made")).collect()).removeprefix("file:")
    folder = os.path.dirname(source).replace("/made/", "/landing/")
    os.makedirs(folder)
    name = os.path.basename(source)
    shutil.copy(source, f"{folder}/{name}")
    assert run(named_folders=True)[0] == 1
    shutil.copy(source, f"{folder}/{name.replace('part-00000', 'part-00001')}")
    assert run(named_folders=True)[0] == 1
    assert raw_table(spark, paths["raw"]).count() == 20


def test_a_file_that_cannot_be_moved_stops_no_other(spark, frame, job, monkeypatch):
    paths, run = job
    stuck = deliver(frame, paths["landing"], "a.parquet", series("BTCUSDT", [1]))
    deliver(frame, paths["landing"], "b.parquet", series("BTCUSDT", [2]), "2024-01-02")
    blocked = paths["archive"] + os.path.dirname(stuck)
    os.makedirs(os.path.dirname(blocked))
    open(blocked, "w").close()  # a file where the archive needs a folder
    with pytest.warns(UserWarning, match="could not be moved"):
        found = run()
    assert found.landed == 2 and found.archived == 1 and len(found.failed) == 1 and os.path.exists(stuck)
    marked = landing.mark_closed(spark, paths["landing"], paths["raw"], paths["closed"], "2024-02-01")
    assert marked == 0  # both rows start on the first, which has a file left
    os.remove(blocked)
    assert run() == (0, 1, [])
    assert closes(spark, paths) == [1, 2]
    assert landing.mark_closed(spark, paths["landing"], paths["raw"], paths["closed"], "2024-02-01") == 1


def test_a_run_that_died_before_the_ledger_is_repeated(spark, frame, job):
    paths, run = job
    deliver(frame, paths["landing"], "a.parquet", series("BTCUSDT", [1, 2]))
    run()
    kept = next(r.path for r in raw_files(spark, paths["archive"]).collect()).removeprefix("file:")
    shutil.rmtree(paths["checkpoint"])
    shutil.move(kept, kept.removeprefix(paths["archive"]))
    assert run(max_files=1)[0] == 1
    assert closes(spark, paths) == [1, 2]


def test_dates_are_chosen_and_marked_without_the_table(spark, frame, tmp_path):
    raw, out, closed, waiting = (str(tmp_path / n) for n in ("raw", "gold", "closed", "waiting"))
    assert gold.refresh(spark, raw, out, ["BTCUSDT"]) is None
    os.makedirs(waiting)
    landing.append_raw(frame(series("BTCUSDT", [1, 2])), raw)
    landing.append_raw(frame(series("BTCUSDT", [3], start="2024-01-02T00:00:00")), raw)
    files = [f for f in index.partition_index(spark, raw).inputFiles()]
    assert files and all("/_partitions/" in f for f in files)
    for folder in os.listdir(raw):
        if not folder.startswith("_"):  # nothing but the index is left to read
            shutil.rmtree(f"{raw}/{folder}")
    assert landing.mark_closed(spark, waiting, raw, closed, "2024-01-02") == 1
    found = gold.next_gold_date(index.partition_index(spark, raw), ["BTCUSDT"], "2024-01-05")
    assert found.first().date.isoformat() == "2024-01-02"


def test_index_of_an_older_table_and_merging(spark, frame, tmp_path):
    raw = str(tmp_path / "raw")
    for day in ("01", "02"):
        landing.append_raw(frame(series("BTCUSDT", [1, 2], start=f"2024-01-{day}T00:00:00")), raw)
    def held():
        return sorted(tuple(r)[:-1] for r in index.partition_index(spark, raw).collect())  # not when it changed

    before = held()
    shutil.rmtree(f"{raw}/_partitions")
    assert [r[3] for r in held()] == [2, 2]  # read from the table
    landing.append_raw(frame(series("ETHUSDT", [1])), raw)
    assert [r for r in held() if r[1] == "BTCUSDT"] == before
    entries = len(os.listdir(f"{raw}/_partitions"))
    whole = held()
    index.compact_index(spark, raw)
    assert len(os.listdir(f"{raw}/_partitions")) == 1 < entries
    assert held() == whole
