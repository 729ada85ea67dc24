"""A subscribed source: recorded messages of named streams, as a streaming data source.

A subscription names its streams, ``<symbol>@kline_<interval>``. Their messages are
recorded in segments, text files with a message per line, in a folder for each stream:
``<path>/<stream>/<number>.jsonl``, numbered from 0. An offset is the number of segments
taken of each stream, so the checkpoint holds the place in every stream, a restart goes on
there, and a batch that is repeated reads the same segments. A batch takes what is there;
a stream is a partition of it, or several of at most ``segments`` each.

A segment counts once it has its final name, so write it under another and rename it, and
once all before it are there. Old segments may be removed, but for the last of a stream. Only
names are listed on the driver; segments are read by the tasks, from a folder that all of
them reach (a path, or a URI that pyarrow knows).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from wickflow.functions.kline import INTERVAL, SYMBOLS, stream_names
from wickflow.session import hadoop_path, remove_path

SCHEMA = "stream string, segment bigint, value string"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


class Segments(InputPartition):
    """Segments ``first`` to ``stop - 1`` of a stream."""

    def __init__(self, stream: str, first: int, stop: int):
        self.stream, self.first, self.stop = stream, first, stop


class Reader(DataSourceStreamReader):
    def __init__(self, path: str, streams: list[str], segments: int):
        self.path, self.streams, self.segments = path.rstrip("/"), streams, segments

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.streams, 0)

    def latestOffset(self) -> dict:
        """The end of the unbroken run of segments of each stream."""
        system, root = _opened(self.path)
        ends = {}
        for stream in self.streams:
            chosen = fs.FileSelector(f"{root}/{stream}", allow_not_found=True)
            names = (info.base_name.removesuffix(".jsonl") for info in system.get_file_info(chosen))
            numbers = {int(name) for name in names if name.isdigit()}
            end = min(numbers, default=0)
            while end in numbers:
                end += 1
            ends[stream] = end
        return ends

    def partitions(self, start: dict, end: dict) -> list[Segments]:
        found = []
        for stream, stop in end.items():
            for first in range(start.get(stream, 0), stop, self.segments):
                found.append(Segments(stream, first, min(stop, first + self.segments)))
        return found

    def read(self, partition: Segments) -> Iterator[tuple[str, int, str]]:
        system, root = _opened(self.path)
        for number in range(partition.first, partition.stop):
            with system.open_input_stream(f"{root}/{partition.stream}/{number}.jsonl") as file:
                for line in file.read().decode().splitlines():
                    yield partition.stream, number, line

    def commit(self, end: dict) -> None:
        pass


class Subscription(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kline_subscription"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> Reader:
        streams = [s for s in self.options.get("streams", "").split(",") if s]
        return Reader(self.options["path"], streams, int(self.options.get("segments", "1000")))


def subscribe(
    spark: SparkSession,
    path: str,
    symbols: Iterable[str] = SYMBOLS,
    interval: str = INTERVAL,
    segments: int = 1_000,
) -> DataFrame:
    """The messages of the symbols' streams as they are recorded: stream, segment, value."""
    spark.dataSource.register(Subscription)
    options = {"path": path, "streams": ",".join(stream_names(symbols, interval)), "segments": str(segments)}
    return spark.readStream.format(Subscription.name()).options(**options).load()


def record(messages: DataFrame, path: str) -> int:
    """Records messages (stream, value) as further segments of their streams; their number.

    One recorder at a time: segments are written aside and get the next numbers by renaming.
    """
    spark = messages.sparkSession
    aside = f"{path}/_new-{uuid.uuid4().hex}"
    messages.select("stream", "value").write.partitionBy("stream").text(aside)
    system, root = hadoop_path(spark, aside)
    unescaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    done = 0
    for folder in system.listStatus(root):
        name = folder.getPath().getName()
        if not name.startswith("stream="):
            continue
        stream = unescaped(name.removeprefix("stream="))
        _, target = hadoop_path(spark, f"{path}/{stream}")
        system.mkdirs(target)
        known = (f.getPath().getName().removesuffix(".jsonl") for f in system.listStatus(target))
        number = max((int(n) + 1 for n in known if n.isdigit()), default=0)
        for file in sorted(system.listStatus(folder.getPath()), key=lambda f: f.getPath().getName()):
            if not system.rename(file.getPath(), hadoop_path(spark, f"{path}/{stream}/{number}.jsonl")[1]):
                raise OSError(f"cannot name segment {number} of {stream}")
            number, done = number + 1, done + 1
    remove_path(spark, aside)
    return done
