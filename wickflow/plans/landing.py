"""Raw sinks, and moving landed files on: append, archive, mark closed dates."""

from __future__ import annotations

import datetime as dt
import uuid
import warnings
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickflow.operators.partitions import closed_partitions
from wickflow.schemas import RAW_CANDLES, RAW_COLUMNS, RAW_PARTITIONS
from wickflow.session import configure, hadoop_path, path_exists, remove_path
from wickflow.sources import index
from wickflow.sources.raw import (
    HIVE_FILE_PATTERN,
    NANO_CANDLES,
    RAW_FILE_PATTERN,
    inventory,
    nanos_session,
    nanos_to_micros,
    raw_files,
    with_start_date,
)

PARTITION_SCHEMA = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)


# What landing has taken: a file as it was, whom it replaces and where its rows went.
LEDGER = (
    "file string, length bigint, modified timestamp, path string, exchange string, symbol string, date date, "
    "unit string, job string, batch string, run string"
)
DELIVERY = ["file", "length", "modified"]


class Landed(NamedTuple):
    """Files landed and archived by a run, and those it could not move, with the reason."""

    landed: int
    archived: int
    failed: list[str]


def write_batch(
    dated: DataFrame,
    path: str,
    batch: str | Column,
    write: str | None = None,
    unit: Column | None = None,
    job: Column | None = None,
) -> None:
    """Writes rows into the raw table as the batch of that name, and into its index.

    Writing a batch again replaces it and nothing else, so a repeated micro-batch
    leaves no copies. Rows are rebalanced by partition: a file each while small.
    Several batches may be written at once; ``write`` then names the index entries, which
    carry ``unit`` and ``job`` of a delivery.
    """
    spark = dated.sparkSession
    named = F.lit(batch) if isinstance(batch, str) else batch
    of_unit = {} if unit is None else {"unit": unit, "job": job}
    rows = dated.select(*RAW_COLUMNS, "date", named.alias("batch"), *(c.alias(k) for k, c in of_unit.items())).persist()
    try:
        if rows.isEmpty():
            return
        index.ensure_index(spark, path)
        (
            rows.select(*RAW_COLUMNS, "date", "batch")
            .hint("rebalance", *RAW_PARTITIONS, "batch")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*RAW_PARTITIONS, "batch")
            .parquet(path)
        )
        index.record(index.entries(rows, *(F.col(k) for k in of_unit)), path, write or str(batch))
    finally:
        rows.unpersist()


def append_raw(candles: DataFrame, path: str) -> None:
    """Appends candles to the raw table, under the date they start on."""
    write_batch(with_start_date(candles), path, f"append-{uuid.uuid4().hex}")


def stream_batch(spark: SparkSession, checkpoint: str, number: int) -> str:
    """Name of a micro-batch: the same when it is repeated, another for a new checkpoint."""
    stream = spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
    return f"stream-{stream}-{number}"


# Files that ``ingest`` or ``append_raw`` wrote; a job names all its files alike.
NAMED_FILE = r"exchange=([^/]+)/symbol=([^/]+)/date=(\d{4}-\d{2}-\d{2})/(?:batch=([^/]+)/)?([^/]+)\.parquet$"
PART_FILE = r"^part-(\d+)-([0-9a-f]{8}-[0-9a-f-]{27})"


def deliveries(files: DataFrame, named_folders: bool) -> DataFrame:
    """Files with the unit they deliver, the job that delivers it, and the batch of their rows.

    With ``named_folders`` a unit is what one batch wrote into one partition, and its jobs
    are the times it did; each part is a batch of the raw table, so parts may arrive one by
    one. Otherwise a unit is a path, and each version of the file a job.
    """
    path = F.col("path")
    stem = F.regexp_extract(path, r"([^/]+)\.parquet$", 1)
    version = F.concat_ws("-", "length", F.unix_micros("modified"))
    plain = F.concat(F.lit("file-"), stem, F.lit("-"), F.lower(F.hex(F.xxhash64("path"))))
    if not named_folders:
        none = F.lit(None).cast("string")
        return files.select(
            *DELIVERY,
            "path",
            *(none.alias(c) for c in ("exchange", "symbol")),
            none.cast("date").alias("date"),
            path.alias("unit"),
            version.alias("job"),
            F.concat(plain, F.lit("."), version).alias("batch"),
        )
    part, job = F.regexp_extract(stem, PART_FILE, 1), F.regexp_extract(stem, PART_FILE, 2)
    found = files.filter(path.rlike(NAMED_FILE)).withColumns(
        {
            **{c: _unescaped(F.regexp_extract(path, NAMED_FILE, i + 1)) for i, c in enumerate(RAW_PARTITIONS)},
            "producer": _unescaped(F.regexp_extract(path, NAMED_FILE, 4)),
        }
    )
    written = (F.col("producer") != "") & (job != "")
    return found.select(
        *DELIVERY,
        "path",
        "exchange",
        "symbol",
        F.to_date("date").alias("date"),
        F.when(written, F.regexp_replace(path, r"/[^/]+$", "")).otherwise(path).alias("unit"),
        F.when(written, job).otherwise(version).alias("job"),
        F.when(written, F.concat_ws(".", "producer", F.left(job, F.lit(8)), part))
        .otherwise(F.concat(plain, F.lit("."), version))
        .alias("batch"),
    )


def _unescaped(value: Column) -> Column:
    """A partition value as it was before Spark escaped it in a path."""
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What was landed so far."""
    path = f"{checkpoint}/ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def land_files(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    archive: str,
    named_folders: bool = False,
    max_files: int = 10_000,
    skip_corrupt: bool = False,
    nanoseconds: bool = False,
) -> Landed:
    """Lands every delivery under ``landing`` in the raw table, then archives its file.

    A delivery is a file with its length and time of modification; the ledger under
    ``checkpoint`` holds those landed. A file that comes again under an old name, or a
    batch written again, is a new delivery of the same unit, and takes the place of the
    older one's rows wherever that has gone. A run that died is repeated without harm:
    rows are written under the delivery's own batch, and the ledger after them.

    Folders are ``exchange/symbol/date``, or ``exchange=/symbol=/date=`` with
    ``named_folders``, as ``ingest`` writes them. ``nanoseconds`` takes files with
    timestamps in nanoseconds. Files are taken ``max_files`` at a time, oldest first.

    A file is archived only when rows of it are in the raw table. One that cannot
    be read stops the run; with ``skip_corrupt`` the others go on, while it stays
    in ``landing``, so its partition is never marked closed. The same goes for a
    file without rows. Move such files away to close the date. One that cannot be moved
    does not stop the others either; it is reported, and moved by a later run.
    """
    configure(spark)
    session = nanos_session(spark) if nanoseconds else spark
    candles = NANO_CANDLES if nanoseconds else RAW_CANDLES
    kind = ", ".join(LEDGER.split(", ")[:-1])
    moved, failed = archive_files(spark, landing, checkpoint, archive)  # of a run that died
    waiting = deliveries(raw_files(spark, landing), named_folders)
    waiting = waiting.join(ledger(spark, checkpoint).select(*DELIVERY), DELIVERY, "left_anti")
    landed = 0
    for chosen in _chunks(waiting.orderBy("modified", "file").toLocalIterator(), max_files):
        run = uuid.uuid4().hex
        taken = F.broadcast(spark.createDataFrame(chosen, kind))  # at most max_files rows
        read = session.read.schema(candles).option("ignoreCorruptFiles", str(skip_corrupt).lower())
        rows = nanos_to_micros(read.parquet(*(r.path for r in chosen)).select(*RAW_COLUMNS, F.col("_metadata.file_path").alias("file")))
        rows = with_start_date(rows).join(taken.drop("length", "modified", "path").withColumnsRenamed(
            {c: f"{c}_of_folder" for c in RAW_PARTITIONS}), "file")
        rows = rows.withColumns({c: F.coalesce(f"{c}_of_folder", c) for c in RAW_PARTITIONS}).persist()
        write_batch(rows, raw_path, F.col("batch"), f"land-{run}", F.col("unit"), F.col("job"))
        done = taken.join(rows.select("file").distinct(), "file", "left_semi")
        counted = Observation()
        done.observe(counted, F.count(F.lit(1)).alias("files")).write.mode("overwrite").parquet(f"{checkpoint}/ledger/run={run}")
        landed += counted.get["files"]
        rows.unpersist()
        remove_replaced(spark, raw_path)
    again, failed = archive_files(spark, landing, checkpoint, archive)
    if failed:
        warnings.warn(f"{len(failed)} landed files could not be moved: {failed[:5]}", stacklevel=2)
    return Landed(landed, moved + again, failed)


def _chunks(rows: Iterable[Row], size: int) -> Iterator[list[Row]]:
    rows = iter(rows)
    while chunk := list(islice(rows, size)):
        yield chunk


def remove_replaced(spark: SparkSession, raw_path: str) -> int:
    """Removes the rows of deliveries that came again since, and says so in the index.

    The newer rows are there already. Folders are named one by one, as few come again.
    """
    found = index.stale(spark, raw_path)
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    gone = []
    for row in found.toLocalIterator():
        folder = "/".join(f"{c}={escaped(str(row[c]))}" for c in index.BATCH)
        remove_path(spark, f"{raw_path}/{folder}")
        gone.append(row)
    if gone:
        removed = spark.createDataFrame(gone, found.schema).withColumns(
            {"n_rows": F.lit(0).cast("long"), "written": F.current_timestamp()}
        )
        index.record(removed.drop("write"), raw_path, f"removed-{uuid.uuid4().hex}")
    return len(gone)


def archive_files(spark: SparkSession, landing: str, checkpoint: str, archive: str) -> tuple[int, list[str]]:
    """Moves the files under ``landing`` that the ledger names below ``archive``.

    Moves are requests to the file system, made one by one as the names arrive. A name
    that is taken gets the time of modification added, so nothing archived is replaced.
    Returns how many were moved, and which were not.
    """
    taken = ledger(spark, checkpoint).select(*DELIVERY).distinct()
    if not path_exists(spark, landing):
        return 0, []
    files = raw_files(spark, landing).join(taken, DELIVERY, "left_semi")
    jvm = spark._jvm
    moved, failed = 0, []
    for row in files.select("file", F.unix_millis("modified").alias("at")).toLocalIterator():
        source = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.file))
        target = archive + source.toUri().getPath()
        try:
            system, path = hadoop_path(spark, target)
            if system.exists(path):
                target = f"{target.removesuffix('.parquet')}.{row.at}-{uuid.uuid4().hex[:8]}.parquet"
                path = jvm.org.apache.hadoop.fs.Path(target)
            system.mkdirs(path.getParent())
            if not system.rename(source, path):
                raise OSError("the file system refuses")
            moved += 1
        except Exception as error:  # from the file system, as any kind of Java exception
            failed.append(f"{row.file} to {target}: {error}")
    return moved, failed


def closed_table(spark: SparkSession, path: str) -> DataFrame:
    """The partitions marked closed so far; none when the table does not exist yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PARTITION_SCHEMA)
    return spark.read.schema(PARTITION_SCHEMA).parquet(path)


def mark_closed(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    closed_path: str,
    as_of: dt.date | str | None = None,
    named_folders: bool = False,
) -> int:
    """Marks partitions of past dates that have no file left in ``landing``.

    Which there are says the raw table's index. A partition is marked once.
    Returns how many were marked now.
    """
    configure(spark)
    pattern = HIVE_FILE_PATTERN if named_folders else RAW_FILE_PATTERN
    marked = Observation()
    (
        closed_partitions(
            index.partition_index(spark, raw_path),
            inventory(raw_files(spark, landing), pattern),
            closed_table(spark, closed_path),
            as_of,
        )
        .hint("rebalance")
        .observe(marked, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .parquet(closed_path)
    )
    return marked.get["rows"]


def land_archive_mark(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    archive: str,
    closed_path: str,
    as_of: dt.date | str | None = None,
    named_folders: bool = False,
    skip_corrupt: bool = False,
    nanoseconds: bool = False,
) -> int:
    """One landing run: move files on, archive them, mark what is now closed."""
    land_files(
        spark,
        landing,
        raw_path,
        checkpoint,
        archive,
        named_folders,
        skip_corrupt=skip_corrupt,
        nanoseconds=nanoseconds,
    )
    return mark_closed(spark, landing, raw_path, closed_path, as_of, named_folders)
