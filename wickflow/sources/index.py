"""The partition index of a raw table: what each (exchange, symbol, date) holds.

Every write adds an entry for each partition and batch that it wrote, in a folder of its
own below ``_partitions``, which Spark's listings of the table skip. A repeated write
replaces its entries. Of several entries of a partition and batch the latest counts, and
one without rows says that they were removed. So dates are chosen and marked without
listing the table or opening a file of it.

A delivery that comes again is another ``job`` of the same ``unit``; ``stale`` names the
batches of all but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.schemas import RAW_PARTITIONS
from wickflow.session import path_exists, remove_path
from wickflow.sources.raw import raw_table

FOLDER = "_partitions"
BATCH = [*RAW_PARTITIONS, "batch"]
ENTRIES = (
    "exchange string, symbol string, date date, batch string, unit string, job string, n_rows bigint, "
    "first_start timestamp, last_close_time timestamp, last_close double, written timestamp, write string"
)


def entries(rows: DataFrame, unit: Column | None = None, job: Column | None = None) -> DataFrame:
    """An entry for each partition and batch of ``rows`` (raw columns, date, batch)."""
    return (
        rows.withColumns(
            {"unit": F.col("batch") if unit is None else unit, "job": F.lit("") if job is None else job}
        )
        .groupBy(*BATCH, "unit", "job")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("candle_start_time").alias("first_start"),
            F.max("candle_close_time").alias("last_close_time"),
            F.max_by("close", "candle_close_time").alias("last_close"),
        )
        .withColumn("written", F.current_timestamp())
    )


def record(found: DataFrame, path: str, write: str) -> None:
    """Keeps the entries under the name of a write."""
    found.hint("rebalance").write.mode("overwrite").parquet(f"{path}/{FOLDER}/write={write}")


def has_index(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{FOLDER}")


def all_entries(spark: SparkSession, path: str) -> DataFrame:
    """Every entry; none where the table does not exist."""
    if not has_index(spark, path):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(f"{path}/{FOLDER}")


def latest_entries(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of each partition and batch, also of those whose rows are gone."""
    found = all_entries(spark, path)
    others = [c for c in found.columns if c not in BATCH]
    latest = F.max_by(F.struct(*others), F.struct("written", "write")).alias("latest")
    return found.groupBy(*BATCH).agg(latest).select(*BATCH, "latest.*")


def live_entries(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of each partition and batch that has rows."""
    return latest_entries(spark, path).filter("n_rows > 0")


def partition_index(spark: SparkSession, path: str) -> DataFrame:
    """exchange, symbol, date, n_rows, n_batches, first_start, last_close_time, last_close, and
    when it ``changed``, of each partition that has rows.

    A table that has rows but no index is read once instead.
    """
    if has_index(spark, path) or not path_exists(spark, path):
        found = latest_entries(spark, path)
    else:
        found = entries(raw_table(spark, path).withColumn("batch", F.lit("")))
    held = F.col("n_rows") > 0
    return (
        found.groupBy(*RAW_PARTITIONS)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.count_if(held).alias("n_batches"),
            F.min(F.when(held, F.col("first_start"))).alias("first_start"),
            F.max(F.when(held, F.col("last_close_time"))).alias("last_close_time"),
            F.max_by(F.when(held, F.col("last_close")), F.when(held, F.col("last_close_time"))).alias("last_close"),
            F.max("written").alias("changed"),
        )
        .filter("n_rows > 0")
    )


def ensure_index(spark: SparkSession, path: str) -> None:
    """Indexes a table that was written without, so that later entries add to a whole one."""
    if path_exists(spark, path) and not has_index(spark, path):
        record(entries(raw_table(spark, path, batches=True)), path, "rebuilt")


def stale(spark: SparkSession, path: str) -> DataFrame:
    """Entries of deliveries that came again since."""
    found = live_entries(spark, path)
    last = found.groupBy("unit").agg(F.max_by("job", F.struct("written", "write")).alias("last_job"))
    return found.join(last, "unit").filter("job <> last_job").drop("last_job")


def compact_index(spark: SparkSession, path: str) -> None:
    """Writes the live entries of all writes as those of one. Readers meanwhile see entries
    twice, which changes nothing."""
    merged = [r.write for r in all_entries(spark, path).select("write").distinct().collect()]
    record(latest_entries(spark, path).drop("write"), path, f"merged-{uuid.uuid4().hex}")
    for write in merged:
        remove_path(spark, f"{path}/{FOLDER}/write={write}")
