"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings to start a session with; they cannot be changed later. The feature
# plan has more generated classes than Spark's default cache holds (100), and a
# cache too small would have every task compile all of them again.
STATIC_SETTINGS = {"spark.sql.codegen.cache.maxEntries": "2000"}


def with_static_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in STATIC_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC: every date and hour here is a UTC one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach.

    It is the one ``spark.checkpoint.dir`` names, else the context's checkpoint
    folder. Only a local session may go without both; it then gets a temporary
    folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wickflow-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, for a table written mid-job.

    Later stages read it lazily, so it is left to the folder's clean-up.
    """
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as an object of it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    system, found = hadoop_path(spark, path)
    return system.exists(found)


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a folder with all in it, or a file; nothing happens where there is none."""
    system, found = hadoop_path(spark, path)
    system.delete(found, True)
