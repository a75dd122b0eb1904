"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the operators are tested under.

    On a cluster leave ``master`` unset and let the submit command name it.
    """
    builder = SparkSession.builder.appName("barlake")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for staged tables, under ``spark.checkpoint.dir``.

    That setting names storage every executor can reach. Only a local session
    that leaves it unset falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="spark-barlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a path on the local file system; None on any other."""
    files, place = hadoop_path(spark, path)
    found = files.makeQualified(place).toUri()
    return found.getPath().rstrip("/") if found.getScheme() == "file" else None


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """While a table is opened, its folders are listed in a few tasks a core.

    Spark would take a task for each of up to 10,000 folders, which costs more than
    the listing. The setting is put back at once, as the files are known then.
    """
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)
