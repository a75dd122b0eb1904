"""Checksums of stored bars by file, ticker and month, kept so that a check reads changed files only.

A checksum is a sum of row hashes, so those of files add up to months, and months
to tickers. Stored files are never changed in place: a file of the same path,
size and time holds the same rows, and what the ledger says of it stays true.
Whatever wrote, replaced or removed files need not know of the ledger.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.audit import row_hash
from barlake.operators.lake import PRUNED_PARTITIONS
from barlake.schemas import BARS

FILE = ["file", "size", "modified"]
LEDGER = "file STRING, size BIGINT, modified TIMESTAMP, stock STRING, month DATE, rows BIGINT, checksum DECIMAL(38,0)"


def _file_columns() -> list[Column]:
    return [F.col(f"_metadata.{m}").alias(c) for m, c in zip(
        ("file_path", "file_size", "file_modification_time"), FILE)]


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and time of the parquet files below a root; nothing is opened. An absent root has none."""
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER).select(*FILE)
    return files.select(*_file_columns())


def read_ledger(spark: SparkSession, ledger: str, present: DataFrame | None = None) -> DataFrame:
    """What the ledger knows, or knows of the ``present`` files. Two runs at the same time may write a file twice; it counts once.

    The files, a row each, are broadcast, and others go before the grouping. Rows
    are dealt by ticker and month, so that sums over those need no second shuffle.
    """
    try:
        stored = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    if present is not None:
        stored = stored.join(F.broadcast(present), FILE, "left_semi").repartition("stock", "month")
    return stored.groupBy(*FILE, "stock", "month").agg(F.max("rows").alias("rows"), F.max("checksum").alias("checksum"))


def unread_files(spark: SparkSession, root: str, ledger: str) -> DataFrame:
    """Files below the root that the ledger does not know as they are now."""
    return listed_files(spark, root).join(read_ledger(spark, ledger).select(*FILE).distinct(), FILE, "left_anti")


def file_checksums(bars: DataFrame) -> DataFrame:
    """Rows and content checksum per file, ticker and month of stored bars.

    Bars without a date count in a month that is null. File columns are those of
    the file the rows were read from, whatever a listing said before.
    """
    named = bars.select(*_file_columns(), *BARS.names)
    return named.groupBy(*FILE, "stock", F.trunc(F.to_date("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_hash(BARS.names).cast("decimal(20,0)")).cast("decimal(38,0)").alias("checksum"),
    )


def refresh_ledger(spark: SparkSession, root: str, ledger: str) -> DataFrame:
    """Read the files the ledger does not know, add them, and return the rows of all present files.

    Up to ``PRUNED_PARTITIONS`` unread files become a literal filter on the file
    path, which leaves the others unopened; more, as in a first run, are joined.
    Files that are gone stay in the ledger and count no more.
    """
    unread = unread_files(spark, root, ledger).select("file")
    names = [r[0] for r in unread.limit(PRUNED_PARTITIONS + 1).collect()]
    if names:
        bars = spark.read.schema(BARS).option("recursiveFileLookup", "true").parquet(root)
        if len(names) > PRUNED_PARTITIONS:
            found = file_checksums(bars).join(unread, "file", "left_semi")
        else:
            found = file_checksums(bars.filter(F.col("_metadata.file_path").isin(names)))
        found.write.mode("append").option("compression", "zstd").parquet(ledger)
    return read_ledger(spark, ledger, listed_files(spark, root))


def _sides(flat: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and checksums of both ledgers in one grouping; a side without rows has neither."""
    # each side is summed by itself first, where its rows are
    sums = [F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum")]
    flat, stored = (side.groupBy("stock", "month").agg(*sums).withColumn("_side", F.lit(n)) for n, side in ((1, flat), (2, stored)))
    tagged = flat.unionByName(stored)

    def total(side: int, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_side") == side, F.col(name))), F.lit(0))

    verdict = (
        F.when(F.col("flat_rows") != F.col("stored_rows"), "row_count_mismatch")
        .when(F.col("_flat") != F.col("_stored"), "checksum_mismatch")
        .otherwise("ok")
    )
    return tagged.groupBy(*keys).agg(
        total(1, "rows").alias("flat_rows"), total(2, "rows").alias("stored_rows"),
        total(1, "checksum").alias("_flat"), total(2, "checksum").alias("_stored"),
    ).select(*keys, "flat_rows", "stored_rows", verdict.alias("verdict"))


def verify_ledgers(flat: DataFrame, stored: DataFrame) -> DataFrame:
    """``audit.verify_copies`` out of two ledgers: no bar is read."""
    return _sides(flat, stored, ["stock"])


def differing_months(flat: DataFrame, stored: DataFrame) -> DataFrame:
    """The ticker-months whose rows differ: what a repair has to copy again."""
    return _sides(flat, stored, ["stock", "month"]).filter(F.col("verdict") != "ok")
