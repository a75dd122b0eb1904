"""Incremental ingestion with Structured Streaming.

Files are picked up once and restarts resume from the checkpoint. Every sink is
idempotent: a batch that is delivered again leaves the tables as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.names import partition_day, partition_month, partition_year
from barlake.operators.bars import INSTRUMENT, bucket_start, ohlcv_from_trades, trade_order
from barlake.operators.dedupe import dedupe_log, keep_last
from barlake.operators.ingest import log_rows, missing_files
from barlake.operators.lake import (
    append_trades_daily,
    prune_to,
    publish,
    read_trades,
    upsert_bars,
    with_trade_partitions,
    write_partitioned,
)
from barlake.schemas import DOWNLOAD_LOG
from barlake.session import scratch_dir
from barlake.sources.trades import FILE, decode_lines, file_report, rename_trade_fields, whole_lines

BATCH = Callable[[DataFrame, int], None]
LATENESS = "2 hours"


def stream_lines(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """New trade files of a landing folder, decoded line by line; a damaged file is one malformed line.

    A file arrives whole in one batch, so ``store_and_log`` can judge it.
    """
    files = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return decode_lines(whole_lines(reader.load(landing)))


def typed_trades(decoded: DataFrame) -> DataFrame:
    """Typed trades with ``file_name`` and ``feed_venue`` from decoded lines that are sound."""
    venue = F.regexp_extract(FILE, r"^(.+)-[a-z]+-\d{4}-", 1)
    return rename_trade_fields(decoded.filter(~F.col("malformed")), FILE).withColumn("feed_venue", venue)


def stream_trades(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Typed trades of the sound lines, for streams of bars; ``stream_lines`` keeps the others for the sink."""
    return typed_trades(stream_lines(spark, landing, files_per_batch))


def run_available(stream: DataFrame, checkpoint: str, each: BATCH, mode: str = "append") -> StreamingQuery:
    """Process what has arrived, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()
    return query


FAILED = f"{FILE} string, value string, malformed boolean, missing_fields string, batch_id bigint"


def store_and_log(spark: SparkSession, trades_root: str, log_root: str, downloaded_at: str, failed_root: str) -> BATCH:
    """Batch sink of decoded lines: trades of accepted files to their venue-days, then a log row per such file.

    A file with a malformed line or without a required field is rejected whole,
    as in batch mode: its lines go to the quarantine under ``failed_root`` and
    it gets no log row, so it stays on the list of files to fetch.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            report = file_report(batch)
            good = report.filter("accepted").select(FILE)
            sound = typed_trades(batch.join(good, FILE, "left_semi"))
            append_trades_daily(spark, trades_root, sound.drop(FILE))
            counts = sound.groupBy(FILE).agg(F.count(F.lit(1)).alias("trade_count"))
            merge_log(spark, log_root, log_rows(counts.select(FILE), counts, downloaded_at))
            bad = batch.join(report.filter("not accepted").select(FILE, "missing_fields"), FILE)
            (bad.select(FILE, "value", "malformed", "missing_fields")
             .write.mode("overwrite").parquet(f"{failed_root}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    return each


def read_failed(spark: SparkSession, failed_root: str) -> DataFrame:
    """Quarantined lines of rejected files; empty when no batch has run."""
    return _read_or_empty(spark, failed_root, FAILED)


def log_empty_files(spark: SparkSession, log_root: str, landed: DataFrame, downloaded_at: str,
                    failed: DataFrame | None = None) -> None:
    """After a drained run: log the landed files that brought no trades, with a count of 0.

    Files in ``failed`` are not empty and stay unlogged.
    """
    none = spark.createDataFrame([], f"{FILE} string, trade_count bigint")
    quiet = missing_files(landed, read_log(spark, log_root))
    if failed is not None:
        quiet = quiet.join(failed.select(FILE).distinct(), FILE, "left_anti")
    merge_log(spark, log_root, log_rows(quiet, none, downloaded_at))


def _stored_log(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(DOWNLOAD_LOG).option("basePath", root).parquet(root).select(*DOWNLOAD_LOG.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DOWNLOAD_LOG)


def merge_log(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Keep one row per file, the one delivered last; only the touched dates are rewritten."""
    existing = prune_to(_stored_log(spark, root), rows, ["date"]).select(*DOWNLOAD_LOG.names)
    merged = dedupe_log(existing.unionByName(rows))
    stage = scratch_dir(spark, "log")
    write_partitioned(merged, stage, ["date"], ["venue", "timestamp"])
    publish(spark, stage, root, ["date"])


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return dedupe_log(_stored_log(spark, root))


def stream_dedupe(trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One row per transaction among those within the lateness of each other."""
    return (
        trades.withColumn("event_time", F.col("trade_time").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark(["trans_id"])
    )


def stream_ohlcv(trades: DataFrame, interval: str, keys: Sequence[str] = INSTRUMENT,
                 lateness: str = LATENESS) -> DataFrame:
    """Tumbling 1m or 1h bars. Local days are rolled up from hours in batch, for they are not all 24 h."""
    width = {"1m": "1 minute", "1h": "1 hour"}[interval]
    if "event_time" not in trades.columns:
        trades = trades.withColumn("event_time", F.col("trade_time").cast("timestamp")).withWatermark(
            "event_time", lateness
        )
    order = trade_order()
    return (
        trades.groupBy(*keys, F.window("event_time", width))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum(F.col("price") * F.col("volume")).alias("notional"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .select(
            *keys, F.col("window.start").cast("timestamp_ntz").alias("bar"),
            "open", "high", "low", "close", "volume", "trade_count",
            F.try_divide("notional", "volume").alias("vwap"),
        )
    )


def bar_versions(spark: SparkSession, root: str) -> BATCH:
    """Batch sink for updated bars: every version is kept with its batch number.

    A repeated batch replaces its own folder, so it is written once in effect.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return each


def latest_bars(spark: SparkSession, root: str, keys: Sequence[str] = INSTRUMENT) -> DataFrame:
    """The last version of each bar; bars without volume are dropped."""
    versions = spark.read.option("basePath", root).parquet(root).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    rest = [F.col(c) for c in versions.columns if c not in (*keys, "bar", "batch_id")]
    return keep_last(versions, [*keys, "bar"], [F.col("batch_id"), *rest]).drop("batch_id").filter("volume > 0")


def foreach_batch_upsert(spark: SparkSession, root: str, undated_root: str, layout: str = "by_month") -> BATCH:
    """Batch sink: merge bars into their months, and keep those without a date under the number of their batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            upsert_bars(spark, root, batch, layout, quarantine=f"{undated_root}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return each


BAR_PARTITIONS = ["year", "month"]


def correct_late_bars(spark: SparkSession, trades: DataFrame, late: DataFrame, bars_root: str, interval: str,
                      keys: Sequence[str] = INSTRUMENT) -> None:
    """Recompute the bars that late trades fall in, from all stored trades, and merge them.

    ``trades`` is the stored table with the late rows already in it. Where it
    carries the trade partitions, only days that the touched bars reach into are
    read, and only the venue of a late trade where bars are kept by venue: a bar
    of an instrument has trades of every venue. Only the touched months are
    rewritten.
    """
    calendar = ["year", "month", "day"]
    if all(c in trades.columns for c in calendar):
        reach = [0] if interval in ("1m", "1h") else [-1, 0, 1]  # a local day reaches into its neighbours
        near = late.withColumn("_near", F.explode(F.array(*(
            F.col("trade_time") + F.expr(f"INTERVAL {n} DAY") for n in reach))))
        pruned = [c for c in ("feed_venue",) if c in keys and c in late.columns] + calendar
        trades = prune_to(trades, near.withColumns({
            "year": partition_year("_near"), "month": partition_month("_near"), "day": partition_day("_near")}), pruned)
    touched = late.select(
        *[F.col(k).alias(f"_{k}") for k in keys], bucket_start("trade_time", interval).alias("_bar")
    ).distinct()
    months = touched.select(partition_year("_bar").alias("year"), partition_month("_bar").alias("month"))
    same = bucket_start("trade_time", interval) == F.col("_bar")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    fresh = ohlcv_from_trades(trades.join(touched, same, "left_semi"), interval, keys)
    fresh = fresh.withColumns({"year": partition_year("bar"), "month": partition_month("bar")})
    # made once: the stored bars are told from them, and they are written
    made = scratch_dir(spark, "late-bars")
    fresh.write.parquet(made)
    fresh = spark.read.schema(fresh.schema).parquet(made)
    try:
        stored = spark.read.schema(fresh.schema).option("basePath", bars_root).parquet(bars_root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], fresh.schema)
    kept = prune_to(stored, months, BAR_PARTITIONS).join(fresh.select(*keys, "bar"), [*keys, "bar"], "left_anti")
    stage = scratch_dir(spark, "late")
    write_partitioned(kept.select(*fresh.columns).unionByName(fresh), stage, BAR_PARTITIONS, [*keys, "bar"])
    publish(spark, stage, bars_root, BAR_PARTITIONS)


SEEN = "newest timestamp_ntz, batch_id bigint"


def store_with_late(spark: SparkSession, trades_root: str, bars_root: str, late_root: str, interval: str,
                    keys: Sequence[str] = INSTRUMENT, lateness: str = LATENESS) -> BATCH:
    """Batch sink: trades to their venue-days, their bars recomputed, rows behind the watermark kept apart as well.

    The watermark of a batch is the newest trade of the batches before it, less
    the lateness. Late rows are not lost: the bars they fall in are made again
    from all stored trades, as are those of prompt rows. Batches write under
    their number, so a repeated one sees the same watermark and changes nothing.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            seen = _read_or_empty(spark, f"{late_root}/seen", SEEN).filter(F.col("batch_id") < batch_id)
            watermark = seen.agg(F.max("newest") - F.expr(f"INTERVAL {lateness}")).first()[0]
            late = split_late(batch, str(watermark))[1] if watermark else batch.limit(0)
            late.write.mode("overwrite").parquet(f"{late_root}/rows/batch_id={batch_id}")
            batch.agg(F.max("trade_time").alias("newest")).write.mode("overwrite").parquet(f"{late_root}/seen/batch_id={batch_id}")
            append_trades_daily(spark, trades_root, batch)
            placed = with_trade_partitions(batch)
            correct_late_bars(spark, read_trades(spark, trades_root, placed), placed, bars_root, interval, keys)
        finally:
            batch.unpersist()

    return each


def late_rows(spark: SparkSession, late_root: str) -> DataFrame:
    """Rows that came behind the watermark of their batch."""
    return spark.read.option("basePath", f"{late_root}/rows").parquet(f"{late_root}/rows")


def _read_or_empty(spark: SparkSession, root: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def split_late(batch: DataFrame, watermark: str) -> tuple[DataFrame, DataFrame]:
    """Trades at or after the watermark, and the late ones before it."""
    bound = F.lit(watermark).cast("timestamp_ntz")
    return batch.filter(F.col("trade_time") >= bound), batch.filter(F.col("trade_time") < bound)
