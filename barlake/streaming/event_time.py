"""Streams that close by event time: sessions, local days, a file log with its empty files, and cool-downs.

All run in append mode: a row leaves when the watermark has passed what could
still change it, and the state behind it goes. What comes later than the lateness
is dropped by the stream and counted; ``store_with_late`` is the sink that takes
such rows up again. A watermark moves with the data, so the last windows of a feed
close when its next rows, or a closing mark, arrive.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.names import parse_trade_filename
from barlake.operators.bars import INSTRUMENT, trade_order
from barlake.operators.registry import COOLDOWN_DAYS
from barlake.streaming.trades import merge_log

LATENESS = "2 hours"


def late_count(query: StreamingQuery) -> int:
    """Rows that the stateful operators of the query's last batches dropped as too late."""
    return sum(op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators)


def most_state(query: StreamingQuery) -> int:
    """The most rows that the query's state held after one of its last batches."""
    return max((sum(op.numRowsTotal for op in progress.stateOperators) for progress in query.recentProgress), default=0)


# ---------------------------------------------------------------- sessions


def stream_sessions(trades: DataFrame, minutes: int, lateness: str = LATENESS) -> DataFrame:
    """Closed runs of trades of a venue within a day, without a silence longer than ``minutes``.

    State is one row per open run. Runs that a late trade bridges are merged while open.
    """
    timed = trades.select("feed_venue", F.col("trade_time").cast("timestamp").alias("event_time")).withWatermark("event_time", lateness)
    day = F.date_trunc("day", "event_time").alias("day")
    # a session ends that long after its last trade, and one that begins exactly then is the same
    return (timed.groupBy("feed_venue", day, F.session_window("event_time", f"{minutes} minutes"))
            .agg(F.min("event_time").alias("first"), F.max("event_time").alias("last"), F.count(F.lit(1)).alias("trade_count"))
            .select("feed_venue", F.to_date("day").alias("day"), F.col("first").cast("timestamp_ntz").alias("first"),
                    F.col("last").cast("timestamp_ntz").alias("last"), "trade_count"))


def gaps_between(sessions: DataFrame) -> DataFrame:
    """The silences between the sessions of a venue-day: as ``session_gaps`` finds them from trades."""
    order = Window.partitionBy("feed_venue", "day").orderBy("first")
    seconds = F.timestamp_diff("MICROSECOND", F.col("gap_start"), F.col("first")) / 1_000_000
    return (sessions.withColumn("gap_start", F.lag("last").over(order)).filter(F.col("gap_start").isNotNull())
            .select("feed_venue", "day", "gap_start", F.col("first").alias("gap_end"), seconds.alias("gap_seconds")))


# -------------------------------------------------------------- local days


def stream_local_days(trades: DataFrame, market_zone: str, keys: Sequence[str] = INSTRUMENT, lateness: str = LATENESS) -> DataFrame:
    """Bars of market-local days, from hours that close first: two windows, one on the other.

    The event time is the clock on the wall of the market, so a day is a plain
    window of 24 of its hours also where the clock is set. Once a year that clock
    goes back by an hour, so the lateness must be more than that. Hours carry the
    order of their first and last trade, and days take open and close by it. State
    is one row per open hour and open day of an instrument.
    """
    if _hours(trades.sparkSession, lateness) <= 1:
        raise ValueError("a lateness of more than an hour is needed where clocks are set back")
    order = trade_order()
    local = F.from_utc_timestamp(F.col("trade_time").cast("timestamp"), market_zone)
    timed = trades.withColumn("event_time", local).withWatermark("event_time", lateness)
    priced = F.col("price").isNotNull()
    hours = timed.groupBy(*keys, F.window("event_time", "1 hour").alias("hour")).agg(
        F.min_by("price", F.when(priced, order)).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", F.when(priced, order)).alias("close"), F.sum(F.when(priced, F.col("volume"))).alias("volume"),
        F.sum(F.col("price") * F.col("volume")).alias("notional"), F.count("price").alias("trade_count"),
        F.min(F.when(priced, order)).alias("first"), F.max(F.when(priced, order)).alias("last"))
    days = hours.withColumn("closed", F.window_time("hour")).groupBy(*keys, F.window("closed", "1 day").alias("day")).agg(
        F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "last").alias("close"), F.sum("volume").alias("volume"), F.sum("notional").alias("notional"),
        F.sum("trade_count").alias("trade_count"))
    return days.filter("volume > 0").select(
        *keys, F.col("day.start").cast("timestamp_ntz").alias("bar"), "open", "high", "low", "close", "volume", "trade_count",
        F.try_divide("notional", "volume").alias("vwap"))


def _hours(spark: SparkSession, lateness: str) -> float:
    seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '2000-01-01'"), F.expr(f"TIMESTAMP_NTZ '2000-01-01' + INTERVAL {lateness}"))
    return spark.range(1).select(seconds).first()[0] / 3600


# ----------------------------------------------------------------- file log


def file_minute(file_name: str):
    """The minute that a trade file is named after, as its event time; null for another name."""
    return F.to_timestamp(parse_trade_filename(file_name)["minute"], "yyyy-MM-dd'T'HH_mm")


def stream_file_counts(listings: DataFrame, trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """(file_name, trade_count) of every listed file, 0 for one without trades when the watermark has passed its minute.

    ``listings`` and ``trades`` have ``file_name``; a file is listed once. Counts
    close with the minute of their file and are joined to the listing of the same
    minute, so both sides keep only files within the lateness.
    """
    minute = file_minute("file_name")
    listed = listings.select("file_name", minute.alias("listed_at")).withWatermark("listed_at", lateness)
    timed = trades.select(F.col("file_name").alias("counted"), minute.alias("file_time")).withWatermark("file_time", lateness)
    counts = (timed.groupBy("counted", F.window("file_time", "1 minute")).agg(F.count(F.lit(1)).alias("trade_count"))
              .withColumn("counted_at", F.window_time("window")).select("counted", "counted_at", "trade_count"))
    near = (F.col("file_name") == F.col("counted")) & (F.col("counted_at") >= F.col("listed_at")) & (
        F.col("counted_at") < F.col("listed_at") + F.expr("INTERVAL 1 MINUTE"))
    return listed.join(counts, near, "left").select("file_name", F.coalesce("trade_count", F.lit(0)).alias("trade_count"))


def log_counts(spark: SparkSession, log_root: str, downloaded_at: str):
    """Batch sink of ``stream_file_counts``: a log row per file, empty ones with 0."""
    from barlake.operators.ingest import log_rows

    def each(batch: DataFrame, batch_id: int) -> None:
        merge_log(spark, log_root, log_rows(batch.select("file_name"), batch, downloaded_at))

    return each


# ---------------------------------------------------------------- cool-downs


def status_changes(outcomes: DataFrame, lateness: str = "0 seconds", days: int = COOLDOWN_DAYS) -> DataFrame:
    """Changes of status from outcomes (ticker, interval, found, at): active, not_found, and eligible again after the cool-down.

    An outcome is told in the batch that brings it, and once however often it is
    delivered within the lateness. A cool-down is a session: an outcome that was
    not found holds it open for ``days`` less a microsecond, a found one for no
    longer than its moment, so outcomes within a cool-down are merged with it and
    one at its very end is not. Where the last outcome of a closed session was not
    found, the ticker is eligible from the end of the wait. State is the outcomes
    within the lateness and one row per open session.
    """
    timed = outcomes.select("ticker", "interval", F.coalesce("found", F.lit(False)).alias("found"),
                            F.col("at").cast("timestamp").alias("event_time")).withWatermark("event_time", lateness)
    told = timed.dropDuplicates(["ticker", "interval", "event_time", "found"]).select(
        "ticker", "interval", F.col("event_time").alias("at"), F.when(F.col("found"), "active").otherwise("not_found").alias("status"))
    wait = days * 24 * 60 * 60
    held = F.when(F.col("found"), "1 microsecond").otherwise(f"{wait - 1}.999999 seconds")
    ended = timed.groupBy("ticker", "interval", F.session_window("event_time", held)).agg(
        F.max(F.struct("event_time", "found")).alias("last"))  # of one time a found outcome is the last
    over = F.timestamp_micros(F.unix_micros("last.event_time") + wait * 1_000_000)
    return told.unionByName(ended.filter(~F.col("last.found")).select("ticker", "interval", over.alias("at"), F.lit("eligible").alias("status")))


def current_status(changes: DataFrame) -> DataFrame:
    """The last change of each ticker and interval; of one time, the one that ends a cool-down comes first, a found outcome last."""
    last = F.max_by(F.struct("at", "status"), F.struct("at", F.col("status") != "eligible", F.col("status") == "active"))
    return changes.groupBy("ticker", "interval").agg(last.alias("last")).select("ticker", "interval", "last.at", "last.status")


@contextmanager
def timers(spark: SparkSession):
    """Settings of cool-downs, which count when a query starts and are put back.

    The state store is the one on disk, so open cool-downs need not fit in memory. Each
    of its partitions is written in every batch however little it holds, so there
    are no more of them than two for a core.
    """
    partitions = "spark.sql.shuffle.partitions"
    settings = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                partitions: str(min(int(spark.conf.get(partitions)), 2 * spark.sparkContext.defaultParallelism))}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
