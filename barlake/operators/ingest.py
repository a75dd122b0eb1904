"""What to fetch, what is complete, and how a run went."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.names import file_date, parse_trade_filename


def files_for_date(manifest: DataFrame, date: str) -> DataFrame:
    return manifest.filter(file_date("file_name") == date)


def _with_key(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("_p", parse_trade_filename("file_name")).select(
        *manifest.columns,
        F.col("_p.venue").alias("_venue"), F.col("_p.date").alias("_date"), F.col("_p.minute").alias("_minute"),
    )


UNPARSED = "unparsed"


def _with_log_key(manifest: DataFrame) -> DataFrame:
    """As ``_with_key``; a name that cannot be parsed is its own key, under the date ``unparsed``."""
    odd = F.col("_date").isNull() | F.col("_minute").isNull() | F.col("_venue").isNull()
    return _with_key(manifest).withColumn("_odd", odd).withColumns({
        "_venue": F.when(~F.col("_odd"), F.col("_venue")).otherwise(F.lit("")),
        "_date": F.when(~F.col("_odd"), F.col("_date")).otherwise(F.lit(UNPARSED)),
        "_minute": F.when(~F.col("_odd"), F.col("_minute")).otherwise(F.col("file_name")),
    }).drop("_odd")


def missing_files(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files without a log row for their venue and minute, or for their name if it cannot be parsed.

    The log alone decides; minutes of stored trades do not, as a file carries
    trades of earlier minutes.
    """
    done = log.select(
        F.col("venue").alias("_venue"), F.col("date").alias("_date"), F.col("timestamp").alias("_minute")
    )
    return _with_log_key(manifest).join(done, ["_venue", "_date", "_minute"], "left_anti").select(*manifest.columns)


def missing_dates(manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """Every listed venue-date, ``missing`` when nothing is stored, else ``recheck``.

    Stored dates are listed again because a date may be stored in part.
    """
    listed = _with_key(manifest).filter(F.col("_date").isNotNull()).select(
        F.col("_venue").alias("venue"), F.col("_date").alias("date")
    ).distinct()
    have = stored.select("venue", "date").distinct().withColumn("_have", F.lit(True))
    return listed.join(have, ["venue", "date"], "left").select(
        "venue", "date", F.when(F.col("_have"), "recheck").otherwise("missing").alias("status")
    )


def download_completeness(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """Per venue and date: listed and logged files; complete when every listed one is logged."""
    listed = _with_key(manifest).filter(F.col("_date").isNotNull()).select(
        F.col("_venue").alias("venue"), F.col("_date").alias("date"), F.col("_minute").alias("timestamp"),
        F.lit(1).alias("_listed"), F.lit(0).alias("_logged"), F.lit(False).alias("_data"),
    )
    logged = log.filter(F.col("date") != UNPARSED).select(
        "venue", "date", "timestamp", F.lit(0).alias("_listed"), F.lit(1).alias("_logged"),
        F.coalesce("has_data", F.lit(False)).alias("_data"),
    )
    per_file = listed.unionByName(logged).groupBy("venue", "date", "timestamp").agg(
        F.max("_listed").alias("_listed"), F.max("_logged").alias("_logged"), F.bool_or("_data").alias("_data")
    )
    return (
        per_file.groupBy("venue", "date")
        .agg(
            F.sum("_listed").cast("bigint").alias("listed_files"),
            F.sum(F.col("_listed") * F.col("_logged")).cast("bigint").alias("logged_files"),
            F.bool_or("_data").alias("has_data"),
        )
        .withColumn(
            "status",
            F.when(F.col("logged_files") == F.col("listed_files"), "complete")
            .when(F.col("logged_files") > 0, "partial").otherwise("missing"),
        )
    )


def months_ready(completeness: DataFrame) -> DataFrame:
    """Venue-months with at least one date that holds data."""
    return (
        completeness.filter("has_data")
        .groupBy("venue", F.substring("date", 1, 7).alias("month"))
        .agg(F.count(F.lit(1)).alias("dates_with_data"))
    )


def log_rows(manifest: DataFrame, counts: DataFrame, downloaded_at: str) -> DataFrame:
    """One log row per listed file, empty files included (count 0)."""
    return _with_log_key(manifest).join(counts, "file_name", "left").select(
        F.col("_venue").alias("venue"), F.col("_date").alias("date"), F.col("_minute").alias("timestamp"),
        (F.coalesce("trade_count", F.lit(0)) > 0).alias("has_data"),
        F.coalesce("trade_count", F.lit(0)).cast("bigint").alias("trade_count"),
        F.lit(downloaded_at).cast("timestamp_ntz").alias("downloaded_at"),
    )


def ingest_run_summary(run: DataFrame, trades: DataFrame) -> DataFrame:
    """Per venue: dates by outcome, files, trades and instruments of one run.

    ``run`` holds the completeness of each date before (``logged_before``) and
    after (``logged_files``) the run.
    """
    fetched = F.col("logged_files") > F.col("logged_before")
    complete = F.col("logged_files") == F.col("listed_files")
    dates = run.groupBy("venue").agg(
        F.count(F.lit(1)).alias("dates_checked"),
        F.count_if(fetched & complete).alias("dates_fetched"),
        F.count_if(fetched & ~complete).alias("dates_partial"),
        F.count_if(~fetched).alias("dates_skipped"),
        F.sum(F.col("logged_files") - F.col("logged_before")).alias("files"),
    )
    counts = trades.groupBy(F.col("feed_venue").alias("venue")).agg(
        F.count(F.lit(1)).alias("trades"), F.count_distinct("isin").alias("isins")
    )
    return dates.join(counts, "venue", "left").na.fill(0, ["trades", "isins"])


def traded_isins(trades: DataFrame) -> DataFrame:
    return trades.select(F.col("feed_venue").alias("venue"), "isin").distinct()


def sequence_in_file(trades: DataFrame) -> DataFrame:
    """Add ``sequence``: the position of a trade in its file by time, then tick id.

    A file holds one venue-minute, so the ordered group is small.
    """
    order = Window.partitionBy("file_name").orderBy("trade_time", "tick_id")
    return trades.withColumn("sequence", F.row_number().over(order).cast("bigint") - 1)
