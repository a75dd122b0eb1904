"""Published coverage and activity reports over bars and trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.calendar import hhmm, minute_floor, minute_of_day

# Status labels of the reports.
COMPLETE, PARTIAL, INCOMPLETE = "✓ Complete", "⚠ Partial", "✗ Incomplete"


def _notional(price: str, scale: float) -> Column:
    return F.round(F.sum(F.col(price) * F.col("volume")) / F.lit(scale), 2)


def _tier(value: Column, full: Column | int, partial: Column | int) -> Column:
    return F.when(value >= full, COMPLETE).when(value >= partial, PARTIAL).otherwise(INCOMPLETE)


def _rate(value: str, of: int) -> Column:
    return F.round(F.lit(100.0) * F.col(value) / F.lit(of), 2)


def dataset_summary(bars: DataFrame) -> DataFrame:
    return bars.agg(
        F.count_distinct("stock").alias("total_tickers"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("total_records"),
        _notional("close", 1e9).alias("total_volume_billions"),
    )


def ticker_summary(bars: DataFrame, top: int = 10) -> DataFrame:
    return (
        bars.groupBy("stock")
        .agg(
            F.count(F.lit(1)).alias("days_collected"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            _notional("close", 1e6).alias("total_volume_millions"),
        )
        .orderBy(F.desc("total_volume_millions"), "stock")
        .limit(top)
    )


def top_notional(bars: DataFrame, top: int = 10) -> DataFrame:
    return (
        bars.groupBy("stock")
        .agg(_notional("close", 1e6).alias("total_volume_millions"))
        .orderBy(F.desc("total_volume_millions"), "stock")
        .limit(top)
    )


def recent_days(bars: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return bars.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz"))


def daily_activity(bars: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return recent_days(bars, as_of, days).groupBy("date").agg(
        F.count_distinct("stock").alias("tickers_updated"),
        F.count(F.lit(1)).alias("total_records"),
    )


def with_total(df: DataFrame, totals: DataFrame, name: str) -> DataFrame:
    """Attach a one-row, one-column total to every row, as a scalar subquery."""
    return df.withColumn(name, totals.scalar())


def capture_rate_tickers(bars: DataFrame, top: int | None = 10) -> DataFrame:
    """Distinct tickers per day against all tickers; the latest ``top`` days."""
    per_day = bars.groupBy(F.to_date("date").alias("trading_date")).agg(
        F.count_distinct("stock").alias("tickers_captured")
    )
    total = bars.agg(F.count_distinct("stock").alias("total_tickers"))
    rated = with_total(per_day, total, "total_tickers").select(
        "trading_date", "tickers_captured", "total_tickers",
        F.round(F.lit(100.0) * F.col("tickers_captured") / F.col("total_tickers"), 2).alias("capture_rate_pct"),
        _tier(
            F.col("tickers_captured"), F.col("total_tickers"), F.col("total_tickers") * F.lit(0.95)
        ).alias("status"),
    )
    return rated.orderBy(F.desc("trading_date")).limit(top) if top else rated


def _per_minute(trades: DataFrame, day: Column, minute: Column) -> DataFrame:
    """Counts per day, minute and instrument.

    Several distinct counts multiply their input rows; this first pass, combined
    before its shuffle, leaves them far fewer rows to multiply.
    """
    return trades.groupBy(day.alias("day"), minute.alias("minute"), "isin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("price") * F.col("volume")).alias("notional"),
        F.min("trade_time").alias("first_trade"),
        F.max("trade_time").alias("last_trade"),
    )


def _millions(column: str) -> Column:
    return F.round(F.sum(column) / F.lit(1e6), 2)


def trade_day_stats(trades: DataFrame, session_minutes: int = 600, full: int = 540, partial: int = 450,
                    top: int | None = 10) -> DataFrame:
    """Per trade date: trades, instruments, minutes, notional, first and last time, status."""
    counted = _per_minute(trades, F.to_date("trade_time"), minute_floor("trade_time"))
    daily = counted.groupBy(F.col("day").alias("trade_date")).agg(
        F.sum("n").alias("trades_captured"),
        F.count_distinct("isin").alias("unique_isins"),
        F.count_distinct("minute").alias("minutes_captured"),
        _millions("notional").alias("volume_millions"),
        F.min("first_trade").alias("first_trade"),
        F.max("last_trade").alias("last_trade"),
    )
    rated = daily.select(
        "trade_date", "trades_captured", "unique_isins", "minutes_captured",
        F.lit(session_minutes).alias("theoretical_max_minutes"),
        _rate("minutes_captured", session_minutes).alias("capture_rate_pct"),
        "volume_millions",
        hhmm("first_trade").alias("first_trade_time"),
        hhmm("last_trade").alias("last_trade_time"),
        _tier(F.col("minutes_captured"), full, partial).alias("status"),
    )
    return rated.orderBy(F.desc("trade_date")).limit(top) if top else rated


def minute_coverage(rows: DataFrame, ts: str = "date", session_minutes: int = 390, full: int = 370,
                    partial: int = 300, top: int | None = 10) -> DataFrame:
    """Distinct minutes per date against the session length."""
    rated = (
        rows.groupBy(F.to_date(ts).alias("trade_date"))
        .agg(F.count_distinct(minute_floor(ts)).alias("minutes_with_trades"))
        .select(
            "trade_date", "minutes_with_trades",
            F.lit(session_minutes).alias("theoretical_minutes_regular"),
            _rate("minutes_with_trades", session_minutes).alias("capture_rate_pct"),
            _tier(F.col("minutes_with_trades"), full, partial).alias("status"),
        )
    )
    return rated.orderBy(F.desc("trade_date")).limit(top) if top else rated


def trades_by_partition_day(trades: DataFrame, top: int | None = 10) -> DataFrame:
    """By the value of ``day`` alone, which mixes months, as published."""
    counted = trades.groupBy("day").agg(
        F.count(F.lit(1)).alias("trades"), _notional("price", 1e6).alias("volume_millions")
    )
    return counted.orderBy(F.desc("day")).limit(top) if top else counted


def trades_by_trade_date(trades: DataFrame, top: int | None = 10) -> DataFrame:
    counted = trades.groupBy(F.to_date("trade_time").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("trades"), _notional("price", 1e6).alias("volume_millions")
    )
    return counted.orderBy(F.desc("trade_date")).limit(top) if top else counted


def trade_overall(trades: DataFrame) -> DataFrame:
    return trades.agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.count_distinct("day").alias("total_days"),
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
        _notional("price", 1e6).alias("total_volume_millions"),
    )


def trade_day_breakdown(trades: DataFrame) -> DataFrame:
    counted = _per_minute(trades, F.col("day"), minute_of_day("trade_time"))
    return counted.groupBy("day").agg(
        F.sum("n").alias("trades"),
        F.count_distinct("minute").alias("unique_minutes"),
        F.min("first_trade").alias("first_trade"),
        F.max("last_trade").alias("last_trade"),
        _millions("notional").alias("volume_millions"),
        F.count_distinct("isin").alias("unique_isins"),
    )


def session_edges(trades: DataFrame, top: int | None = 10) -> DataFrame:
    """First and last trade per date, with hour and minute of the last."""
    edges = trades.groupBy(F.to_date("trade_time").alias("date")).agg(
        F.min("trade_time").alias("first_trade"), F.max("trade_time").alias("last_trade")
    ).select(
        "date", "first_trade", "last_trade",
        F.hour("last_trade").cast("bigint").alias("last_hour"),
        F.minute("last_trade").cast("bigint").alias("last_minute"),
    )
    return edges.orderBy(F.desc("date")).limit(top) if top else edges
