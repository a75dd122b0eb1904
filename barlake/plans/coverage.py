"""Queries of the published reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions.names import partition_day
from barlake.operators import coverage
from barlake.plans import views
from barlake.plans.catalog import query

RAW = f"WITH {views.BARS_RAW}"
TRADES = f"WITH {views.TRADES}"
BAR_AS_OF, TRADE_TIERS = "2001-11-04", "CASE WHEN {0} >= {1} THEN '✓ Complete' WHEN {0} >= {2} THEN '⚠ Partial' ELSE '✗ Incomplete' END"


@query("dataset_summary", f"""{RAW} SELECT count(DISTINCT stock) AS total_tickers, min(date) AS first_date, max(date) AS last_date,
  count(*) AS total_records, round(sum(price * volume) / 1e9, 2) AS total_volume_billions FROM bars_raw""")
def dataset_summary(spark, sf):
    return coverage.dataset_summary(views.bars_raw(spark, sf))


@query("ticker_summary", f"""{RAW} SELECT stock, count(*) AS days_collected, min(date) AS first_date, max(date) AS last_date,
  round(sum(price * volume) / 1e6, 2) AS total_volume_millions FROM bars_raw GROUP BY stock
  ORDER BY total_volume_millions DESC, stock LIMIT 10""")
def ticker_summary(spark, sf):
    return coverage.ticker_summary(views.bars_raw(spark, sf))


@query("top_notional", f"""{RAW} SELECT stock, round(sum(price * volume) / 1e6, 2) AS total_volume_millions
  FROM bars_raw GROUP BY stock ORDER BY total_volume_millions DESC, stock LIMIT 10""")
def top_notional(spark, sf):
    return coverage.top_notional(views.bars_raw(spark, sf))


@query("recent_days", f"""{RAW} SELECT stock, date, volume FROM bars_raw WHERE date >= TIMESTAMP '2001-10-28'""")
def recent_days(spark, sf):
    return coverage.recent_days(views.bars_raw(spark, sf), BAR_AS_OF).select("stock", "date", "volume")


@query("daily_activity", f"""{RAW} SELECT date, count(DISTINCT stock) AS tickers_updated, count(*) AS total_records
  FROM bars_raw WHERE date >= TIMESTAMP '2001-10-28' GROUP BY date""")
def daily_activity(spark, sf):
    return coverage.daily_activity(views.bars_raw(spark, sf), BAR_AS_OF)


@query("with_total", f"""{RAW} SELECT date, count(*) AS bars, (SELECT count(*) FROM bars_raw) AS total FROM bars_raw GROUP BY date""")
def with_total(spark, sf):
    raw = views.bars_raw(spark, sf)
    per_day = raw.groupBy("date").agg(F.count(F.lit(1)).alias("bars"))
    return coverage.with_total(per_day, raw.agg(F.count(F.lit(1))), "total")


@query("capture_rate_tickers", f"""{RAW}, d AS (SELECT CAST(date AS DATE) AS trading_date, count(DISTINCT stock) AS tickers_captured FROM bars_raw GROUP BY 1),
  t AS (SELECT count(DISTINCT stock) AS total_tickers FROM bars_raw)
  SELECT trading_date, tickers_captured, total_tickers, round(100.0 * tickers_captured / total_tickers, 2) AS capture_rate_pct,
  CASE WHEN tickers_captured = total_tickers THEN '✓ Complete' WHEN tickers_captured >= total_tickers * 0.95 THEN '⚠ Partial' ELSE '✗ Incomplete' END AS status
  FROM d, t ORDER BY trading_date DESC LIMIT 10""")
def capture_rate_tickers(spark, sf):
    return coverage.capture_rate_tickers(views.bars_raw(spark, sf))


@query("trade_day_stats", f"""{TRADES}, d AS (SELECT CAST(trade_time AS DATE) AS trade_date, count(*) AS trades_captured,
  count(DISTINCT isin) AS unique_isins, count(DISTINCT strftime(trade_time, '%Y-%m-%d %H:%M')) AS minutes_captured,
  round(sum(price * volume) / 1e6, 2) AS volume_millions, min(trade_time) AS f, max(trade_time) AS l FROM trades GROUP BY 1)
  SELECT trade_date, trades_captured, unique_isins, minutes_captured, 600 AS theoretical_max_minutes,
  round(100.0 * minutes_captured / 600, 2) AS capture_rate_pct, volume_millions, strftime(f, '%H:%M') AS first_trade_time,
  strftime(l, '%H:%M') AS last_trade_time, {TRADE_TIERS.format('minutes_captured', 540, 450)} AS status
  FROM d ORDER BY trade_date DESC LIMIT 10""")
def trade_day_stats(spark, sf):
    return coverage.trade_day_stats(views.trades(spark, sf))


@query("minute_coverage", f"""{TRADES}, d AS (SELECT CAST(trade_time AS DATE) AS trade_date,
  count(DISTINCT strftime(trade_time, '%Y-%m-%d %H:%M')) AS minutes_with_trades FROM trades GROUP BY 1)
  SELECT trade_date, minutes_with_trades, 390 AS theoretical_minutes_regular,
  round(100.0 * minutes_with_trades / 390, 2) AS capture_rate_pct, {TRADE_TIERS.format('minutes_with_trades', 370, 300)} AS status
  FROM d ORDER BY trade_date DESC LIMIT 10""")
def minute_coverage(spark, sf):
    return coverage.minute_coverage(views.trades(spark, sf), "trade_time")


def _with_day(spark, sf):
    return views.trades(spark, sf).withColumn("day", partition_day("trade_time"))


DAYED = f"{TRADES}, t AS (SELECT *, strftime(trade_time, '%d') AS day FROM trades)"


@query("trades_by_partition_day", f"""{DAYED} SELECT day, count(*) AS trades, round(sum(price * volume) / 1e6, 2) AS volume_millions
  FROM t GROUP BY day ORDER BY day DESC LIMIT 10""")
def trades_by_partition_day(spark, sf):
    return coverage.trades_by_partition_day(_with_day(spark, sf))


@query("trades_by_trade_date", f"""{TRADES} SELECT CAST(trade_time AS DATE) AS trade_date, count(*) AS trades,
  round(sum(price * volume) / 1e6, 2) AS volume_millions FROM trades GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def trades_by_trade_date(spark, sf):
    return coverage.trades_by_trade_date(views.trades(spark, sf))


@query("trade_overall", f"""{DAYED} SELECT count(*) AS total_trades, count(DISTINCT day) AS total_days, min(day) AS first_date,
  max(day) AS last_date, round(sum(price * volume) / 1e6, 2) AS total_volume_millions FROM t""")
def trade_overall(spark, sf):
    return coverage.trade_overall(_with_day(spark, sf))


@query("trade_day_breakdown", f"""{DAYED} SELECT day, count(*) AS trades, count(DISTINCT strftime(trade_time, '%H:%M')) AS unique_minutes,
  min(trade_time) AS first_trade, max(trade_time) AS last_trade, round(sum(price * volume) / 1e6, 2) AS volume_millions,
  count(DISTINCT isin) AS unique_isins FROM t GROUP BY day""")
def trade_day_breakdown(spark, sf):
    return coverage.trade_day_breakdown(_with_day(spark, sf))


@query("session_edges", f"""{TRADES} SELECT CAST(trade_time AS DATE) AS date, min(trade_time) AS first_trade, max(trade_time) AS last_trade,
  extract(hour FROM max(trade_time)) AS last_hour, extract(minute FROM max(trade_time)) AS last_minute
  FROM trades GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def session_edges(spark, sf):
    return coverage.session_edges(views.trades(spark, sf))


@query("partition_pruned_scan", f"{TRADES} SELECT feed_venue, count(*) AS trades FROM trades WHERE feed_venue IN ('click', 'view') GROUP BY 1")
def partition_pruned_scan(spark, sf):
    from barlake.operators.lake import TRADE_PARTITIONS, read_staged, with_trade_partitions, write_partitioned
    from barlake.session import scratch_dir

    root = scratch_dir(spark, "venues")
    write_partitioned(with_trade_partitions(views.trades(spark, sf)), root, TRADE_PARTITIONS, ["trade_time", "tick_id"])
    stored = read_staged(spark, root, TRADE_PARTITIONS)
    return stored.filter(F.col("feed_venue").isin("click", "view")).groupBy("feed_venue").agg(F.count(F.lit(1)).alias("trades"))
