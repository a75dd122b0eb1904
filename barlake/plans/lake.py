"""Queries of the writers: each stores a whole table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import audit, lake
from barlake.operators.bars import ohlcv_from_trades
from barlake.operators.mapping import map_isin_to_ticker
from barlake.plans import views
from barlake.plans.catalog import query
from barlake.plans.sources import BAR_COLUMNS, DEDUPED
from barlake.schemas import BARS
from barlake.session import scratch_dir
from barlake.sources.bars import discover_partitions, scan_bars_partitioned, scan_partitions

# Instruments as tickers of daily bars: few enough for a folder per ticker.
DAY_BARS = views.TRADES + """, day_bars AS (SELECT isin AS stock, CAST(CAST(trade_time AS DATE) AS TIMESTAMP) AS date,
  CAST(sum(volume) AS BIGINT) AS volume FROM trades GROUP BY ALL HAVING sum(volume) > 0)"""


def _day_bars(spark, sf):
    bars = ohlcv_from_trades(views.trades(spark, sf), "1d")
    return bars.select(
        F.col("isin").alias("stock"), F.col("bar").alias("date"), "open", "high", "low", "close",
        F.col("volume").cast("bigint").alias("volume"), F.lit(None).cast("bigint").alias("sequence"),
    )


@query("write_bars_monthly", f"""WITH {views.BARS_DAILY} SELECT strftime(date, '%Y') AS year, strftime(date, '%m') AS month, count(*) AS rows,
  count(DISTINCT stock) AS tickers, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY ALL""")
def write_bars_monthly(spark, sf):
    root = scratch_dir(spark, "monthly")
    lake.write_bars_monthly(views.bars_daily(spark, sf), root)
    return scan_partitions(spark, root).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("stock").alias("tickers"), F.sum("volume").alias("volume")
    )


@query("write_bars_by_ticker", f"WITH {DAY_BARS} SELECT stock AS ticker, stock, date, volume FROM day_bars")
def write_bars_by_ticker(spark, sf):
    root = scratch_dir(spark, "tickers")
    lake.write_bars_monthly(_day_bars(spark, sf), root, "by_ticker", compression="snappy")
    return scan_partitions(spark, root, "by_ticker").select("ticker", "stock", "date", "volume")


@query("discover_partitions", f"WITH {DAY_BARS} SELECT DISTINCT stock AS ticker FROM day_bars")
def discover_partitions_query(spark, sf):
    root = scratch_dir(spark, "tickers")
    lake.write_bars_monthly(_day_bars(spark, sf), root, "by_ticker")
    return discover_partitions(spark, root)


def _halves(spark, sf):
    """Two batches of bar versions: accepted returns first, all other lines later."""
    rows = views.bar_versions(spark, sf)
    first = F.col("l_returnflag") == "A"
    return rows.filter(first).select(*BARS.names), rows.filter(~first).select(*BARS.names)


UPSERTED = f"""WITH {views.BAR_VERSIONS} SELECT {BAR_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY stock, date ORDER BY sequence DESC NULLS FIRST, l_returnflag <> 'A' DESC, open DESC, volume DESC) AS rn
  FROM versions) WHERE rn = 1"""


@query("merge_bars", UPSERTED)
def merge_bars(spark, sf):
    return lake.merge_bars(*_halves(spark, sf))


@query("upsert_bars", UPSERTED)
def upsert_bars(spark, sf):
    root = scratch_dir(spark, "upsert-lake")
    first, second = _halves(spark, sf)
    lake.upsert_bars(spark, root, first)
    lake.upsert_bars(spark, root, second)
    return scan_bars_partitioned(spark, root)


TRADE_DAYS = f"""WITH {views.TRADES} SELECT feed_venue, strftime(trade_time, '%Y') AS year, strftime(trade_time, '%m') AS month, strftime(trade_time, '%d') AS day,
  count(*) AS trades, sum(volume) AS volume, CAST(sum(tick_id) AS BIGINT) AS ticks FROM trades GROUP BY ALL"""


def _stored_trades(spark, sf):
    """Trades stored in two deliveries, the second one repeating every late row of the first."""
    root = scratch_dir(spark, "trades-lake")
    trades = views.trades(spark, sf)
    lake.append_trades_daily(spark, root, trades.filter(F.hour("trade_time") < 16))
    lake.append_trades_daily(spark, root, trades.filter(F.hour("trade_time") >= 12))
    return lake.read_staged(spark, root, lake.TRADE_PARTITIONS)


@query("append_trades_daily", TRADE_DAYS)
def append_trades_daily(spark, sf):
    return _stored_trades(spark, sf).groupBy("feed_venue", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume"), F.sum("tick_id").alias("ticks")
    )


@query("consolidate_month", f"""WITH {views.TRADES} SELECT feed_venue, isin, trade_time, price, volume, tick_id FROM trades WHERE feed_venue = 'click' AND strftime(trade_time, '%Y-%m') = '2024-01'""")
def consolidate_month(spark, sf):
    daily = lake.with_trade_partitions(views.trades(spark, sf))
    root = scratch_dir(spark, "trades-monthly")
    lake.consolidate_month(daily, root, "click", "2024", "01")
    return lake.read_staged(spark, root, lake.TRADE_PARTITIONS[:3]).select(
        "feed_venue", "isin", "trade_time", "price", "volume", "tick_id"
    )


PERIOD_SQL = {"daily": "day", "weekly": "week", "monthly": "month", "yearly": "year"}


def _layouts(spark, sf):
    root, rows = scratch_dir(spark, "layouts"), None
    bars = views.hour_bars(spark, sf)
    for name in PERIOD_SQL:
        lake.layout_write(bars, f"{root}/{name}", name)
        stored = lake.read_staged(spark, f"{root}/{name}", ["period"])
        part = stored.agg(
            F.count_distinct("stock").alias("tickers"), F.count(F.lit(1)).alias("rows"),
            F.count_distinct("period").alias("periods"),
        ).withColumn("layout", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return root, rows


@query("layout_compare", f"WITH {views.HOUR_BARS} " + " UNION ALL ".join(
    f"SELECT '{name}' AS layout, count(DISTINCT stock) AS tickers, count(*) AS rows, count(DISTINCT date_trunc('{unit}', date)) AS periods FROM hour_bars"
    for name, unit in PERIOD_SQL.items()))
def layout_compare(spark, sf):
    return _layouts(spark, sf)[1]


@query("layout_stats", f"WITH {views.HOUR_BARS} " + " UNION ALL ".join(
    f"SELECT '{name}' AS layout, count(DISTINCT stock) AS tickers, count(*) AS rows, true AS file_per_period, {str(name == 'monthly').lower()} AS is_baseline FROM hour_bars"
    for name in PERIOD_SQL))
def layout_stats(spark, sf):
    root, rows = _layouts(spark, sf)
    files = audit.list_files(spark, root).withColumn("layout", F.regexp_extract("path", r"/([^/]+)/period=", 1))
    stats = audit.layout_stats(files, rows.drop("periods"), "monthly").join(rows.select("layout", "periods"), "layout")
    # sizes differ by writer version: compare what must hold about them
    return stats.select(
        "layout", "tickers", "rows", (F.col("files") >= F.col("periods")).alias("file_per_period"),
        ((F.col("layout") == "monthly") & (F.col("ratio") == 1.0)).alias("is_baseline"),
    )


@query("write_ohlcv_dual", f"""WITH {views.MAPPINGS}, {views.TRADES}, b AS (SELECT t.feed_venue, t.isin, coalesce(m.ticker, '__UNMAPPED__') AS ticker,
    CAST(CAST(trade_time AS DATE) AS TIMESTAMP) AS bar, sum(volume) AS volume FROM trades t LEFT JOIN mapping_new m ON t.isin = m.isin GROUP BY ALL HAVING sum(volume) > 0)
  SELECT feed_venue, CASE WHEN ticker = '__UNMAPPED__' THEN isin ELSE ticker END AS instrument, ticker <> '__UNMAPPED__' AS mapped, bar, volume FROM b""")
def write_ohlcv_dual(spark, sf):
    root = scratch_dir(spark, "dual")
    bars = ohlcv_from_trades(views.trades(spark, sf), "1d", ["feed_venue", "isin"])
    lake.write_ohlcv_dual(map_isin_to_ticker(bars, views.mapping_new(spark, sf)), root)
    parts = ["feed_venue", "ticker", "isin_part", "year", "month"]
    mapped = lake.read_staged(spark, f"{root}/by_ticker", parts, many_folders=True).withColumn("instrument", F.col("ticker"))
    unmapped = lake.read_staged(spark, f"{root}/by_isin", parts, many_folders=True).withColumn("instrument", F.col("isin"))
    columns = ["feed_venue", "instrument", "mapped", "bar", "volume"]
    return mapped.withColumn("mapped", F.lit(True)).select(*columns).unionByName(
        unmapped.withColumn("mapped", F.lit(False)).select(*columns)
    )


@query("trades_by_isin_archive", f"""WITH {views.TRADES} SELECT isin, strftime(trade_time, '%Y') AS year, strftime(trade_time, '%m') AS month, count(*) AS trades, sum(volume) AS volume FROM trades GROUP BY ALL""")
def trades_by_isin_archive(spark, sf):
    root = scratch_dir(spark, "isins")
    lake.trades_by_isin_archive(views.trades(spark, sf), root)
    stored = lake.read_staged(spark, root, ["isin", "year", "month"], many_folders=True)
    return stored.groupBy("isin", "year", "month").agg(F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume"))


@query("staged_publish", f"""WITH {views.TRADES} SELECT isin, count(*) AS rows, 'published' AS status FROM (
  SELECT isin, date_trunc('hour', trade_time) AS bar FROM trades GROUP BY ALL HAVING sum(volume) > 0) GROUP BY 1""")
def staged_publish(spark, sf):
    from barlake.operators.bars import ohlc_violations, volume_conservation

    trades = views.trades(spark, sf)
    bars = ohlcv_from_trades(trades, "1h")
    no_coverage = spark.createDataFrame([], "trade_date date, capture_rate_pct double, status string")
    outcome = audit.validation_outcome(
        audit.aggregation_validation(volume_conservation(trades, bars), no_coverage, ohlc_violations(bars))
    )
    placed = bars.withColumns({"year": F.format_string("%04d", F.year("bar")), "month": F.format_string("%02d", F.month("bar"))})
    manifest = lake.staged_publish(
        spark, placed, scratch_dir(spark, "active"), outcome, ["year", "month"], ["isin", "bar"], ["isin"], "2024-02-01"
    )
    return manifest.select("isin", "rows", "status")


@query("retention", f"""WITH {views.TRADES} SELECT CAST(trade_time AS DATE) AS day, count(*) AS rows FROM trades WHERE date_diff('day', trade_time, DATE '2024-04-15') > 90 GROUP BY 1""")
def retention(spark, sf):
    _, expired = lake.retention(views.trades(spark, sf), "2024-04-15", 90, "trade_time")
    return expired


@query("retention_keep", f"""WITH {views.TRADES} SELECT tick_id, volume FROM trades WHERE date_diff('day', trade_time, DATE '2024-04-15') <= 90""")
def retention_keep(spark, sf):
    kept, _ = lake.retention(views.trades(spark, sf), "2024-04-15", 90, "trade_time")
    return kept.select("tick_id", "volume")


@query("trade_lookup", f"""WITH {views.TRADES} SELECT isin, trade_time, count(*) AS trades, CAST(sum(volume) AS BIGINT) AS volume
  FROM trades WHERE isin IN (SELECT max(isin) FROM trades UNION ALL SELECT min(isin) FROM trades) GROUP BY isin, trade_time""")
def trade_lookup(spark, sf):
    """All trades are stored with skippable row groups; the lookup names its instruments as literals, so the filter is pushed."""
    root = scratch_dir(spark, "lookup")
    trades = views.trades(spark, sf)
    lake.write_partitioned(
        lake.with_trade_partitions(trades), root, lake.TRADE_PARTITIONS, ["trade_time"], block_bytes=1 << 20, bloom=["isin"])
    wanted = list(trades.agg(F.min("isin"), F.max("isin")).first())
    found = lake.read_staged(spark, root, lake.TRADE_PARTITIONS).filter(F.col("isin").isin(wanted))
    return found.groupBy("isin", "trade_time").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("volume").cast("bigint").alias("volume"))
