"""Queries of the streaming jobs: each drains the given tables and returns what it stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.ingest import missing_files
from barlake.operators.lake import TRADE_PARTITIONS, read_staged
from barlake.plans import views
from barlake.plans.bars import PRICES
from barlake.plans.catalog import CATALOG, query, rounded
from barlake.plans.views import table
from barlake.session import scratch_dir
from barlake.sources.bars import scan_bars_partitioned
from barlake.functions.names import trade_filename
from barlake.schemas import BARS, INTERVALS
from barlake.sources.trades import decode_lines
from barlake.streaming import trades as streams
from barlake.streaming import event_time, updates

HOURLY = CATALOG["ohlcv_1h"].oracle
WEEKS = "5 weeks"


def _event_stream(spark, sf, name="events"):
    """A table of the data folder as a file stream."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _trade_stream(spark, sf):
    return _event_stream(spark, sf).select(
        views.padded("XX", "user_id", 10).alias("isin"), F.col("ts").alias("trade_time"),
        F.col("value").alias("price"), views.volume_of("props").alias("volume"),
        F.col("event_id").alias("tick_id"), F.col("event_id").cast("string").alias("trans_id"),
        F.col("event_type").alias("feed_venue"), F.lit("EUR").alias("currency"),
    )


@query("stream_ohlcv", HOURLY)
def stream_ohlcv(spark, sf):
    root = scratch_dir(spark, "stream-bars")
    bars = streams.stream_ohlcv(_trade_stream(spark, sf), "1h", lateness=WEEKS)
    streams.run_available(bars, scratch_dir(spark, "checkpoint"), streams.bar_versions(spark, root), "update")
    return rounded(streams.latest_bars(spark, root), 6, *PRICES)


@query("stream_dedupe", f"WITH {views.TRADES} SELECT isin, trade_time, price, volume, trans_id FROM trades")
def stream_dedupe(spark, sf):
    stream = _trade_stream(spark, sf)
    # every trade is delivered twice
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    root = scratch_dir(spark, "stream-dedupe")
    once = streams.stream_dedupe(twice, WEEKS).select("isin", "trade_time", "price", "volume", "trans_id")
    streams.run_available(once, scratch_dir(spark, "checkpoint"), streams.bar_versions(spark, root))
    return spark.read.parquet(root).drop("batch_id")


def _landing(spark, sf):
    """Vendor lines landed in a folder, a few files of them."""
    landing = scratch_dir(spark, "landing")
    views.trade_lines(spark, sf).select("value").repartition(8).write.option("compression", "gzip").text(landing)
    return landing


@query("stream_trades", """SELECT event_id AS tick_id, printf('XX%010d', user_id) AS isin, ts AS trade_time, value AS price FROM events""")
def stream_trades(spark, sf):
    root = scratch_dir(spark, "stream-trades")
    parsed = streams.stream_trades(spark, _landing(spark, sf), files_per_batch=3)
    checkpoint = scratch_dir(spark, "checkpoint")
    columns = ["tick_id", "isin", "trade_time", "price"]
    streams.run_available(parsed.select(*columns), checkpoint, streams.bar_versions(spark, root))
    # a second run finds every file already processed
    streams.run_available(parsed.select(*columns), checkpoint, streams.bar_versions(spark, root))
    return spark.read.parquet(root).select(*columns)


@query("stream_store_and_log", f"""WITH {views.TRADES} SELECT feed_venue, strftime(trade_time, '%d') AS day, count(*) AS trades FROM trades GROUP BY ALL""")
def stream_store_and_log(spark, sf):
    root, log, failed = (scratch_dir(spark, n) for n in ("stream-lake", "stream-log", "stream-failed"))
    stream = decode_lines(views.lines_of(_trade_stream(spark, sf)))
    sink = streams.store_and_log(spark, root, log, "2024-02-01 00:00:00", failed)
    streams.run_available(stream, scratch_dir(spark, "checkpoint"), sink)
    logged = streams.read_log(spark, log).agg(F.sum("trade_count")).first()[0]
    stored = read_staged(spark, root, TRADE_PARTITIONS)
    if logged != stored.count():
        raise ValueError("the log does not add up to the stored trades")
    return stored.groupBy("feed_venue", "day").agg(F.count(F.lit(1)).alias("trades"))


# One spoiled line rejects its file: nothing of it is stored or logged, and it is fetched again.
@query("stream_failed_files", f"""WITH {views.TRADES}, f AS (
    SELECT feed_venue || '-posttrade-' || strftime(trade_time, '%Y-%m-%dT%H_%M') || '.json.gz' AS name, count(*) AS lines,
      bool_or(volume = 7) AS bad, bool_or(volume = 8) AND count(*) FILTER (WHERE volume <> 8) = 0 AS lacking FROM trades GROUP BY 1)
  SELECT CASE WHEN bad OR lacking THEN 'quarantined' ELSE 'logged' END AS part, name, lines FROM f
  UNION ALL SELECT 'to_fetch', name, 1 FROM f WHERE bad OR lacking
  UNION ALL SELECT 'stored', '', sum(lines) FROM f WHERE NOT bad AND NOT lacking""")
def stream_failed_files(spark, sf):
    root, log, failed = (scratch_dir(spark, n) for n in ("stream-lake", "stream-log", "stream-failed"))
    at = "2024-02-01 00:00:00"
    decoded = decode_lines(_spoiled(views.lines_of(_trade_stream(spark, sf))))
    streams.run_available(decoded, scratch_dir(spark, "checkpoint"), streams.store_and_log(spark, root, log, at, failed))
    listed, bad = views.manifest(spark, sf), streams.read_failed(spark, failed)
    streams.log_empty_files(spark, log, listed, at, bad)
    logged = streams.read_log(spark, log)
    named = F.concat("venue", F.lit("-posttrade-"), "timestamp", F.lit(".json.gz"))
    one = F.lit(1).cast("bigint")
    return (
        bad.groupBy("file_name").agg(F.count(F.lit(1)).alias("lines")).select(F.lit("quarantined").alias("part"), F.col("file_name").alias("name"), "lines")
        .unionByName(logged.select(F.lit("logged").alias("part"), named.alias("name"), F.col("trade_count").alias("lines")))
        .unionByName(missing_files(listed, logged).select(F.lit("to_fetch").alias("part"), F.col("file_name").alias("name"), one.alias("lines")))
        .unionByName(read_staged(spark, root, TRADE_PARTITIONS).agg(F.count(F.lit(1)).alias("lines")).select(
            F.lit("stored").alias("part"), F.lit("").alias("name"), "lines"))
    )


def _spoiled(lines):
    """Lines of volume 7 are cut, lines of volume 8 lack their instrument."""
    volume = F.get_json_object("value", "$.lastQty").cast("double")
    cut = F.expr("substring(value, 1, length(value) - 5)")
    return lines.withColumn("value", F.when(volume == 7, cut).when(
        volume == 8, F.regexp_replace("value", '"isin":"[^"]*",', "")).otherwise(F.col("value")))


# One listed file brought nothing.
@query("stream_log", f"""WITH {views.TRADES}, {views.MANIFEST} SELECT venue, date, minute AS timestamp, true AS has_data, count(*) AS trade_count
  FROM manifest m JOIN trades t ON m.venue = t.feed_venue AND m.minute = strftime(t.trade_time, '%Y-%m-%dT%H_%M') GROUP BY ALL
  UNION ALL SELECT 'quiet', '2024-01-01', '2024-01-01T00_00', false, 0""")
def stream_log(spark, sf):
    from barlake.operators.ingest import log_rows

    log = scratch_dir(spark, "stream-log")
    stream = _trade_stream(spark, sf).withColumn("file_name", trade_filename("feed_venue", "trade_time"))

    at = "2024-02-01 00:00:00"

    def each(batch, batch_id):
        counts = batch.groupBy("file_name").agg(F.count(F.lit(1)).alias("trade_count"))
        streams.merge_log(spark, log, log_rows(counts.select("file_name"), counts, at))

    streams.run_available(stream, scratch_dir(spark, "checkpoint"), each)
    quiet = spark.createDataFrame([("quiet", "quiet-posttrade-2024-01-01T00_00.json.gz")], "venue string, file_name string")
    streams.log_empty_files(spark, log, views.manifest(spark, sf).unionByName(quiet), at)
    return streams.read_log(spark, log).drop("downloaded_at")


@query("late_data", HOURLY)
def late_data(spark, sf):
    # trades of small volume land in a second delivery, long after the watermark has passed most of them; a delivery is
    # one batch, however many files the tasks write it in, since each batch reads the stored days that it touches
    trades, landing, checkpoint = views.trades(spark, sf), scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    stored, root, late = (scratch_dir(spark, n) for n in ("late-trades", "late-bars", "late-rows"))
    sink = streams.store_with_late(spark, stored, root, late, "1h", lateness="2 hours")
    for part in ("volume >= 10", "volume < 10"):
        trades.filter(part).write.mode("append").parquet(landing)
        streams.run_available(spark.readStream.schema(trades.schema).parquet(landing), checkpoint, sink)
    if not streams.late_rows(spark, late).count():
        raise ValueError("no trade came late")
    bars = read_staged(spark, root, streams.BAR_PARTITIONS).drop(*streams.BAR_PARTITIONS)
    return rounded(bars, 6, *PRICES)


@query("split_late", f"""WITH {views.TRADES} SELECT trade_time < TIMESTAMP '2024-01-15 12:00:00' AS late, count(*) AS trades FROM trades GROUP BY 1""")
def split_late(spark, sf):
    prompt, late = streams.split_late(views.trades(spark, sf), "2024-01-15 12:00:00")
    parts = prompt.select(F.lit(False).alias("late")).unionByName(late.select(F.lit(True).alias("late")))
    return parts.groupBy("late").agg(F.count(F.lit(1)).alias("trades"))


@query("foreach_batch_upsert", f"""WITH {views.BARS_RAW} SELECT stock, date, max(price) AS close FROM bars_raw GROUP BY ALL""")
def foreach_batch_upsert(spark, sf):
    root = scratch_dir(spark, "stream-upsert")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    bars = _event_stream(spark, sf, "lineitem").select(
        views.padded("P", "l_partkey", 6).alias("stock"), F.col("l_shipdate").alias("date"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.lit(0).cast("bigint").alias("volume"), F.lit(1).cast("bigint").alias("sequence"),
    )
    streams.run_available(bars, scratch_dir(spark, "checkpoint"), streams.foreach_batch_upsert(spark, root, scratch_dir(spark, "undated")))
    return scan_bars_partitioned(spark, root).select("stock", "date", "close")


# Bars of the seventh line have a date that cannot be read: they are kept apart, once, though the batch comes twice.
@query("stream_undated_bars", """WITH b AS (SELECT printf('P%06d', l_partkey) AS stock, l_shipdate AS date, l_linenumber = 7 AS undated FROM lineitem)
  SELECT 'undated' AS part, stock, count(*) AS bars FROM b WHERE undated GROUP BY 2
  UNION ALL SELECT 'stored', stock, count(DISTINCT date) FROM b WHERE NOT undated GROUP BY 2""")
def stream_undated_bars(spark, sf):
    root, undated = scratch_dir(spark, "stream-upsert"), scratch_dir(spark, "undated")
    bars = _event_stream(spark, sf, "lineitem").select(
        views.padded("P", "l_partkey", 6).alias("stock"),
        F.when(F.col("l_linenumber") < 7, F.col("l_shipdate").cast("string")).otherwise("no date").alias("date"),
        F.col("l_quantity").alias("close"), F.lit(1).cast("bigint").alias("volume"), F.lit(1).cast("bigint").alias("sequence"))
    sink = streams.foreach_batch_upsert(spark, root, undated)
    for _ in range(2):  # a new checkpoint delivers the same batch again, under its number
        streams.run_available(bars, scratch_dir(spark, "checkpoint"), sink)
    return _counted(spark, undated, scan_bars_partitioned(spark, root))


def _counted(spark, undated, stored):
    kept = spark.read.schema(BARS).option("recursiveFileLookup", "true").parquet(undated)
    n = F.count(F.lit(1)).alias("bars")
    return kept.groupBy("stock").agg(n).select(F.lit("undated").alias("part"), "stock", "bars").unionByName(
        stored.groupBy("stock").agg(n).select(F.lit("stored").alias("part"), "stock", "bars"))


@query("update_undated_bars", """WITH b AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS stock, o_orderdate AS date, o_orderstatus = 'P' AS undated FROM orders)
  SELECT 'undated' AS part, stock, count(*) AS bars FROM b WHERE undated GROUP BY 2
  UNION ALL SELECT 'stored', stock, count(*) FROM b WHERE NOT undated GROUP BY 2""")
def update_undated_bars(spark, sf):
    undated_status = F.col("o_orderstatus") == "P"
    landed = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("stock"), F.lit("1d").alias("interval"), undated_status.alias("undated"),
        "o_orderdate").distinct().select("stock", "interval", F.when(
            F.col("undated"), F.concat(F.lit("no date "), "o_orderdate")).otherwise(F.col("o_orderdate").cast("string")).alias("date"))
    tickers = landed.select(F.col("stock").alias("ticker")).distinct().select(
        "ticker", F.lit("1994-12-31").alias("added_date"), F.lit("active").alias("status"), F.lit(None).cast("string").alias("last_checked"))
    root, undated = scratch_dir(spark, "updates"), scratch_dir(spark, "undated")
    for _ in range(2):  # an update that is run again
        updates.incremental_update(spark, {"1d": root}, tickers, spark.createDataFrame([], INTERVALS), landed, "2001-08-15 17:00:00", undated)
    return _counted(spark, undated, scan_bars_partitioned(spark, root))


PARTS = 4


def _landed_in_order(spark, rows, at):
    """A stream of rows that land in files by their time, and after them a closing mark 40 days on, as a feed may send."""
    staged, landing = scratch_dir(spark, "staged"), scratch_dir(spark, "landing")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    first, last = rows.agg(F.min(at), F.max(at)).first()
    step = (last - first) / PARTS if last else None
    for part in range(PARTS if last else 0):
        after = F.lit(True) if not part else F.col(at) >= F.lit(first + part * step).cast("timestamp_ntz")
        until = F.lit(True) if part == PARTS - 1 else F.col(at) < F.lit(first + (part + 1) * step).cast("timestamp_ntz")
        rows.filter(after & until).write.mode("append").parquet(landing)
    mark = [F.lit(last).cast("timestamp_ntz") + F.expr("INTERVAL 40 DAYS") if f.name == at else F.lit(None) for f in rows.schema]
    spark.range(1).select(*(c.cast(f.dataType).alias(f.name) for c, f in zip(mark, rows.schema))).write.mode("append").parquet(landing)
    files = len([f for f in spark.read.parquet(landing).inputFiles()])
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // PARTS)).parquet(landing)


def _appended(spark, stream):
    root = scratch_dir(spark, "closed")
    query = streams.run_available(stream, scratch_dir(spark, "checkpoint"), streams.bar_versions(spark, root))
    if event_time.late_count(query):
        raise ValueError("rows came late")
    return spark.read.parquet(root).drop("batch_id")


@query("stream_session_gaps", CATALOG["session_gaps"].oracle)
def stream_session_gaps(spark, sf):
    trades = _landed_in_order(spark, views.trades(spark, sf).select("feed_venue", "trade_time"), "trade_time")
    sessions = _appended(spark, event_time.stream_sessions(trades, 60, "2 days"))
    return rounded(event_time.gaps_between(sessions), 6, "gap_seconds")


# Sums of hours end in other last digits than sums of trades, which would decide ties of the rounding: nine digits first.
@query("stream_local_days", CATALOG["ohlcv_1d_berlin"].oracle.replace(
    "round(sum(price * volume) / sum(volume), 6)", "round(round(sum(price * volume) / sum(volume), 9), 6)"))
def stream_local_days(spark, sf):
    trades = views.trades(spark, sf).select("isin", "trade_time", "price", "volume", "tick_id")
    days = event_time.stream_local_days(_landed_in_order(spark, trades, "trade_time"), "Europe/Berlin", lateness="2 days")
    return rounded(rounded(_appended(spark, days), 9, "vwap"), 6, *PRICES)


# For each minute with a file of any venue one more is listed, which brings nothing.
@query("stream_file_log", f"""WITH {views.TRADES}, {views.MANIFEST} SELECT venue, date, minute AS timestamp, true AS has_data, count(*) AS trade_count
  FROM manifest m JOIN trades t ON m.venue = t.feed_venue AND m.minute = strftime(t.trade_time, '%Y-%m-%dT%H_%M') GROUP BY ALL
  UNION ALL SELECT DISTINCT 'quiet', date, minute, false, 0 FROM manifest""")
def stream_file_log(spark, sf):
    trades = views.trades(spark, sf).select("trade_time", trade_filename("feed_venue", "trade_time").alias("file_name"))
    minutes = trades.select(F.date_trunc("minute", "trade_time").cast("timestamp_ntz").alias("trade_time"), F.col("file_name"))
    quiet = minutes.withColumn("file_name", trade_filename(F.lit("quiet"), "trade_time"))
    listed = minutes.unionByName(quiet).distinct()
    log = scratch_dir(spark, "stream-log")
    counts = event_time.stream_file_counts(*(
        _marked(_landed_in_order(spark, rows, "trade_time")) for rows in (listed, trades)), lateness="2 days")
    query = streams.run_available(counts, scratch_dir(spark, "checkpoint"), event_time.log_counts(spark, log, "2024-02-01 00:00:00"))
    if event_time.late_count(query):
        raise ValueError("rows came late")
    return streams.read_log(spark, log).drop("downloaded_at")


def _marked(rows):
    """The closing mark is a file of its own."""
    return rows.withColumn("file_name", F.coalesce("file_name", trade_filename(F.lit("mark"), "trade_time")))


# The watermark stops 20 days before the last outcome: 60 days behind the closing mark.
@query("registry_status_machine", """WITH l AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderpriority AS interval,
    max(struct_pack(d := o_orderdate, f := o_orderstatus = 'O')) AS o FROM orders GROUP BY 1, 2)
  SELECT ticker, interval, CASE WHEN o.f THEN 'active' WHEN o.d + INTERVAL 30 DAY <= (SELECT max(o_orderdate) - INTERVAL 20 DAY FROM orders) THEN 'eligible'
    ELSE 'not_found' END AS status, CAST(o.d + CASE WHEN NOT o.f AND o.d + INTERVAL 30 DAY <= (SELECT max(o_orderdate) - INTERVAL 20 DAY FROM orders)
    THEN INTERVAL 30 DAY ELSE INTERVAL 0 DAY END AS TIMESTAMP) AS at FROM l""")
def registry_status_machine(spark, sf):
    outcomes = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderpriority").alias("interval"),
        (F.col("o_orderstatus") == "O").alias("found"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    stream = _landed_in_order(spark, outcomes, "at")
    with event_time.timers(spark):
        changes = _appended(spark, event_time.status_changes(stream, lateness="60 days"))
    status = event_time.current_status(changes.filter("ticker is not null"))
    return status.withColumn("at", F.col("at").cast("timestamp_ntz"))


REGISTRY_SQL = f"WITH {views.REGISTRY}"


@query("incremental_update", f"""{REGISTRY_SQL}, bars AS (SELECT CAST(o_custkey AS VARCHAR) AS stock, o_orderpriority AS interval, o_orderdate AS date FROM orders GROUP BY ALL),
  p AS (SELECT t.ticker, w.interval, try_cast(i.last_data_date AS TIMESTAMP) AS s FROM tickers t, (SELECT DISTINCT o_orderpriority AS interval FROM orders) w
    LEFT JOIN intervals i ON i.ticker = t.ticker AND i.interval = w.interval
    WHERE t.status = 'active' AND (i.status IS NULL OR i.status <> 'not_found' OR coalesce(date_diff('day', try_cast(last_not_found_date AS DATE), DATE '2001-08-15') >= 30, true)))
  SELECT b.interval, b.stock, b.date FROM bars b JOIN p ON b.stock = p.ticker AND b.interval = p.interval AND (p.s IS NULL OR b.date >= p.s)""")
def incremental_update(spark, sf):
    tickers, intervals = views.registry(spark, sf)
    orders = table(spark, sf, "orders")
    landed = orders.groupBy(
        F.col("o_custkey").cast("string").alias("stock"), F.col("o_orderpriority").alias("interval"), F.col("o_orderdate").alias("date")
    ).agg(F.max("o_totalprice").alias("close"))
    roots = {interval: scratch_dir(spark, "updates") for interval in views.STORED_INTERVALS}
    updates.incremental_update(spark, roots, tickers, intervals, landed, "2001-08-15 17:00:00", scratch_dir(spark, "undated"))
    found = [scan_bars_partitioned(spark, root).select(F.lit(i).alias("interval"), "stock", "date") for i, root in roots.items()]
    return reduce(DataFrame.unionByName, found)


@query("live_registry_state", """WITH l AS (SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderpriority,
    max(struct_pack(d := o_orderdate, f := o_orderstatus = 'O')).f AS found FROM orders GROUP BY 1, 2)
  SELECT ticker, CASE WHEN bool_or(found) THEN 'active' ELSE 'not_found' END AS status, count(*) AS intervals,
    count(*) FILTER (WHERE NOT found) AS not_found_intervals FROM l GROUP BY 1""")
def live_registry_state(spark, sf):
    outcomes = _event_stream(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderpriority").alias("interval"),
        (F.col("o_orderstatus") == "O").alias("found"), F.col("o_orderdate").alias("at"),
    )
    root = scratch_dir(spark, "live")
    streams.run_available(
        updates.live_registry_state(outcomes), scratch_dir(spark, "checkpoint"), streams.bar_versions(spark, root), "update"
    )
    return updates.latest_state(spark, root)
