"""Queries of the scans, the ingest and the normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions.names import infer_layout, partition_month, partition_year, trade_filename
from barlake.operators.dedupe import dedupe_bars, dedupe_log, dedupe_trades
from barlake.operators.lake import write_bars_monthly
from barlake.operators.normalize import (
    normalize_bars,
    normalize_vendor_history,
    recover_sequence,
    split_null_dates,
)
from barlake.operators.bars import source_to_price_volume
from barlake.plans import views
from barlake.plans.catalog import query
from barlake.plans.views import table
from barlake.schemas import BARS
from barlake.session import scratch_dir
from barlake.sources import bars as bar_source
from barlake.sources import listings
from barlake.sources import trades as trade_source

BAR_COLUMNS = "stock, date, open, high, low, close, volume, sequence"
DEDUPED = f"""SELECT {BAR_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY stock, date ORDER BY sequence DESC NULLS FIRST,
         open DESC, volume DESC) AS rn FROM versions) WHERE rn = 1"""


@query("scan_bars_flat", f"""WITH {views.BARS_RAW}
  SELECT stock, date, price AS open, price AS high, price AS low, price AS close, volume, sequence FROM bars_raw""")
def scan_bars_flat(spark, sf):
    root = scratch_dir(spark, "flat")
    views.bars_raw(spark, sf).select(*BARS.names).write.parquet(root)
    return bar_source.scan_bars_flat(spark, root)


def _stored_bars(spark, sf):
    root = scratch_dir(spark, "bars")
    write_bars_monthly(views.bars_daily(spark, sf), root)
    return root


@query("scan_bars_partitioned", f"WITH {views.BARS_DAILY} SELECT {BAR_COLUMNS} FROM bars")
def scan_bars_partitioned(spark, sf):
    return bar_source.scan_bars_partitioned(spark, _stored_bars(spark, sf))


@query("select_prices", f"""WITH {views.BARS_DAILY} SELECT {BAR_COLUMNS} FROM bars
  WHERE stock IN ('P000001', 'P000002', 'P000003')
    AND date BETWEEN TIMESTAMP '1996-02-10' AND TIMESTAMP '1999-11-20'""")
def select_prices(spark, sf):
    return bar_source.select_prices(
        spark, _stored_bars(spark, sf), ["P000001", "P000002", "P000003"], "1996-02-10", "1999-11-20"
    )


TRADE_SQL = f"""WITH {views.TRADES}
  SELECT isin, trans_id, tick_id, price, volume, currency, trade_time, upper(feed_venue) AS exec_venue,
         volume >= 50 AS algo_indicator, CAST(NULL AS VARCHAR) AS market_mechanism
  FROM trades"""
TRADE_SAMPLE = ["isin", "trans_id", "tick_id", "price", "volume", "currency", "trade_time", "exec_venue",
                "algo_indicator", "market_mechanism"]


@query("ingest_trades_ndjson", TRADE_SQL)
def ingest_trades_ndjson(spark, sf):
    landing = scratch_dir(spark, "landing")
    views.trade_lines(spark, sf).select("value").write.option("compression", "gzip").text(landing)
    trades, _ = trade_source.parse_trades(trade_source.read_trade_lines(spark, landing))
    return trades.select(*TRADE_SAMPLE)


@query("scan_landing_day", f"""WITH {views.TRADES}
  SELECT feed_venue AS venue, strftime(trade_time, '%Y-%m-%d') AS date, count(*) AS trades,
         count(DISTINCT isin) AS isins FROM trades GROUP BY ALL""")
def scan_landing_day(spark, sf):
    from barlake.functions.names import parse_trade_filename

    parsed, _ = trade_source.parse_trades(views.trade_lines(spark, sf), keep_file=True)
    return parsed.withColumn("f", parse_trade_filename("file_name")).groupBy(
        F.col("f.venue").alias("venue"), F.col("f.date").alias("date")
    ).agg(F.count(F.lit(1)).alias("trades"), F.count_distinct("isin").alias("isins"))


# A line is spoiled by what it says, so the whole table is parsed.
BROKEN = f"""{views.TRADES}, broken AS (
  SELECT *, feed_venue || '-posttrade-' || strftime(trade_time, '%Y-%m-%dT%H_%M') || '.json.gz' AS file_name,
         CASE WHEN volume = 7 THEN 'malformed' WHEN volume = 8 THEN 'missing_field' WHEN volume = 9 THEN 'bad_time' END AS reason
  FROM trades)"""


def _broken_lines(spark, sf):
    lines = views.trade_lines(spark, sf)
    volume = F.get_json_object("value", "$.lastQty").cast("double")
    spoiled = (
        F.when(volume == 7, F.expr("substring(value, 1, length(value) - 5)"))
        .when(volume == 8, F.regexp_replace("value", '"isin":"[^"]*",', ""))
        .when(volume == 9, F.regexp_replace("value", '"lastTradeTime":"[^"]*"', '"lastTradeTime":"noon"'))
        .otherwise(F.col("value"))
    )
    # stored as a feed lands them: the test for blank lines would otherwise make every line a second time
    landing = scratch_dir(spark, "landing")
    lines.withColumn("value", spoiled).write.parquet(landing)
    return spark.read.parquet(landing)


@query("quarantine_trades", f"WITH {BROKEN} SELECT reason, count(*) AS lines FROM broken WHERE reason IS NOT NULL GROUP BY 1")
def quarantine_trades(spark, sf):
    _, bad = trade_source.parse_trades_by_row(_broken_lines(spark, sf))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query("row_mode_trades", f"WITH {BROKEN} SELECT isin, tick_id, price, volume FROM broken WHERE reason IS NULL")
def row_mode_trades(spark, sf):
    good, _ = trade_source.parse_trades_by_row(_broken_lines(spark, sf))
    return good.select("isin", "tick_id", "price", "volume")


@query("require_fields", f"""WITH {BROKEN}
  SELECT file_name, count(*) AS lines, count(*) FILTER (WHERE reason = 'malformed') AS malformed_lines,
         bool_and(coalesce(reason IN ('malformed', 'missing_field'), false)) AS isin_missing
  FROM broken GROUP BY file_name""")
def require_fields(spark, sf):
    report = trade_source.file_report(trade_source.decode_lines(_broken_lines(spark, sf)))
    return report.select(
        "file_name", "lines", "malformed_lines", F.col("missing_fields").contains("isin").alias("isin_missing")
    )


@query("rename_trade_fields", f"""WITH {views.TRADES}
  SELECT 'posttrade' AS message_id, 'ETR' AS source_name, isin AS instrument_id, '1' AS quote_type, tick_id FROM trades""")
def rename_trade_fields(spark, sf):
    decoded = trade_source.decode_lines(views.trade_lines(spark, sf))
    return trade_source.rename_trade_fields(decoded).select(
        "message_id", "source_name", "instrument_id", "quote_type", "tick_id"
    )


@query("parse_trade_times", """SELECT event_id AS tick_id, ts AS trade_time,
  ts - INTERVAL 2 HOUR AS from_zoned, ts AS from_bare FROM events""")
def parse_trade_times(spark, sf):
    from barlake.functions.calendar import iso_utc

    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("tick_id"),
        iso_utc(F.concat(text, F.lit("123Z"))).alias("trade_time"),
        iso_utc(F.concat(text, F.lit("+02:00"))).alias("from_zoned"),
        iso_utc(text).alias("from_bare"),
    )


@query("coerce_trade_types", """SELECT event_id AS tick_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price
  FROM events""")
def coerce_trade_types(spark, sf):
    e = table(spark, sf, "events")
    price = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    record = F.struct(F.col("event_id").cast("string").alias("tickId"), price.alias("lastTrade"))
    lines = e.select(F.to_json(record).alias("value"), F.lit("f").alias("file_name"))
    return trade_source.rename_trade_fields(trade_source.decode_lines(lines)).select("tick_id", "price")


@query("algo_flag", f"WITH {views.TRADES} SELECT volume >= 50 AS algo_indicator, count(*) AS trades FROM trades GROUP BY 1")
def algo_flag(spark, sf):
    parsed = trade_source.rename_trade_fields(trade_source.decode_lines(views.trade_lines(spark, sf)))
    return parsed.groupBy("algo_indicator").agg(F.count(F.lit(1)).alias("trades"))


@query("complete_trade_schema", f"""WITH {views.TRADES}
  SELECT tick_id, CAST(NULL AS VARCHAR) AS benchmark_flag, CAST(NULL AS VARCHAR) AS pub_deferral FROM trades""")
def complete_trade_schema(spark, sf):
    parsed = trade_source.rename_trade_fields(trade_source.decode_lines(views.trade_lines(spark, sf)))
    return trade_source.validate_trade_schema(parsed).select("tick_id", "benchmark_flag", "pub_deferral")


@query("trades_core_columns", f"""WITH {views.TRADES}
  SELECT isin, price, volume, currency, trade_time, upper(feed_venue) AS exec_venue, trans_id, tick_id,
         volume >= 50 AS algo_trade, 'ETR' AS source FROM trades""")
def trades_core_columns(spark, sf):
    parsed = trade_source.rename_trade_fields(trade_source.decode_lines(views.trade_lines(spark, sf)))
    return trade_source.trades_schema_projection(parsed)


@query("trades_extended_columns", f"""WITH {views.TRADES}
  SELECT tick_id, CAST(1 AS TINYINT) AS quote_type, CAST(NULL AS VARCHAR) AS trading_mode FROM trades""")
def trades_extended_columns(spark, sf):
    parsed = trade_source.rename_trade_fields(trade_source.decode_lines(views.trade_lines(spark, sf)))
    wide = trade_source.trades_schema_projection(parsed, extended=True)
    return wide.select("tick_id", "quote_type", "trading_mode")


@query("validate_trade_schema", "SELECT 'price' AS column_name, 'double' AS expected, 'string' AS found, count(*) AS rows FROM events")
def validate_trade_schema(spark, sf):
    parsed = trade_source.rename_trade_fields(trade_source.decode_lines(views.trade_lines(spark, sf)))
    problems = trade_source.schema_violations(parsed.withColumn("price", F.col("price").cast("string")))
    verdicts = F.array(*[F.struct(*[F.lit(v) for v in p]) for p in problems])
    return parsed.select(F.explode(verdicts).alias("p")).groupBy(
        F.col("p.col1").alias("column_name"), F.col("p.col2").alias("expected"), F.col("p.col3").alias("found")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("symbol_list", """SELECT DISTINCT c_name AS ticker, '2024-01-31' AS added_date, 'active' AS status,
  CAST(NULL AS VARCHAR) AS last_checked FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_acctbal > 0""")
def symbol_list(spark, sf):
    customers = table(spark, sf, "customer")
    frames = []
    for name, chosen in (
        ("nasdaq", F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), ("nyse", F.col("c_acctbal") > 0)
    ):
        path = scratch_dir(spark, name)
        named = F.concat(F.lit("Shares, of "), F.col("c_mktsegment"))
        customers.filter(chosen).select(F.col("c_name").alias("Symbol"), named.alias("Name")).write.csv(path, header=True)
        frames.append(listings.read_symbol_csv(spark, path))
    return listings.symbol_list(*frames, "2024-01-31")


@query("manifest_listing", f"""WITH {views.TRADES}, {views.MANIFEST} SELECT venue, file_name FROM manifest
  UNION ALL SELECT venue, 'readme.txt' FROM manifest GROUP BY 1""")
def manifest_listing(spark, sf):
    # one listing document per venue and hour, as each poll returns a bounded list
    stamp = F.regexp_extract("file_name", r"(\d{4}-\d{2}-\d{2}T.*)$", 1)
    prefix = F.concat("venue", F.lit("-posttrade-2024-01-31"))
    docs = (
        views.manifest(spark, sf)
        .withColumn("raw", F.concat(prefix, F.lit("-"), stamp))
        .groupBy("venue", F.substring(stamp, 1, 13).alias("hour"))
        .agg(F.collect_list("raw").alias("files"))
        .select("venue", F.to_json(F.struct(prefix.alias("SourcePrefix"), F.col("files").alias("CurrentFiles"))).alias("value"))
    )
    other = views.manifest(spark, sf).select("venue").distinct().select(
        "venue", F.to_json(F.struct(prefix.alias("SourcePrefix"), F.array(F.lit("readme.txt")).alias("CurrentFiles"))).alias("value")
    )
    return listings.manifest_listing(docs.unionByName(other), "venue")


@query("instrument_master", """SELECT printf('XX%010d', c_custkey) AS isin, lower(c_name) AS ticker, 'Inc ' || c_name AS name,
  'EUR' AS currency, CAST(c_custkey AS VARCHAR) AS wkn, 'active' AS status, DATE '2024-02-01' AS last_seen,
  'deutsche_boerse_csv' AS source FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'""")
def instrument_master(spark, sf):
    path = scratch_dir(spark, "instruments")
    header = spark.createDataFrame(
        [("Market:;XETR",), ("Date Last Update:;01.02.2024",),
         ("Product Status;Instrument Status;Instrument;ISIN;Mnemonic;Currency;WKN",)], "value string")
    rows = table(spark, sf, "customer").select(F.concat_ws(
        ";",
        F.when(F.col("c_acctbal") >= 0, "Active").otherwise("Inactive"),
        F.when(F.col("c_mktsegment") != "BUILDING", " Active ").otherwise("Suspended"),
        F.concat(F.lit("Inc "), F.col("c_name")), F.format_string("XX%010d ", "c_custkey"), F.upper("c_name"),
        F.lit("EUR"), F.col("c_custkey").cast("string"),
    ).alias("value"))
    header.coalesce(1).unionByName(rows).write.text(path)
    return listings.instrument_master(listings.read_instrument_csv(spark, path), "2024-02-01")


@query("instrument_violations", """SELECT printf('XX%010d', c_custkey % 1000) AS isin, 'ticker_length' AS rule FROM customer
  UNION ALL SELECT printf('XX%010d', c_custkey % 1000), 'duplicate_isin' FROM customer GROUP BY 1 HAVING count(*) > 1
  UNION ALL SELECT printf('XX%010d', c_custkey), 'short_line' FROM customer WHERE c_acctbal < 0""")
def instrument_violations(spark, sf):
    master = table(spark, sf, "customer").select(
        F.format_string("XX%010d", F.col("c_custkey") % 1000).alias("isin"), F.lower("c_name").alias("ticker"),
        F.lit("EUR").alias("currency"),
    )
    # a file in which the lines of some instruments end early
    path = scratch_dir(spark, "instruments")
    header = spark.createDataFrame([("Instrument;ISIN;Mnemonic",)], "value string")
    short = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit(";"), F.upper("c_name")))
    lines = table(spark, sf, "customer").select(F.concat(F.lit("Inc;"), F.format_string("XX%010d", "c_custkey"), short).alias("value"))
    header.coalesce(1).unionByName(lines).write.text(path)
    return listings.instrument_violations(master, listings.short_instrument_lines(spark, path))


@query("import_mapping", f"""WITH {views.MAPPINGS}, custom AS (SELECT isin, ticker AS custom_ticker FROM mapping_new)
  SELECT coalesce(o.isin, c.isin) AS isin, coalesce(custom_ticker, ticker) AS ticker, name, currency, wkn,
         CASE WHEN custom_ticker IS NOT NULL THEN 'active' ELSE status END AS status,
         coalesce(first_seen, DATE '2024-02-01') AS first_seen,
         CASE WHEN custom_ticker IS NOT NULL THEN DATE '2024-02-01' ELSE last_seen END AS last_seen,
         CASE WHEN custom_ticker IS NOT NULL THEN 'custom' ELSE source END AS source
  FROM mapping_old o FULL JOIN custom c ON o.isin = c.isin""")
def import_mapping(spark, sf):
    override = views.mapping_new(spark, sf).select("isin", F.upper("ticker").alias("ticker"))
    return listings.import_mapping(views.mapping_old(spark, sf), override, views.MAPPING_AS_OF)


@query("has_data", """SELECT 'click' AS venue, bool_or(event_type = 'click') AS has_data FROM events
  UNION ALL SELECT 'nowhere', false""")
def has_data(spark, sf):
    trades = views.trades(spark, sf)
    flags = [(v, bar_source.has_data(trades, v)) for v in ("click", "nowhere")]
    return spark.createDataFrame(flags, "venue string, has_data boolean")


@query("first_n_tickers", f"WITH {views.BARS_RAW} SELECT DISTINCT stock FROM bars_raw ORDER BY stock LIMIT 25")
def first_n_tickers(spark, sf):
    return bar_source.first_n_tickers(views.bars_raw(spark, sf), 25)


@query("sample_tickers", f"""WITH {views.BARS_RAW}, t AS (SELECT DISTINCT stock FROM bars_raw)
  SELECT stock FROM (SELECT stock FROM t ORDER BY md5(stock || '42'), stock LIMIT 25)""")
def sample_tickers(spark, sf):
    return bar_source.sample_tickers(views.bars_raw(spark, sf), 25, 42)


# Text-typed drift: volume comes with halves, prices with garbage.
@query("normalize_bars", f"""WITH {views.BARS_RAW}
  SELECT stock, date, price AS open, CAST(NULL AS DOUBLE) AS high, CASE WHEN volume = 13 THEN NULL ELSE price END AS low,
         price AS close, CAST(CASE WHEN volume % 2 = 0 THEN volume ELSE volume + 1 END AS BIGINT) AS volume,
         CAST(NULL AS BIGINT) AS sequence FROM bars_raw""")
def normalize_bars_query(spark, sf):
    raw = views.bars_raw(spark, sf)
    drifted = raw.select(
        "stock", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), F.col("open").cast("string").alias("open"),
        F.when(F.col("volume") == 13, "n/a").otherwise(F.col("low").cast("string")).alias("low"), "close",
        (F.col("volume") + 0.5).cast("string").alias("volume"),
        F.lit("dropped").alias("extra"),
    )
    return normalize_bars(drifted)


@query("normalize_vendor_history", f"""WITH {views.BARS_RAW}
  SELECT stock, timezone('America/New_York', timezone('UTC', CAST(date AS TIMESTAMP))) AS date, price AS open, volume FROM bars_raw""")
def normalize_vendor_history_query(spark, sf):
    raw = views.bars_raw(spark, sf).select(
        F.col("stock").alias("Stock"), F.col("date").cast("timestamp").alias("Date"), F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"),
    )
    out = normalize_vendor_history(raw, F.col("Stock"), "America/New_York")
    return out.select("stock", "date", "open", "volume")


@query("quarantine_null_dates", f"""WITH {views.BARS_RAW}
  SELECT stock, count(*) AS quarantined FROM bars_raw WHERE sequence IS NULL GROUP BY 1""")
def quarantine_null_dates(spark, sf):
    raw = views.bars_raw(spark, sf)
    undated = raw.withColumn("date", F.when(F.col("sequence").isNotNull(), F.col("date")))
    _, bad = split_null_dates(normalize_bars(undated))
    return bad.groupBy("stock").agg(F.count(F.lit(1)).alias("quarantined"))


@query("recover_sequence", """SELECT printf('P%06d', l_partkey) AS stock, l_shipdate AS date,
  CAST(l_linenumber AS BIGINT) AS sequence, true AS sequence_recovered FROM lineitem""")
def recover_sequence_query(spark, sf):
    stored = table(spark, sf, "lineitem").select(
        F.format_string("P%06d", "l_partkey").alias("stock"), F.col("l_shipdate").alias("date"),
        F.col("l_linenumber").cast("double").alias("index"), F.col("_metadata.file_path").alias("file_path"),
    )
    return recover_sequence(stored).select("stock", "date", "sequence", "sequence_recovered")


@query("dedupe_bars", f"WITH {views.BAR_VERSIONS} {DEDUPED}")
def dedupe_bars_query(spark, sf):
    return dedupe_bars(views.bar_versions(spark, sf).select(*BARS.names))


@query("dedupe_trades", f"WITH {views.TRADES} SELECT isin, trade_time, price, volume, trans_id FROM trades")
def dedupe_trades_query(spark, sf):
    return dedupe_trades(views.trades_dup(spark, sf)).select("isin", "trade_time", "price", "volume", "trans_id")


@query("dedupe_log", f"""WITH {views.TRADES}
  SELECT feed_venue AS venue, strftime(trade_time, '%Y-%m-%d') AS date, strftime(trade_time, '%Y-%m-%dT%H_%M') AS timestamp,
         true AS has_data, max(tick_id) AS trade_count,
         max(trade_time) AS downloaded_at FROM trades GROUP BY ALL""")
def dedupe_log_query(spark, sf):
    from barlake.functions.names import minute_key

    log = views.trades(spark, sf).select(
        F.col("feed_venue").alias("venue"), F.to_date("trade_time").cast("string").alias("date"),
        minute_key("trade_time").alias("timestamp"), F.lit(True).alias("has_data"),
        F.col("tick_id").alias("trade_count"), F.col("trade_time").alias("downloaded_at"),
    )
    return dedupe_log(log)


@query("sequence_number", f"""WITH {views.TRADES}
  SELECT feed_venue, tick_id, row_number() OVER (PARTITION BY feed_venue, date_trunc('minute', trade_time) ORDER BY trade_time, tick_id) - 1 AS sequence
  FROM trades""")
def sequence_number(spark, sf):
    from barlake.operators.ingest import sequence_in_file

    t = views.trades(spark, sf).withColumn("file_name", trade_filename("feed_venue", "trade_time"))
    return sequence_in_file(t).select("feed_venue", "tick_id", "sequence")


@query("source_to_price_volume", f"""WITH {views.BARS_DAILY}, {views.TRADES}
  SELECT isin AS instrument, trade_time AS ts, price, volume FROM trades
  UNION ALL SELECT stock, date, close, CAST(volume AS DOUBLE) FROM bars""")
def source_to_price_volume_query(spark, sf):
    return source_to_price_volume(views.trades(spark, sf), "xetra").unionByName(
        source_to_price_volume(views.bars_daily(spark, sf), "yahoo")
    )


@query("partition_columns", f"""WITH {views.TRADES}
  SELECT tick_id, strftime(trade_time, '%Y') AS year, strftime(trade_time, '%m') AS month,
         'de/xetra/' || lower(feed_venue) || '_1m' AS path FROM trades""")
def partition_columns(spark, sf):
    from barlake.functions.names import dataset_path

    return views.trades(spark, sf).select(
        "tick_id", partition_year("trade_time").alias("year"), partition_month("trade_time").alias("month"),
        dataset_path(F.lit(" DE "), F.lit("Xetra"), F.upper("feed_venue"), F.lit("1M ")).alias("path"),
    )


@query("infer_layout_from_path", """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN lower(c_mktsegment) END AS interval,
  CASE WHEN c_acctbal >= 0 THEN c_name END AS ticker FROM customer""")
def infer_layout_from_path(spark, sf):
    path = F.concat(
        F.lit("/data/"), F.when(F.col("c_acctbal") >= 0, "stocks_").otherwise("other_"),
        F.lower("c_mktsegment"), F.lit("/"), F.col("c_name"), F.lit(".parquet"),
    )
    return table(spark, sf, "customer").select("c_custkey", infer_layout(path).alias("l")).select(
        "c_custkey", "l.interval", "l.ticker"
    )


@query("parse_trade_filename", f"""WITH {views.TRADES}, {views.MANIFEST}
  SELECT file_name, venue, 'posttrade' AS kind, date, minute FROM manifest""")
def parse_trade_filename_query(spark, sf):
    from barlake.functions.names import parse_trade_filename

    return views.manifest(spark, sf).select("file_name", parse_trade_filename("file_name").alias("p")).select(
        "file_name", "p.venue", "p.kind", "p.date", "p.minute"
    )
