"""The reference tables of the domain, seen in the given parquet tables.

Each view exists twice: as a DataFrame for the queries, and as a SQL common
table expression for their oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.names import trade_filename
from barlake.schemas import BARS, MAPPING


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def padded(prefix: str, number: str, width: int) -> Column:
    """``printf('<prefix>%0<width>d', number)``: a number of more digits stays whole, where ``lpad`` alone would cut it."""
    digits = F.col(number).cast("string")
    whole = F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))
    return F.when(F.col(number) < 0, F.format_string(f"{prefix}%0{width}d", number)).otherwise(whole)


def volume_of(props: str) -> Column:
    return F.regexp_extract(props, '"k": *([0-9]+)', 1).cast("double")


# --- trades ------------------------------------------------------------------

TRADES = """trades AS (
  SELECT printf('XX%010d', user_id) AS isin, ts AS trade_time, value AS price,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS volume,
         event_id AS tick_id, CAST(event_id AS VARCHAR) AS trans_id,
         event_type AS feed_venue, 'EUR' AS currency
  FROM events)"""


def trades(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        padded("XX", "user_id", 10).alias("isin"),
        F.col("ts").alias("trade_time"),
        F.col("value").alias("price"),
        volume_of("props").alias("volume"),
        F.col("event_id").alias("tick_id"),
        F.col("event_id").cast("string").alias("trans_id"),
        F.col("event_type").alias("feed_venue"),
        F.lit("EUR").alias("currency"),
    )


def trades_dup(spark: SparkSession, sf: str) -> DataFrame:
    """Trades, and a second delivery of the small ones."""
    once = trades(spark, sf)
    again = once.filter(F.col("volume") < 10)
    return once.withColumn("batch_rank", F.lit(0)).unionByName(again.withColumn("batch_rank", F.lit(1)))


def trade_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(trades(spark, sf))


def lines_of(t: DataFrame) -> DataFrame:
    """One vendor JSON line per trade, with the name of the file it came in."""
    record = F.struct(
        F.lit("posttrade").alias("messageId"),
        F.lit("ETR").alias("sourceName"),
        F.col("isin"),
        F.col("isin").alias("instrumentId"),
        F.col("trans_id").alias("transIdCode"),
        F.col("tick_id").alias("tickId"),
        F.col("price").alias("lastTrade"),
        F.col("volume").alias("lastQty"),
        F.col("currency"),
        F.lit("1").alias("quotationType"),
        F.concat(F.date_format("trade_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z")).alias("lastTradeTime"),
        F.upper("feed_venue").alias("executionVenueId"),
        F.when(F.col("volume") >= 50, "H").otherwise("-").alias("mmtAlgoInd"),
        F.lit("extra").alias("unknownKey"),
    )
    return t.select(F.to_json(record).alias("value"), trade_filename("feed_venue", "trade_time").alias("file_name"))


MANIFEST = """manifest AS (
  SELECT DISTINCT feed_venue AS venue,
         feed_venue || '-posttrade-' || strftime(trade_time, '%Y-%m-%dT%H_%M') || '.json.gz' AS file_name,
         strftime(trade_time, '%Y-%m-%d') AS date,
         strftime(trade_time, '%Y-%m-%dT%H_%M') AS minute
  FROM trades)"""
# The log stops in the middle of the month: the resumed-run case.
DOWNLOAD_LOG = """log AS (
  SELECT venue, date, minute AS timestamp, true AS has_data, 1 AS trade_count,
         TIMESTAMP '2024-02-01 00:00:00' AS downloaded_at
  FROM manifest WHERE date[9:10] <= '15')"""


# Bar intervals of the registry proxy.
STORED_INTERVALS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return trades(spark, sf).select(
        F.col("feed_venue").alias("venue"), trade_filename("feed_venue", "trade_time").alias("file_name")
    ).distinct()


def download_log(spark: SparkSession, sf: str) -> DataFrame:
    from barlake.functions.names import parse_trade_filename

    parsed = manifest(spark, sf).withColumn("p", parse_trade_filename("file_name"))
    return parsed.filter(F.substring("p.date", 9, 2) <= "15").select(
        "venue", F.col("p.date").alias("date"), F.col("p.minute").alias("timestamp"),
        F.lit(True).alias("has_data"), F.lit(1).cast("bigint").alias("trade_count"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("downloaded_at"),
    )


# --- bars --------------------------------------------------------------------

BARS_RAW = """bars_raw AS (
  SELECT printf('P%06d', l_partkey) AS stock, l_shipdate AS date,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
         CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS BIGINT) END AS sequence,
         l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag
  FROM lineitem)"""
BARS_DAILY = BARS_RAW + """, bars AS (
  SELECT stock, date,
         first(price ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS open,
         max(price) AS high, min(price) AS low,
         last(price ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS close,
         CAST(sum(volume) AS BIGINT) AS volume, CAST(NULL AS BIGINT) AS sequence
  FROM bars_raw GROUP BY stock, date)"""
# Several versions of one bar per month, some without a sequence.
BAR_VERSIONS = BARS_RAW + """, versions AS (
  SELECT stock, CAST(date_trunc('month', date) AS TIMESTAMP) AS date, price AS open,
         price AS high, price AS low, price AS close, volume, sequence, l_returnflag
  FROM bars_raw)"""


def bars_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item as a bar, duplicates of (stock, date) included."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        padded("P", "l_partkey", 6).alias("stock"),
        F.col("l_shipdate").alias("date"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("bigint")).alias("sequence"),
        "l_returnflag",
    )


def bars_daily(spark: SparkSession, sf: str) -> DataFrame:
    """One bar per (stock, date), opened and closed by order, line, quantity and amount.

    The four are packed in one number, which keeps the aggregate hash-based.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    line = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    amount = F.col("l_quantity").cast("bigint") * 10**12 + F.round(F.col("l_extendedprice") * 100).cast("bigint")
    order = (line.cast("decimal(19,0)") * F.lit(10**15).cast("decimal(16,0)") + amount).cast("decimal(38,0)")
    return (
        table(spark, sf, "lineitem")
        .groupBy(padded("P", "l_partkey", 6).alias("stock"), F.col("l_shipdate").alias("date"))
        .agg(
            F.min_by(price, order).alias("open"), F.max(price).alias("high"),
            F.min(price).alias("low"), F.max_by(price, order).alias("close"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
        )
        .withColumn("sequence", F.lit(None).cast("bigint"))
        .select(*BARS.names)
    )


def bar_versions(spark: SparkSession, sf: str) -> DataFrame:
    return bars_raw(spark, sf).withColumn("date", F.trunc(F.to_date("date"), "month").cast("timestamp_ntz"))


HOUR_BARS = TRADES + """, hour_bars AS (
  SELECT isin AS stock, date_trunc('hour', trade_time) AS date,
         first(price ORDER BY trade_time, tick_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY trade_time, tick_id) AS close, sum(volume) AS volume,
         count(*) AS trade_count, sum(price * volume) / sum(volume) AS vwap
  FROM trades GROUP BY ALL HAVING sum(volume) > 0)"""


def hour_bars(spark: SparkSession, sf: str) -> DataFrame:
    from barlake.operators.bars import ohlcv_from_trades

    return ohlcv_from_trades(trades(spark, sf), "1h").select(
        F.col("isin").alias("stock"), F.col("bar").alias("date"),
        "open", "high", "low", "close", "volume", "trade_count", "vwap",
    )


# --- registry ----------------------------------------------------------------

REGISTRY_AS_OF = "2001-08-15"
# Orders are the fetch history: an open order found data, any other did not.
REGISTRY = """tickers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ticker, '1994-12-31' AS added_date,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'not_found' ELSE 'active' END AS status,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE '2001-08-01' END AS last_checked
  FROM customer), intervals AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderpriority AS interval,
         CASE WHEN last(o_orderstatus ORDER BY o_orderdate, o_orderkey) = 'O' THEN 'active' ELSE 'not_found' END AS status,
         strftime(max(o_orderdate) FILTER (WHERE o_orderstatus = 'O'), '%Y-%m-%d') AS last_found_date,
         strftime(max(o_orderdate), '%Y-%m-%d') AS last_data_date,
         CASE WHEN sum(o_totalprice) > 900000 THEN 'unreadable'
              ELSE strftime(max(o_orderdate) FILTER (WHERE o_orderstatus <> 'O'), '%Y-%m-%d') END AS last_not_found_date,
         strftime(max(o_orderdate), '%Y-%m-%d') AS last_checked
  FROM orders GROUP BY o_custkey, o_orderpriority)"""


def registry(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    day = "yyyy-MM-dd"
    tickers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.lit("1994-12-31").alias("added_date"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "not_found").otherwise("active").alias("status"),
        F.when(~(F.col("c_acctbal") < 0), "2001-08-01").alias("last_checked"),
    )
    opened, date = F.col("o_orderstatus") == "O", F.col("o_orderdate")
    storage = "struct<mode:string,market:string,source:string,dataset:string,root:string,venue:string,verified_at:string>"
    intervals = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderpriority").alias("interval"))
        .agg(
            F.when(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")) == "O", "active")
            .otherwise("not_found").alias("status"),
            F.date_format(F.max(F.when(opened, date)), day).alias("last_found_date"),
            F.date_format(F.max(date), day).alias("last_data_date"),
            F.when(F.sum("o_totalprice") > 900000, "unreadable")
            .otherwise(F.date_format(F.max(F.when(~opened, date)), day)).alias("last_not_found_date"),
            F.date_format(F.max(date), day).alias("last_checked"),
        )
        .withColumn("storage", F.lit(None).cast(storage))
    )
    return tickers, intervals


# --- mapping -----------------------------------------------------------------

MAPPING_AS_OF = "2024-02-01"
# Customers are instruments; old and new list differ by region and balance.
MAPPINGS = """mapping_old AS (
  SELECT printf('XX%010d', c_custkey) AS isin, lower(c_name) AS ticker, c_name AS name, 'EUR' AS currency,
         CAST(c_custkey AS VARCHAR) AS wkn, 'active' AS status, DATE '2023-06-01' AS first_seen,
         CASE WHEN c_acctbal < 0 THEN DATE '2023-12-01' ELSE DATE '2024-01-31' END AS last_seen, 'list' AS source
  FROM customer WHERE c_mktsegment <> 'BUILDING'), mapping_new AS (
  SELECT printf('XX%010d', c_custkey) AS isin,
         CASE WHEN c_acctbal > 9000 THEN 'n' || lower(c_name) ELSE lower(c_name) END AS ticker, c_name AS name,
         'EUR' AS currency, CAST(c_custkey AS VARCHAR) AS wkn, 'active' AS status,
         DATE '2024-02-01' AS last_seen, 'list' AS source
  FROM customer WHERE c_mktsegment <> 'FURNITURE')"""


def mapping_old(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(
        padded("XX", "c_custkey", 10).alias("isin"),
        F.lower("c_name").alias("ticker"), F.col("c_name").alias("name"), F.lit("EUR").alias("currency"),
        F.col("c_custkey").cast("string").alias("wkn"), F.lit("active").alias("status"),
        F.lit("2023-06-01").cast("date").alias("first_seen"),
        F.when(F.col("c_acctbal") < 0, "2023-12-01").otherwise("2024-01-31").cast("date").alias("last_seen"),
        F.lit("list").alias("source"),
    ).select(*MAPPING.names)


def mapping_new(spark: SparkSession, sf: str) -> DataFrame:
    renamed = F.when(F.col("c_acctbal") > 9000, F.concat(F.lit("n"), F.lower("c_name"))).otherwise(F.lower("c_name"))
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") != "FURNITURE").select(
        padded("XX", "c_custkey", 10).alias("isin"), renamed.alias("ticker"),
        F.col("c_name").alias("name"), F.lit("EUR").alias("currency"),
        F.col("c_custkey").cast("string").alias("wkn"), F.lit("active").alias("status"),
        F.lit("2024-02-01").cast("date").alias("last_seen"), F.lit("list").alias("source"),
    )


def splits(spark: SparkSession, sf: str) -> DataFrame:
    """One or two splits for the smaller parts."""
    part = table(spark, sf, "part").filter(F.col("p_size") <= 10)
    stock = padded("P", "p_partkey", 6).alias("stock")
    first = part.select(stock, F.lit("1998-01-01 00:00:00").cast("timestamp_ntz").alias("date"), F.lit(2.0).alias("ratio"))
    second = part.filter(F.col("p_size") <= 5).select(
        stock, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("date"), F.lit(4.0).alias("ratio")
    )
    return first.unionByName(second)


SPLITS = """splits AS (
  SELECT printf('P%06d', p_partkey) AS stock, TIMESTAMP '1998-01-01 00:00:00' AS date, CAST(2.0 AS DOUBLE) AS ratio
  FROM part WHERE p_size <= 10
  UNION ALL
  SELECT printf('P%06d', p_partkey), TIMESTAMP '2000-01-01 00:00:00', CAST(4.0 AS DOUBLE)
  FROM part WHERE p_size <= 5)"""
