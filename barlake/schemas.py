"""Fixed table schemas and their empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """Flat schema from ``name TYPE, …``; needs no session, unlike DDL parsing."""
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BARS = _struct(
    "stock STRING, date TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume BIGINT, sequence BIGINT"
)
BAR_KEY = ["stock", "date"]
BAR_PRICES = ["open", "high", "low", "close"]
BAR_COUNTS = ["volume", "sequence"]

# Vendor JSON key, column name, column type of a trade record.
# The execution segment is called exec_venue here, because the lake partitions
# by the feed's own venue code and a partition column of the same name would
# hide the one stored in the file.
TRADE_FIELDS = [
    ("messageId", "message_id", "STRING"),
    ("sourceName", "source_name", "STRING"),
    ("isin", "isin", "STRING"),
    ("instrumentId", "instrument_id", "STRING"),
    ("transIdCode", "trans_id", "STRING"),
    ("tickId", "tick_id", "BIGINT"),
    ("lastTrade", "price", "DOUBLE"),
    ("lastQty", "volume", "DOUBLE"),
    ("currency", "currency", "STRING"),
    ("quotationType", "quote_type", "STRING"),
    ("lastTradeTime", "trade_time", "TIMESTAMP_NTZ"),
    ("distributionDateTime", "distribution_time", "TIMESTAMP_NTZ"),
    ("executionVenueId", "exec_venue", "STRING"),
    ("tickActionIndicator", "tick_action", "STRING"),
    ("instrumentIdCode", "instrument_code", "STRING"),
    ("mmtMarketMechanism", "market_mechanism", "STRING"),
    ("mmtTradingMode", "trading_mode", "STRING"),
    ("mmtNegotTransPretrdWaivInd", "negotiated_flag", "STRING"),
    ("mmtModificationInd", "modification_flag", "STRING"),
    ("mmtBenchmarkRefprcInd", "benchmark_flag", "STRING"),
    ("mmtPubModeDefReason", "pub_deferral", "STRING"),
    ("mmtAlgoInd", "algo_indicator", "BOOLEAN"),
]
# Vendor keys every trade file has to carry.
REQUIRED_TRADE_KEYS = [
    "isin",
    "lastTrade",
    "lastQty",
    "currency",
    "lastTradeTime",
    "transIdCode",
    "tickId",
]
# The ten core columns and the eight that extend them.
CORE_TRADE_COLUMNS = [
    "isin",
    "price",
    "volume",
    "currency",
    "trade_time",
    "exec_venue",
    "trans_id",
    "tick_id",
    "algo_trade",
    "source",
]
EXTENDED_TRADE_COLUMNS = CORE_TRADE_COLUMNS + [
    "distribution_time",
    "quote_type",
    "market_mechanism",
    "trading_mode",
    "negotiated_flag",
    "modification_flag",
    "benchmark_flag",
    "pub_deferral",
]

TRADES = _struct(", ".join(f"{column} {kind}" for _, column, kind in TRADE_FIELDS))
RAW_TRADE = _struct(", ".join(f"{key} STRING" for key, _, _ in TRADE_FIELDS))
TRADE_COLUMN_OF = {key: column for key, column, _ in TRADE_FIELDS}

DOWNLOAD_LOG = _struct(
    "venue STRING, date STRING, timestamp STRING, has_data BOOLEAN, "
    "trade_count BIGINT, downloaded_at TIMESTAMP_NTZ"
)
TICKERS = _struct("ticker STRING, added_date STRING, status STRING, last_checked STRING")
STORAGE = _struct(
    "mode STRING, market STRING, source STRING, dataset STRING, root STRING, venue STRING, "
    "verified_at STRING"
)
INTERVALS = T.StructType(
    _struct(
        "ticker STRING, interval STRING, status STRING, last_found_date STRING, "
        "last_data_date STRING, last_not_found_date STRING, last_checked STRING"
    ).fields
    + [T.StructField("storage", STORAGE)]
)
MAPPING = _struct(
    "isin STRING, ticker STRING, name STRING, currency STRING, wkn STRING, "
    "status STRING, first_seen DATE, last_seen DATE, source STRING"
)

# The thirteen bar intervals.
BAR_INTERVALS = [
    "1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h", "1d", "5d", "1wk", "1mo", "3mo",
]
HOURLY_INTERVALS = ["60m", "90m", "1h"]
MINUTE_INTERVALS = ["1m", "2m", "5m", "15m", "30m"]


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_bars(spark: SparkSession) -> DataFrame:
    return empty_table(spark, BARS)


def empty_trades(spark: SparkSession) -> DataFrame:
    return empty_table(spark, TRADES)
