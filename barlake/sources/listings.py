"""Symbol lists, file listings and the instrument master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.schemas import MAPPING, TICKERS

LISTING = T.StructType([
    T.StructField("SourcePrefix", T.StringType()),
    T.StructField("CurrentFiles", T.ArrayType(T.StringType())),
])


def read_symbol_csv(spark: SparkSession, path: str) -> DataFrame:
    """First field of a listing with a header; quoted fields keep their commas."""
    frame = spark.read.option("header", "true").csv(path)
    return frame.select(F.col(f"`{frame.columns[0]}`").alias("ticker"))


def symbol_list(nasdaq: DataFrame, nyse: DataFrame, added: str) -> DataFrame:
    """Union of both lists as new active tickers; the first one ends in a File… footer line."""
    first = nasdaq.filter(~F.col("ticker").startswith("File"))
    return (
        first.unionByName(nyse)
        .filter(F.col("ticker").isNotNull() & (F.col("ticker") != ""))
        .distinct()
        .select(
            "ticker",
            F.lit(added).alias("added_date"),
            F.lit("active").alias("status"),
            F.lit(None).cast("string").alias("last_checked"),
        )
        .select(*TICKERS.names)
    )


def manifest_listing(listings: DataFrame, venue: Column | str, kind: str = "posttrade") -> DataFrame:
    """Clean file names of JSON listings ``{SourcePrefix, CurrentFiles}`` in column ``value``."""
    venue = F.col(venue) if isinstance(venue, str) else venue
    lead = F.concat("listing.SourcePrefix", F.lit("-"))
    prefixed = (F.length("listing.SourcePrefix") > 0) & F.col("raw").startswith(lead)
    clean = F.concat(venue, F.lit(f"-{kind}-"), F.expr("substring(raw, length(listing.SourcePrefix) + 2)"))
    return (
        listings.withColumn("listing", F.from_json("value", LISTING))
        .withColumn("raw", F.explode("listing.CurrentFiles"))
        .select(venue.alias("venue"), F.when(prefixed, clean).otherwise(F.col("raw")).alias("file_name"))
    )


# Columns of the exchange's instrument list that are kept.
MASTER_COLUMNS = {
    "isin": "ISIN",
    "ticker": "Mnemonic",
    "name": "Instrument",
    "currency": "Currency",
    "wkn": "WKN",
    "product_status": "Product Status",
    "instrument_status": "Instrument Status",
}


def read_instrument_csv(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon file with two metadata lines above its header.

    The header is found by its text, so any number of tasks may read the file.
    Lines with fewer fields than the header are told by ``short_instrument_lines``.
    """
    lines, header, header_row = _instrument_lines(spark, path)
    body = lines.filter(~_is_short(header) & (F.col("value") != header_row))
    schema = ", ".join(f"`{h}` STRING" for h in header)
    return body.select(F.from_csv("value", schema, {"sep": ";"}).alias("r")).select("r.*")


def short_instrument_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): lines below the header that lack fields; blank ones are none."""
    lines, header, _ = _instrument_lines(spark, path)
    above = F.col("value").rlike(r"^(Market|Date Last Update):;")
    return lines.filter(_is_short(header) & (F.trim("value") != "") & ~above)


def _is_short(header: list[str]) -> Column:
    return F.size(F.split("value", ";")) < len(header)


def _instrument_lines(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], str]:
    lines = spark.read.text(path)
    header_row = lines.filter(F.col("value").contains("ISIN;") | F.col("value").endswith(";ISIN")).first()
    if header_row is None:
        raise ValueError("no header line with an ISIN column")
    return lines, [h.strip() for h in header_row[0].split(";")], header_row[0]


def instrument_master(raw: DataFrame, as_of: str) -> DataFrame:
    """Trimmed, lower-case tickers of active instruments."""
    trimmed = raw.select(*[F.trim(F.col(f"`{s}`")).alias(n) for n, s in MASTER_COLUMNS.items()])
    return trimmed.filter(
        (F.col("product_status") == "Active") & (F.col("instrument_status") == "Active")
    ).select(
        "isin",
        F.lower("ticker").alias("ticker"),
        "name",
        "currency",
        "wkn",
        F.lit("active").alias("status"),
        F.lit(as_of).cast("date").alias("last_seen"),
        F.lit("deutsche_boerse_csv").alias("source"),
    )


def instrument_violations(master: DataFrame, short: DataFrame | None = None) -> DataFrame:
    """(isin, rule) for wrong lengths and repeated identifiers, and for lines that lack fields.

    A short line has no columns to trust; the isin is whatever in it looks like one.
    """
    rules = F.array_compact(
        F.array(
            F.when(F.coalesce(F.length("isin"), F.lit(0)) != 12, "isin_length"),
            F.when(~F.coalesce(F.length("ticker"), F.lit(0)).between(1, 10), "ticker_length"),
            F.when(F.coalesce(F.length("currency"), F.lit(0)) != 3, "currency_length"),
        )
    )
    broken = master.select("isin", F.explode(rules).alias("rule"))
    repeated = (
        master.groupBy("isin").count().filter("count > 1").select("isin", F.lit("duplicate_isin").alias("rule"))
    )
    found = broken.unionByName(repeated)
    if short is None:
        return found
    isin = F.nullif(F.regexp_extract("value", r"\b([A-Z]{2}[A-Z0-9]{10})\b", 1), F.lit(""))
    return found.unionByName(short.select(isin.alias("isin"), F.lit("short_line").alias("rule")))


def import_mapping(current: DataFrame, override: DataFrame, as_of: str) -> DataFrame:
    """Mapping with a custom isin-to-ticker list laid over it; the list wins."""
    custom = override.select(
        F.trim("isin").alias("isin"), F.lower(F.trim("ticker")).alias("_ticker")
    ).filter(F.length("isin") > 0)
    day = F.lit(as_of).cast("date")
    joined = current.join(custom, "isin", "full_outer")
    is_custom = F.col("_ticker").isNotNull()
    replace = {
        "ticker": F.coalesce("_ticker", "ticker"),
        "status": F.when(is_custom, "active").otherwise(F.col("status")),
        "first_seen": F.coalesce("first_seen", day),
        "last_seen": F.when(is_custom, day).otherwise(F.col("last_seen")),
        "source": F.when(is_custom, "custom").otherwise(F.col("source")),
    }
    return joined.select(*[replace.get(c, F.col(c)).alias(c) for c in MAPPING.names])
