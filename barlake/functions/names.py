"""File names, partition values and layout paths as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.functions.calendar import col

# Fixed format: VENUE-type-YYYY-MM-DDTHH_MM.json.gz
TRADE_FILE = r"^(.+)-([a-z]+)-(\d{4}-\d{2}-\d{2})T(\d{2}_\d{2})\.json\.gz$"
# The partition folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
FLAT_LAYOUT = r"stocks_([^/]+)/([^/]+)\.parquet$"


def parse_trade_filename(name: Column | str) -> Column:
    """Struct of venue, kind, date and minute key; null when the name does not fit.

    One pattern decides; the fields are then cut by position from the end, where
    ``YYYY-MM-DDTHH_MM.json.gz`` takes 24 characters.
    """
    n = col(name)
    lead = n.substr(F.lit(1), F.length(n) - 25)
    kind = F.substring_index(lead, "-", -1)
    fields = {
        "venue": lead.substr(F.lit(1), F.length(lead) - F.length(kind) - 1),
        "kind": kind,
        "date": n.substr(F.length(n) - 23, F.lit(10)),
        "minute": n.substr(F.length(n) - 23, F.lit(16)),
    }
    return F.when(n.rlike(TRADE_FILE), F.struct(*[c.alias(k) for k, c in fields.items()]))


def file_date(name: Column | str) -> Column:
    """The ten characters before the last T, when they look like a date."""
    return F.nullif(F.regexp_extract(col(name), r"(\d{4}-\d{2}-\d{2})T[^T]*$", 1), F.lit(""))


def trade_filename(venue: Column | str, ts: Column | str) -> Column:
    return F.concat(col(venue), F.lit("-posttrade-"), minute_key(ts), F.lit(".json.gz"))


def _text(ts: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS…``; the text of a zoneless timestamp does not depend on the session."""
    return col(ts).cast("string")


def minute_key(ts: Column | str) -> Column:
    """The minute as the feed writes it: YYYY-MM-DDTHH_MM."""
    t = _text(ts)
    return F.concat(
        F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 2), F.lit("_"), F.substring(t, 15, 2)
    )


def partition_year(ts: Column | str) -> Column:
    return F.substring(_text(ts), 1, 4)


def partition_month(ts: Column | str) -> Column:
    return F.substring(_text(ts), 6, 2)


def partition_day(ts: Column | str) -> Column:
    return F.substring(_text(ts), 9, 2)


def partition_part(text: Column | str) -> Column:
    """Market, source, dataset and interval names are trimmed lower case."""
    return F.lower(F.trim(col(text)))


def dataset_path(market: Column, source: Column, dataset: Column, interval: Column) -> Column:
    return F.concat_ws(
        "/",
        partition_part(market),
        partition_part(source),
        F.concat_ws("_", partition_part(dataset), partition_part(interval)),
    )


def infer_layout(path: Column | str) -> Column:
    """Struct of interval and ticker of a flat per-ticker file, null when it is none."""
    p = col(path)
    fits = p.rlike(FLAT_LAYOUT)
    return F.struct(
        F.when(fits, F.regexp_extract(p, FLAT_LAYOUT, 1)).alias("interval"),
        F.when(fits, F.regexp_extract(p, FLAT_LAYOUT, 2)).alias("ticker"),
    )
