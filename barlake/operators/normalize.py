"""Schema normalisation of bars and vendor history (bad values become null)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.calendar import to_zone
from barlake.schemas import BAR_COUNTS, BAR_KEY, BAR_PRICES, BARS


def _timestamp(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    return F.col(name).try_cast("timestamp_ntz")


def _count(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.LongType):
        return F.col(name)
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    # Halves round to even. NaN and infinity have no integer and become null.
    number = F.col(name).try_cast("double")
    whole = F.bround(number.try_cast("decimal(38,6)"), 0)
    return F.coalesce(F.col(name).try_cast("string").try_cast("bigint"), whole.try_cast("bigint"))


def normalize_bars(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fixed columns, order and types; absent columns come back as typed nulls. Columns in ``keep`` stay behind them."""
    present = set(df.columns)
    out = []
    for field in BARS.fields:
        name = field.name
        if name not in present:
            value = F.lit(None)
        elif name == "date":
            value = _timestamp(df, name)
        elif name in BAR_PRICES:
            value = F.col(name).try_cast("double")
        elif name in BAR_COUNTS:
            value = _count(df, name)
        else:
            value = F.col(name)
        out.append(value.cast(field.dataType).alias(name))
    return df.select(*out, *keep)


def normalize_vendor_history(
    df: DataFrame,
    stock: Column | str,
    market_zone: str | None = None,
    index: str = "Date",
) -> DataFrame:
    """Vendor columns to lower case, index to market-local ``date``, stock added.

    A zoned (UTC instant) index is turned to wall clock in ``market_zone``.
    """
    stock = F.lit(stock) if isinstance(stock, str) else stock
    date = F.col(index)
    if isinstance(df.schema[index].dataType, T.TimestampType):
        wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), date.cast("timestamp_ntz"))
        date = to_zone(wall, market_zone) if market_zone else wall
    else:
        date = date.cast("timestamp_ntz")
    values = {c.lower(): c for c in df.columns if c != index}
    return df.select(
        stock.cast("string").alias("stock"),
        date.alias("date"),
        *[F.col(values[c]).alias(c) for c in [*BAR_PRICES, "volume"]],
    )


def split_null_dates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can be placed in a month, and those to quarantine."""
    return df.filter(F.col("date").isNotNull()), df.filter(F.col("date").isNull())


def recover_sequence(df: DataFrame, file: str = "file_path", row_index: str = "row_index") -> DataFrame:
    """Fill a missing ``sequence`` per file.

    Without a stored index the position in the file is the sequence. A stored
    ``index`` column is promoted when, in its file, every value is a whole
    number and they are not all epoch nanoseconds from the year 2000 on. The
    flag ``sequence_recovered`` tells which files now have a sequence.
    """
    if "sequence" in df.columns:
        return df.withColumn("sequence_recovered", F.lit(True))
    if "index" not in df.columns:
        return df.withColumn("sequence", F.col(row_index).cast("bigint")).withColumn(
            "sequence_recovered", F.lit(True)
        )
    if isinstance(df.schema["index"].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.withColumn("sequence", F.lit(None).cast("bigint")).withColumn(
            "sequence_recovered", F.lit(False)
        )
    number = F.col("index").try_cast("double")
    whole = F.coalesce(number == F.floor(number), F.lit(False))
    # Fixed value: nanoseconds from the epoch to 2000-01-01.
    recent = number >= F.lit(946_684_800_000_000_000)
    verdict = df.groupBy(file).agg(
        (F.bool_and(whole) & ~F.bool_and(F.coalesce(recent, F.lit(False)))).alias("sequence_recovered")
    )
    # one small row per file goes to every task; a shuffle by file would put a large file in one
    return (
        df.join(F.broadcast(verdict), file)
        .withColumn(
            "sequence",
            F.when(F.col("sequence_recovered"), F.col("index").try_cast("bigint")),
        )
        .drop("index")
    )
