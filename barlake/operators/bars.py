"""Building, rolling up and checking OHLCV bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.calendar import (
    day_start,
    epoch_micros,
    hour_floor,
    minute_floor,
    to_zone,
)

INSTRUMENT = ["isin"]


def bucket_start(ts: Column | str, interval: str, market_zone: str | None = None) -> Column:
    """Start of the bar: ``1m`` and ``1h`` in the column's own clock, ``1d`` in market-local days."""
    if interval == "1m":
        return minute_floor(ts)
    if interval == "1h":
        return hour_floor(ts)
    if interval == "1d":
        return day_start(to_zone(ts, market_zone) if market_zone else ts)
    raise ValueError(f"unknown bar interval: {interval}")


def trade_order() -> Column:
    """Time, then tick id, packed in one number.

    A struct order would force a sort-based aggregate; a decimal keeps the bar
    aggregate hash-based. Sixteen to seventeen digits of microseconds and
    nineteen of tick id fit in 38.
    """
    micros = epoch_micros("trade_time").cast("decimal(18,0)")
    tick = F.coalesce("tick_id", F.lit(0)).cast("decimal(19,0)")
    return (micros * F.lit("10000000000000000000").cast("decimal(20,0)") + tick).cast("decimal(38,0)")


def ohlcv_from_trades(
    trades: DataFrame,
    interval: str,
    keys: Sequence[str] = INSTRUMENT,
    market_zone: str | None = None,
) -> DataFrame:
    """Bars with VWAP and trade count; bars without volume are dropped.

    Trades must be de-duplicated. Every aggregate combines before the shuffle,
    so one very active instrument does not load one task with its trades.
    """
    order = trade_order()
    priced = trades.filter(F.col("trade_time").isNotNull() & F.col("price").isNotNull())
    return (
        priced.groupBy(*keys, bucket_start("trade_time", interval, market_zone).alias("bar"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum(F.col("price") * F.col("volume")).alias("notional"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .filter(F.col("volume") > 0)
        .withColumn("vwap", F.try_divide("notional", "volume"))
        .drop("notional")
    )


def ohlcv_rollup(
    bars: DataFrame, interval: str, keys: Sequence[str] = INSTRUMENT, market_zone: str | None = None
) -> DataFrame:
    """Coarser bars from finer ones: true high and low, VWAP weighted by volume."""
    return (
        bars.groupBy(*keys, bucket_start("bar", interval, market_zone).alias("_bar"))
        .agg(
            F.min_by("open", "bar").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "bar").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("trade_count").alias("trade_count"),
            F.sum(F.col("vwap") * F.col("volume")).alias("notional"),
        )
        .withColumn("vwap", F.try_divide("notional", "volume"))
        .drop("notional")
        .withColumnRenamed("_bar", "bar")
    )


def local_day_bars(trades: DataFrame, market_zone: str, keys: Sequence[str] = INSTRUMENT) -> DataFrame:
    return ohlcv_from_trades(trades, "1d", keys, market_zone)


def source_to_price_volume(df: DataFrame, source: str) -> DataFrame:
    """(instrument, ts, price, volume) of either feed."""
    if source == "xetra":
        return df.select(
            F.col("isin").alias("instrument"), F.col("trade_time").alias("ts"), "price",
            F.col("volume").cast("double").alias("volume"),
        )
    if source == "yahoo":
        return df.select(
            F.col("stock").alias("instrument"), F.col("date").alias("ts"), F.col("close").alias("price"),
            F.col("volume").cast("double").alias("volume"),
        )
    raise ValueError(f"no bars or trades come from {source!r}")


def drop_zero_volume_bars(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("volume") > 0)


def volume_conservation(
    trades: DataFrame, bars: DataFrame, keys: Sequence[str] = INSTRUMENT, tolerance: float = 0.0001
) -> DataFrame:
    """Per instrument and day: volume in bars against volume in trades, verdict included."""
    keys = list(keys)
    left = trades.groupBy(*keys, F.to_date("trade_time").alias("day")).agg(
        F.sum("volume").alias("trade_volume")
    )
    right = bars.groupBy(*keys, F.to_date("bar").alias("day")).agg(F.sum("volume").alias("bar_volume"))
    both = left.join(right, [*keys, "day"], "full_outer")
    traded, barred = (F.coalesce(c, F.lit(0.0)) for c in ("trade_volume", "bar_volume"))
    gap = F.abs(traded - barred)
    return both.select(
        *keys, "day", traded.alias("trade_volume"), barred.alias("bar_volume"),
        (gap <= F.lit(tolerance) * traded).alias("conserved"),
    )


def ohlc_violations(bars: DataFrame) -> DataFrame:
    """Bars whose prices contradict each other, or whose volume is negative."""
    bad_high = F.col("high") < F.greatest("open", "close", "low")
    bad_low = F.col("low") > F.least("open", "close", "high")
    bad_volume = F.col("volume") < 0
    rule = F.array_compact(
        F.array(
            F.when(bad_high, "high"), F.when(bad_low, "low"), F.when(bad_volume, "volume")
        )
    )
    return bars.withColumn("rule", F.explode(rule))


BAR_VALUES = ["open", "high", "low", "close", "volume", "trade_count"]


def interval_mismatches(
    rolled: DataFrame, stored: DataFrame, keys: Sequence[str] = INSTRUMENT, digits: int = 6
) -> DataFrame:
    """Bars of a coarse interval that differ from the roll-up of the fine one.

    Both sides are tagged and grouped once; nothing is joined.
    """
    def side(df: DataFrame, tag: int) -> DataFrame:
        rounded = [F.round(F.col(c).cast("double"), digits).alias(c) for c in BAR_VALUES]
        return df.select(*keys, "bar", F.struct(*rounded).alias("values"), F.lit(tag).alias("side"))

    pair = side(rolled, 1).unionByName(side(stored, 2)).groupBy(*keys, "bar").agg(
        F.max(F.when(F.col("side") == 1, F.col("values"))).alias("rolled"),
        F.max(F.when(F.col("side") == 2, F.col("values"))).alias("stored"),
    )
    status = (
        F.when(F.col("stored").isNull(), "missing_stored")
        .when(F.col("rolled").isNull(), "missing_rolled")
        .when(F.col("rolled") != F.col("stored"), "different")
    )
    return pair.withColumn("status", status).filter(F.col("status").isNotNull())


def cross_venue_compare(
    bars: DataFrame, venue_a: str, venue_b: str, keys: Sequence[str] = INSTRUMENT
) -> DataFrame:
    """Closes of one instrument and bar on two venues, difference and spread in basis points.

    One grouping on the instrument and bar; no self-join.
    """
    pair = bars.filter(F.col("feed_venue").isin(venue_a, venue_b)).groupBy(*keys, "bar").agg(
        F.max(F.when(F.col("feed_venue") == venue_a, F.col("close"))).alias("close_a"),
        F.max(F.when(F.col("feed_venue") == venue_b, F.col("close"))).alias("close_b"),
    )
    difference = F.col("close_a") - F.col("close_b")
    middle = (F.col("close_a") + F.col("close_b")) / 2
    return pair.filter(F.col("close_a").isNotNull() & F.col("close_b").isNotNull()).select(
        *keys, "bar", "close_a", "close_b",
        difference.alias("price_diff"),
        (F.try_divide(F.abs(difference), middle) * 10_000).alias("spread_bps"),
    )


def cross_source_union(trade_bars: DataFrame, vendor_bars: DataFrame) -> DataFrame:
    """Both feeds under one bar schema, told apart by ``market`` and ``source``."""
    left = trade_bars.withColumnRenamed("isin", "instrument").withColumns(
        {"market": F.lit("de"), "source": F.lit("xetra")}
    )
    right = vendor_bars.select(
        F.col("stock").alias("instrument"), F.col("date").alias("bar"),
        "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"),
    ).withColumns({"market": F.lit("us"), "source": F.lit("yahoo")})
    return left.unionByName(right, allowMissingColumns=True)


def expected_minutes(sessions: DataFrame) -> DataFrame:
    """One row per session minute of (feed_venue, day, open, close), the close minute excluded."""
    last = F.timestamp_add("MINUTE", F.lit(-1), F.col("close"))
    minutes = F.sequence("open", last, F.expr("INTERVAL 1 MINUTE"))
    return sessions.filter(F.col("open") <= last).select(
        "feed_venue", "day", F.explode(minutes).alias("minute")
    )


def missing_minutes(sessions: DataFrame, trades: DataFrame) -> DataFrame:
    """Expected session minutes in which a venue has no trade."""
    seen = trades.select("feed_venue", minute_floor("trade_time").alias("minute")).distinct()
    return expected_minutes(sessions).join(seen, ["feed_venue", "minute"], "left_anti")


def session_gaps(trades: DataFrame, minutes: int) -> DataFrame:
    """Silences longer than ``minutes`` between trades of a venue within one day.

    First and last trade per minute are enough (a longer gap always leaves its
    minute), so the ordered pass sees at most 1,440 rows per venue-day.
    """
    if minutes < 1:
        raise ValueError("gaps below one minute are not resolved")
    per_minute = trades.groupBy("feed_venue", minute_floor("trade_time").alias("minute")).agg(
        F.min("trade_time").alias("first"), F.max("trade_time").alias("last")
    ).withColumn("day", F.to_date("minute"))
    order = Window.partitionBy("feed_venue", "day").orderBy("minute")
    return (
        per_minute.withColumn("gap_start", F.lag("last").over(order))
        .withColumn(
            "gap_seconds",
            F.timestamp_diff("MICROSECOND", F.col("gap_start"), F.col("first")) / 1_000_000,
        )
        .filter(F.col("gap_seconds") > minutes * 60)
        .select("feed_venue", "day", "gap_start", F.col("first").alias("gap_end"), "gap_seconds")
    )
