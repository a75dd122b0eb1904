"""Exact distinct counts that merge: one bitmap per day, combined to any longer period.

A distinct count of a month cannot be made from those of its days. A bitmap can:
bit n says that value number n occurred. Days are counted once, when their trades
arrive; months, years and trailing windows are made from stored days alone.

Bitmaps hold 32,768 bits (4 KB); value numbers beyond go to further buckets. They
are built and joined as hash aggregates with partial results before the shuffle,
and a group holds 4 KB however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.functions.calendar import minute_of_day

NUMBERED = "value STRING, number BIGINT"
SLICES = 1024


def read_numbers(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(NUMBERED).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], NUMBERED)


def number_values(spark: SparkSession, values: DataFrame, root: str) -> DataFrame:
    """Give every value (first column, nulls left out) a number from 1 on, for good.

    New values follow the highest number so far. They are numbered in slices of
    their hash, and the 1,024 slice sizes give each slice its offset, so no task
    sees all of them. One run at a time may write.
    """
    known = read_numbers(spark, root)
    fresh = values.select(F.col(values.columns[0]).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    fresh = fresh.join(known, "value", "left_anti").withColumn("_slice", F.pmod(F.xxhash64("value"), F.lit(SLICES)))
    sizes = fresh.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_slice", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy("value"))
    highest = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    numbered = fresh.join(offsets, "_slice").select(
        "value", (F.lit(highest) + F.col("_before") + inside).cast("bigint").alias("number"))
    numbered.write.mode("append").parquet(root)
    return read_numbers(spark, root)


def bitmaps(numbered: DataFrame, keys: Sequence[str], number: Column) -> DataFrame:
    """One bitmap per key and bucket of the positive numbers that occur; null numbers do not count."""
    placed = numbered.withColumn("_number", number.cast("bigint")).filter("_number IS NOT NULL")
    return placed.groupBy(*keys, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"))


def merge_bitmaps(maps: DataFrame, keys: Sequence[str]) -> DataFrame:
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(maps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def trade_day_bitmaps(trades: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per trade date the instruments (kind isin) and minutes of the day (kind minute) that traded.

    Instruments are brought down to one row a day before they meet their numbers.
    """
    dated = trades.select(F.to_date("trade_time").alias("trade_date"), "isin", minute_of_day("trade_time").alias("_minute"))
    known = numbers.select(F.col("value").alias("isin"), "number")
    isins = dated.select("trade_date", "isin").distinct().join(known, "isin")
    by_isin = bitmaps(isins, ["trade_date"], F.col("number")).withColumn("kind", F.lit("isin"))
    by_minute = bitmaps(dated, ["trade_date"], F.col("_minute") + 1).withColumn("kind", F.lit("minute"))
    return by_isin.unionByName(by_minute).select("trade_date", "kind", "bucket", "bits")


def period_counts(days: DataFrame, unit: str) -> DataFrame:
    """Trading days, instruments and minutes of the day per period, from stored days."""
    period = F.trunc("trade_date", unit).alias("period")
    dated = days.select(period, "trade_date", "kind", "bucket", "bits")
    merged = merge_bitmaps(dated, ["period", "kind"])
    counted = merged.groupBy("period").agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.bitmap_count("bits"))), F.lit(0)).alias(n)
        for k, n in (("isin", "unique_isins"), ("minute", "unique_minutes"))
    ])
    open_days = dated.groupBy("period").agg(F.count_distinct("trade_date").alias("trading_days"))
    return counted.join(open_days, "period").select("period", "trading_days", "unique_isins", "unique_minutes")


def trailing_isins(days: DataFrame, length: int = 7) -> DataFrame:
    """Per trade date the instruments of it and the ``length - 1`` calendar days before it.

    A day's bitmap is sent to the days it counts for, at most ``length`` of 4 KB each.
    """
    isins = days.filter(F.col("kind") == "isin")
    reach = F.explode(F.sequence(F.lit(0), F.lit(length - 1)))
    sent = isins.withColumn("_ahead", reach).withColumn("trade_date", F.date_add("trade_date", F.col("_ahead")))
    counted = count_bitmaps(merge_bitmaps(sent, ["trade_date"]), ["trade_date"], "trailing_isins")
    return counted.join(days.select("trade_date").distinct(), "trade_date", "left_semi")
