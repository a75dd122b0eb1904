"""Incremental bar updates and the live state of the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.lake import upsert_bars
from barlake.operators.normalize import normalize_bars, split_null_dates
from barlake.operators.registry import apply_fetch_outcomes, fetch_plan, work_list
from barlake.schemas import BARS, INTERVALS


def incremental_update(
    spark: SparkSession,
    roots: dict[str, str],
    tickers: DataFrame,
    intervals: DataFrame,
    landed: DataFrame,
    as_of_ts: str,
    undated_root: str,
    layout: str = "by_month",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One update of all tickers: plan, take the landed bars in each window, merge, update the registry.

    ``roots`` names the lake folder of each wanted interval; ``landed`` holds
    bars with an ``interval`` column. Bars of the wanted intervals whose date cannot
    be read have no window; they are stored under ``undated_root`` by interval and
    time of the update, so an update that is run again keeps them once. Returns
    the plan and both registry tables.
    """
    today = as_of_ts[:10]
    work = work_list(tickers, intervals, list(roots), today)
    plan = fetch_plan(work, as_of_ts).filter("should_fetch")
    window = plan.select(
        F.col("ticker").alias("_t"), F.col("interval").alias("_i"), "full_history",
        F.col("start").alias("_s"), F.col("end").alias("_e"),
    )
    inside = (
        (F.col("stock") == F.col("_t")) & (F.col("interval") == F.col("_i"))
        & (F.col("full_history") | ((F.col("date") >= F.col("_s")) & (F.col("date") < F.col("_e"))))
    )
    columns = [F.col(c) if c in landed.columns else F.lit(None).alias(c) for c in BARS.names]
    dated, undated = split_null_dates(normalize_bars(landed.select(*columns, "interval"), keep=["interval"]))
    taken = dated.join(window, inside, "inner").select(*dated.columns)
    run = F.lit(as_of_ts).cast("timestamp_ntz")
    run = spark.range(1).select(F.date_format(run, "yyyy-MM-dd'T'HH_mm_ss")).first()[0]
    (undated.filter(F.col("interval").isin(list(roots))).write.mode("overwrite").partitionBy("interval")
     .parquet(f"{undated_root}/run={run}"))
    for interval, root in roots.items():
        upsert_bars(spark, root, taken.filter(F.col("interval") == interval).select(*BARS.names), layout)
    got = taken.groupBy(F.col("stock").alias("ticker"), "interval").agg(
        F.date_format(F.max(F.to_date("date")), "yyyy-MM-dd").alias("last_date")
    )
    storage = F.lit(None).cast(INTERVALS["storage"].dataType).alias("storage")
    outcomes = plan.select("ticker", "interval").join(got, ["ticker", "interval"], "left").select(
        "ticker", "interval", F.col("last_date").isNotNull().alias("found"), "last_date", storage
    )
    new_tickers, new_intervals = apply_fetch_outcomes(tickers, intervals, outcomes, today)
    return plan, new_tickers, new_intervals


OUTCOMES = "ticker string, interval string, at timestamp_ntz, found boolean, batch_id bigint"


def live_registry_state(outcomes: DataFrame) -> DataFrame:
    """Streaming latest outcome of each ticker and interval, from outcomes (ticker, interval, found, at).

    The state is one outcome per ticker and bar interval, however many arrive.
    The latest is the maximum, so neither the order of rows nor the cut into
    batches matters. Write it in update mode with ``bar_versions``.
    """
    last = F.max(F.struct("at", "found")).alias("last")
    return outcomes.groupBy("ticker", "interval").agg(last).select("ticker", "interval", "last.at", "last.found")


def latest_state(spark: SparkSession, root: str) -> DataFrame:
    """Status of each ticker over all batches: not_found exactly when the latest outcome of every interval is."""
    versions = spark.read.schema(OUTCOMES).option("basePath", root).parquet(root)
    last = versions.groupBy("ticker", "interval").agg(F.max(F.struct("at", "found")).alias("last"))
    return last.groupBy("ticker").agg(
        F.when(F.bool_or("last.found"), "active").otherwise("not_found").alias("status"),
        F.count(F.lit(1)).alias("intervals"), F.count_if(~F.col("last.found")).alias("not_found_intervals"),
    )
