"""Queries that go on from what earlier runs stored: states of means, bitmaps of days."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import continued as ops
from barlake.operators import distinct
from barlake.operators.analytics import BASELINES, FAST_HALFLIFE, FAST_WEIGHT, SLOW_HALFLIFE, halflife_to_span
from barlake.plans import analytics, views  # noqa: F401  (analytics registers the oracles)
from barlake.plans.catalog import CATALOG, query, rounded
from barlake.session import scratch_dir

ENDS = ("1994-06-01", "1996-06-01")
SPANS = dict(zip(BASELINES, map(halflife_to_span, (FAST_HALFLIFE, SLOW_HALFLIFE))))


def _batches(bars):
    at = F.col("date")
    low, high = (F.lit(e).cast("timestamp_ntz") for e in ENDS)
    return [bars.filter(at < low), bars.filter((at >= low) & (at < high)), bars.filter(at >= high)]


def in_three(spark, bars, step):
    """All rows of three batches; each state is stored and read back, as between two days."""
    state, out = None, None
    for batch in _batches(bars):
        run = step(batch, state)
        out = run.rows if out is None else out.unionByName(run.rows)
        folder = scratch_dir(spark, "state")
        run.state.write.parquet(folder)
        state = spark.read.parquet(folder)
    return out


def _bars(spark, sf):
    """Stored once, since each batch reads its part."""
    folder = scratch_dir(spark, "bars")
    views.bars_daily(spark, sf).select("stock", "date", "volume").write.parquet(folder)
    return spark.read.parquet(folder)


def _blend():
    fast, slow = (F.col(n) for n in BASELINES)
    return (FAST_WEIGHT * fast + (1 - FAST_WEIGHT) * slow).alias("volume_baseline")


@query("continued_ewma", CATALOG["ewma_baseline"].oracle)
def continued_ewma(spark, sf):
    out = in_three(spark, _bars(spark, sf), lambda b, s: ops.continue_ewma(spark, b, s, "volume", SPANS))
    return rounded(out.select("stock", "date", *BASELINES, _blend()), 6, *BASELINES, "volume_baseline")


@query("continued_tema", CATALOG["tema_baseline"].oracle)
def continued_tema(spark, sf):
    out = in_three(spark, _bars(spark, sf), lambda b, s: ops.continue_tema(spark, b, s, "volume", SPANS))
    # cut off-centre, as in tema_baseline
    out = out.select("stock", "date", _blend())
    return out.withColumn("volume_baseline", F.floor(F.col("volume_baseline") * 100000 + 0.31) / 100000)


@query("continued_kama", CATALOG["kama"].oracle)
def continued_kama(spark, sf):
    out = in_three(
        spark, _bars(spark, sf), lambda b, s: ops.continue_kama(spark, b, s, "volume", "volume_baseline"))
    return rounded(out, 6, "volume_baseline").select("stock", "date", "volume_baseline")


def _days(spark, sf):
    """Bitmaps of all days, counted in two batches whose instruments are numbered as they come."""
    numbers, stored = scratch_dir(spark, "numbers"), scratch_dir(spark, "days")
    trades = views.trades(spark, sf).select("trade_time", "isin")
    odd = F.dayofmonth("trade_time") % 2 == 1
    for batch in (trades.filter(odd), trades.filter(~odd)):
        known = distinct.number_values(spark, batch.select("isin"), numbers)
        distinct.trade_day_bitmaps(batch, known).write.mode("append").parquet(stored)
    return spark.read.parquet(stored)


TRADES = f"WITH {views.TRADES}"


@query("distinct_by_month", f"""{TRADES} SELECT CAST(date_trunc('month', trade_time) AS DATE) AS period, count(DISTINCT CAST(trade_time AS DATE)) AS trading_days,
  count(DISTINCT isin) AS unique_isins, count(DISTINCT strftime(trade_time, '%H:%M')) AS unique_minutes FROM trades GROUP BY 1""")
def distinct_by_month(spark, sf):
    return distinct.period_counts(_days(spark, sf), "month")


@query("trailing_isins", f"""{TRADES}, t AS (SELECT DISTINCT CAST(trade_time AS DATE) AS trade_date, isin FROM trades), d AS (SELECT DISTINCT trade_date FROM t)
  SELECT d.trade_date, count(DISTINCT t.isin) AS trailing_isins FROM d JOIN t ON t.trade_date BETWEEN d.trade_date - 6 AND d.trade_date GROUP BY 1""")
def trailing_isins(spark, sf):
    return distinct.trailing_isins(_days(spark, sf))
