"""Means with memory that go on from a stored state, so old bars are not read again.

A state is one row per key. It takes part in the next batch as the row (for the
adaptive mean, the few rows) that stands for everything before it: numbering,
blocks and halos treat it like any row, and the recurrence starts from its value.
Two runs over halves of a series give the result of one run over all of it.

Rows that are not newer than the state of their key cannot be added to it. They
are handed back; their keys start again from stored bars.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import series
from barlake.operators.analytics import KEYS, ORDER, _span_decay, add_kama, kama_memory, span_memory
from barlake.operators.series import BLOCK_ROWS
from barlake.session import scratch_dir


@dataclass(frozen=True)
class Continued:
    """``rows``: the newer rows of the batch with their means; ``state``: what the next batch
    starts from, for all keys; ``late``: rows of the batch that came too late."""

    rows: DataFrame
    state: DataFrame
    late: DataFrame


def split_newer(batch: DataFrame, state: DataFrame | None, keys: Sequence[str] = KEYS,
                order: str = ORDER) -> tuple[DataFrame, DataFrame]:
    """Rows after the state of their key (or of a key without one), and the others."""
    if state is None:
        return batch, batch.filter(F.lit(False))
    known = state.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(order).alias("_seen_to"))
    joined = batch.join(known, [F.col(k) == F.col(f"_k_{k}") for k in keys], "left")
    late = F.coalesce(F.col(order) <= F.col("_seen_to"), F.lit(False))
    return joined.filter(~late).select(*batch.columns), joined.filter(late).select(*batch.columns)


def _behind(state: DataFrame | None, batch: DataFrame, added: dict[str, str]) -> DataFrame:
    """The batch after the rows of its state; ``is_state`` tells them apart."""
    rows = batch.select("*", *[F.lit(None).cast(t).alias(c) for c, t in added.items()], F.lit(False).alias("is_state"))
    if state is None:
        return rows
    return rows.unionByName(state.withColumn("is_state", F.lit(True)), allowMissingColumns=True)


def _solved(spark: SparkSession, rows: DataFrame, keys: Sequence[str], order: str, halo: int, block_rows: int,
            add: Callable[[DataFrame], DataFrame], value: str | None = None) -> DataFrame:
    """Rows in blocks, solved and stored once: both the means and the next state are read from there."""
    blocks = series.in_blocks(rows, keys, order, halo, block_rows, value)
    folder = scratch_dir(spark, "continued")
    add(blocks).filter(~F.col("is_halo")).drop("is_halo", "block").write.parquet(folder)
    return spark.read.parquet(folder)


def _kept_and_new(state: DataFrame | None, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of keys that the batch does not name stay as they are."""
    if state is None:
        return fresh
    return state.join(fresh.select(*keys), list(keys), "left_anti").select(*fresh.columns).unionByName(fresh)


def _state_of_named(state: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    return None if state is None else state.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def _last_marked(solved: DataFrame, keys: Sequence[str], order: str, marked: Column, names: Sequence[str]) -> DataFrame:
    """Per key the named columns of the last marked row, and how many rows came after it."""
    last = F.max_by(F.struct(*names, "rn"), F.when(marked, F.col("rn")))
    per_key = solved.groupBy(*keys).agg(F.max(order).alias(order), F.max("rn").alias("_end"), last.alias("_last"))
    after = (F.col("_end") - F.col("_last.rn")).alias("_after")
    return per_key.filter(F.col("_last").isNotNull()).select(*keys, order, after, *[f"_last.{n}" for n in names])


def continue_ewma(spark: SparkSession, batch: DataFrame, state: DataFrame | None, value: str, spans: dict[str, float],
                  keys: Sequence[str] = KEYS, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> Continued:
    """``analytics.ewma`` from a state on.

    The state holds numerator and denominator at the last value and the rows
    without a value since then (``gap``), by which both have decayed.
    """
    newer, late = split_newer(batch, state, keys, order)
    sums = [f"{part}_{n}" for n in spans for part in ("num", "den")]
    rows = _behind(_state_of_named(state, newer, keys), newer, {"gap": "bigint", **{c: "double" for c in sums}})
    x, is_state = F.col(value).cast("double"), F.col("is_state")
    marked = is_state | x.isNotNull()
    rows = rows.withColumn("_marked", F.when(marked, True))

    def add(b: DataFrame) -> DataFrame:
        terms = {}
        for n, span in spans.items():
            a = _span_decay(span)
            faded = F.pow(F.lit(a), F.col("gap"))
            terms[f"_num_{n}"] = (a, F.when(is_state, F.col(f"num_{n}") * faded).otherwise(F.coalesce(x, F.lit(0.0))))
            terms[f"_den_{n}"] = (a, F.when(is_state, F.col(f"den_{n}") * faded).otherwise(
                F.when(x.isNotNull(), 1.0).otherwise(0.0)))
        solved = series.decayed_sums(b, keys, terms, series.row_steps(keys))
        solved = solved.withColumns({
            c: F.when(is_state, F.col(c)).otherwise(F.col(f"_{c}")) for c in sums
        })
        so_far = series.block_window(keys).rowsBetween(series.Window.unboundedPreceding, 0)
        return solved.withColumns({
            n: F.last(F.when(marked, F.try_divide(F.col(f"num_{n}"), F.col(f"den_{n}"))), ignorenulls=True).over(so_far)
            for n in spans
        }).drop(*terms)

    solved = _solved(spark, rows, keys, order, span_memory(spans.values()), block_rows, add, "_marked")
    last = _last_marked(solved, keys, order, F.col("_marked"), ["gap", *sums])
    gap = (F.col("_after") + F.coalesce("gap", F.lit(0))).alias("gap")
    fresh = last.select(*keys, order, gap, *sums)
    means = solved.filter(~is_state).select(*batch.columns, *spans)
    return Continued(means, _kept_and_new(state, fresh, keys), late)


def continue_tema(spark: SparkSession, batch: DataFrame, state: DataFrame | None, value: str, spans: dict[str, float],
                  keys: Sequence[str] = KEYS, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> Continued:
    """``analytics.tema`` from a state on: the three nested means as they were at the last value."""
    newer, late = split_newer(batch, state, keys, order)
    levels = [f"e{level}_{n}" for n in spans for level in (1, 2, 3)]
    rows = _behind(_state_of_named(state, newer, keys), newer, {c: "double" for c in levels})
    has, is_state = F.col(value).isNotNull(), F.col("is_state")
    rows = rows.withColumn("_marked", F.when(is_state | has, True))

    def add(b: DataFrame) -> DataFrame:
        out = b.withColumn("_seen", F.count("_marked").over(series.block_window(keys)))
        first = has & (F.col("_seen") == 1)
        for level in (1, 2, 3):
            terms = {}
            for n, span in spans.items():
                a = _span_decay(span)
                x = F.col(value if level == 1 else f"_e{level - 1}_{n}").cast("double")
                gain = F.when(is_state, F.col(f"e{level}_{n}")).when(first, x).when(has, x * (1.0 - a)).otherwise(0.0)
                terms[f"_e{level}_{n}"] = (a, gain)
            out = series.decayed_sums(out, keys, terms, F.when(F.col("_marked"), 1).otherwise(0))
        mean = {n: 3 * F.col(f"_e1_{n}") - 3 * F.col(f"_e2_{n}") + F.col(f"_e3_{n}") for n in spans}
        return out.withColumns(
            {n: F.when(F.col("_seen") > 0, m) for n, m in mean.items()} | {c: F.col(f"_{c}") for c in levels}
        ).drop("_seen", *[f"_{c}" for c in levels])

    solved = _solved(spark, rows, keys, order, 2 * span_memory(spans.values()), block_rows, add, "_marked")
    fresh = _last_marked(solved, keys, order, F.col("_marked"), levels).select(*keys, order, *levels)
    means = solved.filter(~is_state).select(*batch.columns, *spans)
    return Continued(means, _kept_and_new(state, fresh, keys), late)


def continue_kama(spark: SparkSession, batch: DataFrame, state: DataFrame | None, value: str, name: str,
                  period: int = 10, fast: int = 2, slow: int = 30, keys: Sequence[str] = KEYS, order: str = ORDER,
                  block_rows: int = BLOCK_ROWS) -> Continued:
    """``analytics.kama`` from a state on.

    The state holds the mean and the last ``period`` rows, which the efficiency
    ratio of the next ones looks at. With fewer rows so far there is no mean yet.
    """
    newer, late = split_newer(batch, state, keys, order)
    tail = _state_of_named(state, newer, keys)
    if tail is not None:
        tail = tail.select(*keys, "mean", F.size("tail").alias("_n"), F.posexplode("tail").alias("_i", "_row")).select(
            *keys, F.col("_row.at").alias(order), F.col("_row.value").alias(value),
            F.when((F.col("_i") == F.col("_n") - 1) & (F.col("_n") == period), F.col("mean")).alias("mean"),
        )
    rows = _behind(tail, newer, {"mean": "double"})
    solved = _solved(
        spark, rows, keys, order, kama_memory(period, slow), block_rows,
        lambda b: add_kama(b, value, name, keys, period, fast, slow, F.col("mean")),
    )
    ends = solved.groupBy(*keys).agg(
        F.max(order).alias(order), F.max("rn").alias("_end"), F.max_by(name, "rn").alias("mean"))
    recent = solved.select(*keys, "rn", F.struct(F.col(order).alias("at"), F.col(value).alias("value")).alias("_row")).join(
        ends, list(keys)).filter(F.col("rn") > F.col("_end") - period)
    fresh = recent.groupBy(*keys, order, "mean").agg(F.array_sort(F.collect_list("_row")).alias("tail"))
    means = solved.filter(~F.col("is_state")).select(*batch.columns, name)
    return Continued(means, _kept_and_new(state, fresh.select(*keys, order, "mean", "tail"), keys), late)
