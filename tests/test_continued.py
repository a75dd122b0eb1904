"""Means that go on from a state: three batches equal one run, and old bars are not read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.operators import analytics, continued
from tests.test_plans import plan_of
from tests.test_series import bars, frame  # noqa: F401  (fixtures)

SPANS = {"m": 3.0, "s": 4.0}


def one_run(kind, df, block_rows=50_000):
    if kind == "kama":
        return analytics.kama(df, "volume", "m", period=4, slow=2, block_rows=block_rows)
    return getattr(analytics, kind)(df, "volume", SPANS, block_rows=block_rows)


def go_on(kind, spark, df, state, block_rows=170):
    if kind == "kama":
        return continued.continue_kama(spark, df, state, "volume", "m", period=4, slow=2, block_rows=block_rows)
    return getattr(continued, f"continue_{kind}")(spark, df, state, "volume", SPANS, block_rows=200)


def values(df, column="m"):
    return df.select("stock", "date", F.col(column).cast("double").alias("v")).orderBy("stock", "date").toPandas()["v"].to_numpy()


def parts(df, *ends):
    edges = ["1900-01-01", *ends, "2900-01-01"]
    at = F.col("date")
    return [df.filter((at >= F.lit(a).cast("timestamp_ntz")) & (at < F.lit(b).cast("timestamp_ntz")))
            for a, b in zip(edges, edges[1:])]


def all_batches(kind, spark, batches):
    state, out = None, None
    for batch in batches:
        run = go_on(kind, spark, batch, state)
        assert run.late.count() == 0
        out, state = (run.rows if out is None else out.unionByName(run.rows)), run.state
    return out, state


@pytest.mark.parametrize("kind", ["ewma", "tema", "kama"])
def test_batches_equal_one_run(spark, bars, kind):  # noqa: F811
    # the second cut leaves the first batch shorter than a tail; keys end in different batches
    got, state = all_batches(kind, spark, parts(bars, "2019-02-05", "2019-08-11", "2024-01-15"))
    np.testing.assert_allclose(values(got), values(one_run(kind, bars)), rtol=1e-9)
    assert {r["stock"] for r in state.collect()} == {"hot", "warm", "one"}


@pytest.mark.parametrize("kind", ["ewma", "tema"])
def test_values_may_be_missing_for_whole_batches(spark, bars, kind):  # noqa: F811
    at = F.col("date")
    empty = (at >= F.lit("2020-01-01").cast("timestamp_ntz")) & (at < F.lit("2022-06-01").cast("timestamp_ntz"))
    gappy = bars.withColumn("volume", F.when(~empty & (F.col("volume") % 5 != 0), F.col("volume")))
    got, _ = all_batches(kind, spark, parts(gappy, "2020-03-01", "2021-03-01", "2022-07-01"))
    np.testing.assert_allclose(values(got, "s"), values(one_run(kind, gappy), "s"), rtol=1e-9)


@pytest.mark.parametrize("kind", ["ewma", "tema", "kama"])
def test_late_rows_are_handed_back_and_an_empty_batch_keeps_the_state(spark, bars, kind):  # noqa: F811
    first, second = parts(bars, "2023-01-01")
    state = go_on(kind, spark, first, None).state
    mixed = second.unionByName(first.filter("stock = 'hot'").orderBy("date").limit(3))
    run = go_on(kind, spark, mixed, state)
    assert run.late.count() == 3 and run.rows.count() == second.count()
    same = go_on(kind, spark, second.limit(0), state)
    assert same.rows.count() == 0
    assert sorted(map(str, same.state.collect())) == sorted(map(str, state.collect()))


def test_old_bars_are_not_read(spark, bars, folder):  # noqa: F811
    first, second = parts(bars, "2023-01-01")
    first.write.parquet(f"{folder}/old")
    second.write.parquet(f"{folder}/new")
    run = go_on("ewma", spark, spark.read.parquet(f"{folder}/old"), None)
    run.state.write.parquet(f"{folder}/state")
    batch, state = spark.read.parquet(f"{folder}/new"), spark.read.parquet(f"{folder}/state")
    out = go_on("ewma", spark, batch, state)
    for part in (out.rows, out.state, out.late):
        assert f"{folder}/old" not in part._jdf.queryExecution().toString()
    newer, _ = continued.split_newer(batch, state)
    assert plan_of(newer).count("FileScan") == 2


def test_the_adaptive_mean_needs_no_python_and_no_block_size(spark, bars):  # noqa: F811
    small, big = one_run("kama", bars, 120), one_run("kama", bars)
    np.testing.assert_allclose(values(small), values(big), rtol=1e-12)
    plan = plan_of(big)
    assert "Python" not in plan and "Arrow" not in plan
