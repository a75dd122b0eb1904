"""Blocked computation against pandas, with blocks far smaller than a key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlake.operators import analytics as ops
from barlake.operators import series

SIZES = {"hot": 700, "warm": 60, "one": 1}


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    parts = []
    for stock, n in SIZES.items():
        # irregular days over several years, so chunks are sparse and uneven
        days = np.cumsum(rng.integers(1, 9, n))
        close = 50 * np.exp(np.cumsum(rng.normal(0, 0.15, n)))
        parts.append(pd.DataFrame({
            "stock": stock, "date": pd.Timestamp("2019-01-28") + pd.to_timedelta(days, "D"),
            "open": close, "close": close, "volume": rng.integers(1, 60, n),
        }))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def bars(spark, frame):
    df = spark.createDataFrame(frame).withColumn("date", F.col("date").cast("timestamp_ntz"))
    return df.repartition(5)


def check(result, column, expected, frame, tol=1e-9):
    got = result.select("stock", "date", column).toPandas().sort_values(["stock", "date"], ignore_index=True)
    want = frame.assign(want=expected).sort_values(["stock", "date"], ignore_index=True)
    assert len(got) == len(want)
    np.testing.assert_allclose(got[column].astype(float), want["want"].astype(float), rtol=tol, atol=tol)


def per_stock(frame, fn, column="volume"):
    return frame.groupby("stock", group_keys=False)[column].transform(fn)


def log_return(frame):
    return per_stock(frame, lambda s: np.log(s / s.shift()), "close")


def test_row_numbers(bars, frame):
    out = series.number_rows(bars, ["stock"], "date")
    check(out, "rn", frame.groupby("stock").cumcount(), frame)


def test_blocks_hold_their_halo(bars):
    blocks = series.in_blocks(bars, ["stock"], "date", halo=5, block_rows=20)
    hot = blocks.filter("stock = 'hot'").groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_halo").alias("halo"), F.min("rn").alias("first")
    ).orderBy("block").collect()
    assert [r["halo"] for r in hot] == [0] + [5] * (len(hot) - 1)
    assert all(r["n"] <= 25 for r in hot)
    assert series.without_blocks(blocks).count() == sum(SIZES.values())


def test_halo_must_fit(bars):
    with pytest.raises(ValueError):
        series.in_blocks(bars, ["stock"], "date", halo=30, block_rows=20)


def test_returns(bars, frame):
    out = ops.log_returns(bars)
    check(out, "log_return", log_return(frame), frame)
    total = np.exp(frame.assign(r=log_return(frame).fillna(0)).groupby("stock")["r"].cumsum())
    check(ops.cumulative_return(out), "cumulative_return", total, frame)


def test_return_of_non_positive_price_is_null(spark):
    rows = [("a", "2024-01-01", 10.0), ("a", "2024-02-01", 0.0), ("a", "2024-02-02", 5.0)]
    df = spark.createDataFrame(rows, "stock string, date string, close double").withColumn(
        "date", F.col("date").cast("timestamp_ntz"))
    assert [r[0] for r in ops.log_returns(df).orderBy("date").select("log_return").collect()] == [None] * 3


def test_fixture_returns(spark):
    rows = [("a", f"2024-01-0{i + 1}", c) for i, c in enumerate([100.0, 105.0, 103.0, 108.0])]
    df = spark.createDataFrame(rows, "stock string, date string, close double").withColumn(
        "date", F.col("date").cast("timestamp_ntz"))
    got = [r[0] for r in ops.log_returns(df).orderBy("date").select("log_return").collect()]
    assert got[0] is None and round(got[1], 5) == 0.04879


@pytest.mark.parametrize("stretch", [None, 40])
def test_ewma(bars, frame, stretch):
    # a decay of one half is forgotten after 73 rows; stretches of 40 force the hand-over
    out = ops.ewma(bars, "volume", {"m": 3.0}, block_rows=90, stretch=stretch)
    tol = 1e-9 if stretch is None else 1e-9
    check(out, "m", per_stock(frame, lambda s: s.ewm(span=3).mean()), frame, tol)


def test_ewma_with_gaps(spark, frame):
    gappy = frame.assign(volume=frame["volume"].where(frame["volume"] % 5 != 0).astype(float))
    df = spark.createDataFrame(gappy).withColumns({
        "date": F.col("date").cast("timestamp_ntz"), "volume": F.when(~F.isnan("volume"), F.col("volume"))})
    out = ops.ewma(df, "volume", {"m": 3.0}, block_rows=90)
    check(out, "m", per_stock(gappy, lambda s: s.ewm(span=3).mean()), gappy)


@pytest.mark.parametrize("mean", [ops.ewma, ops.tema])
def test_a_run_of_nulls_longer_than_block_and_halo_changes_nothing(spark, mean):
    rows = [("A", f"2024-01-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}", float(i % 9) if i < 5 or i > 690 else None)
            for i in range(705)]
    df = spark.createDataFrame(rows, "stock string, date string, volume double").withColumn("date", F.col("date").cast("timestamp_ntz"))
    small, big = ([r["m"] for r in mean(df, "volume", {"m": 3.0}, block_rows=n).orderBy("date").collect()] for n in (160, 50_000))
    assert None not in small and np.allclose(small, big, rtol=1e-12)
    assert len(set(small[4:691])) == 1


@pytest.fixture(scope="module")
def gappy(spark):
    """Day bars of six years; four of them, and many single days, without a volume."""
    x = [None if 160 <= i < 1500 or i % 7 == 3 else float(i % 11) for i in range(2100)]
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(x)], "stock string, i int, volume double").select(
        "stock", "i", F.timestamp_add("DAY", F.col("i"), F.lit("2019-01-01").cast("timestamp_ntz")).alias("date"), "volume")
    return df.repartition(3), pd.Series(x, dtype=float)


def test_a_run_of_nulls_is_cut_in_blocks(gappy):
    blocks = series.in_blocks(gappy[0], ["stock"], "date", 73, 100, "volume").groupBy("block").agg(
        F.count_if(~F.col("is_halo")).alias("own"), F.count_if("is_halo").alias("halo"),
        F.count_if(F.col("is_halo") & F.col("volume").isNotNull()).alias("values"), F.min("i").alias("first")).orderBy("block").collect()
    assert sum(r["own"] for r in blocks) == 2100 and max(r["own"] for r in blocks) <= 131
    assert len(blocks) >= 15
    assert all(r["values"] >= 73 for r in blocks[1:]) and max(r["halo"] for r in blocks) <= 4 * 73


@pytest.mark.parametrize("mean, want", [
    (ops.ewma, lambda s: s.ewm(span=3).mean()),
    (ops.tema, lambda s: tema_of(s.dropna(), 3).reindex(s.index).ffill())])
def test_means_over_a_run_of_nulls_of_many_blocks(gappy, mean, want):
    df, x = gappy
    got = [r["m"] for r in mean(df, "volume", {"m": 3.0}, block_rows=160, stretch=40).orderBy("date").collect()]
    np.testing.assert_allclose(got, want(x), rtol=1e-9, atol=1e-12)


def test_two_speed_baseline(bars, frame):
    out = ops.volume_baseline(bars, "ewma")
    fast = per_stock(frame, lambda s: s.ewm(span=9).mean())
    slow = per_stock(frame, lambda s: s.ewm(span=79).mean())
    check(out, "volume_baseline", 0.7 * fast + 0.3 * slow, frame)


def tema_of(s, span):
    e1 = s.ewm(span=span, adjust=False).mean()
    e2 = e1.ewm(span=span, adjust=False).mean()
    e3 = e2.ewm(span=span, adjust=False).mean()
    return 3 * e1 - 3 * e2 + e3


@pytest.mark.parametrize("stretch", [None, 50])
def test_tema(bars, frame, stretch):
    out = ops.tema(bars, "volume", {"m": 3.0}, block_rows=160, stretch=stretch)
    check(out, "m", per_stock(frame, lambda s: tema_of(s, 3)), frame)


def wma_of(s, n):
    w = np.arange(1, n + 1)
    return s.rolling(n).apply(lambda x: np.dot(x, w) / w.sum(), raw=True)


def test_wma_and_hma(bars, frame):
    out = ops.wma(bars, "volume", {"m": 7}, block_rows=10)
    check(out, "m", per_stock(frame, lambda s: wma_of(s, 7)), frame)
    out = ops.hma(bars, "volume", {"m": 16}, block_rows=20)
    hma = per_stock(frame, lambda s: wma_of(2 * wma_of(s, 8) - wma_of(s, 16), 4))
    check(out, "m", hma, frame)


def test_alma(bars, frame):
    i = np.arange(9)
    w = np.exp(-((i - 0.85 * 8) ** 2) / (2 * (9 / 6) ** 2))
    out = ops.alma(bars, "volume", "m", window=9, block_rows=12)
    check(out, "m", per_stock(frame, lambda s: s.rolling(9).apply(lambda x: np.dot(x, w) / w.sum(), raw=True)), frame)


def kama_of(s, n, fast, slow):
    x, out = s.to_numpy(float), [np.nan] * len(s)
    quick, calm = 2 / (fast + 1), 2 / (slow + 1)
    for t in range(n - 1, len(x)):
        if t == n - 1:
            out[t] = x[t]
            continue
        moves = np.abs(np.diff(x[t - n:t + 1])).sum()
        ratio = abs(x[t] - x[t - n]) / moves if moves else 0.0
        out[t] = out[t - 1] + (ratio * (quick - calm) + calm) ** 2 * (x[t] - out[t - 1])
    return pd.Series(out, index=s.index)


def test_kama(bars, frame):
    # calm gain of (2/3)^2: old values fade within a hundred rows
    out = ops.kama(bars, "volume", "m", period=4, fast=2, slow=2, block_rows=120)
    check(out, "m", per_stock(frame, lambda s: kama_of(s, 4, 2, 2)), frame)
    out = ops.kama(bars, "volume", "m")
    check(out, "m", per_stock(frame, lambda s: kama_of(s, 10, 2, 30)), frame)


def test_zscore_and_percentile(bars, frame):
    out = ops.zscore(bars, "volume", block_rows=25)
    roll = lambda s: (s - s.rolling(20, min_periods=10).mean()) / s.rolling(20, min_periods=10).std()
    check(out, "volume_zscore", per_stock(frame, roll), frame)
    out = ops.volume_percentile(bars, block_rows=25)
    share = lambda s: s.rolling(20, min_periods=1).apply(lambda x: 100 * (x <= x[-1]).mean(), raw=True)
    check(out, "volume_percentile", per_stock(frame, share), frame)


def test_spike_is_found(spark):
    volumes = [1000.0] * 39 + [5000.0] + [1000.0] * 10
    rows = [("a", i, v) for i, v in enumerate(volumes)]
    df = spark.createDataFrame(rows, "stock string, i int, volume double").select(
        "stock", F.timestamp_add("DAY", F.col("i"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("date"), "volume")
    scores = [r[0] for r in ops.zscore(df, "volume").orderBy("date").select("volume_zscore").collect()]
    assert scores[39] > 3


def test_clean_returns(bars, frame):
    out = ops.clean_returns(ops.log_returns(bars), threshold=0.1)
    raw = log_return(frame)
    kept = frame.assign(r=raw.where(raw.abs() <= 0.1))
    check(out, "clean_return", kept.groupby("stock", group_keys=False)["r"].transform(lambda s: s.interpolate()), frame)


def test_exact_median(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 6, 4000), "v": rng.integers(0, 900, 4000).astype(float)})
    pdf.loc[pdf["k"] == 5, "v"] = 0.0
    got = series.exact_median(spark.createDataFrame(pdf), ["k"], "v", "m").toPandas().set_index("k")["m"].sort_index()
    pd.testing.assert_series_equal(got, pdf.groupby("k")["v"].median(), check_names=False, check_index_type=False)


def test_normalize_analytics_small_blocks(bars):
    market = bars.sparkSession.createDataFrame([(0, 2.0)], "minute_of_day int, seasonality_factor double")
    options = dict(fast_halflife=1.5, slow_halflife=2)
    big = ops.normalize_analytics(bars, market, **options)
    small = ops.normalize_analytics(bars, market, block_rows=150, **options)
    columns = ["log_return", "cumulative_return", "volume_baseline", "relative_volume_adjusted", "volume_zscore", "volume_percentile"]
    a, b = (d.toPandas().sort_values(["stock", "date"], ignore_index=True)[columns].astype(float) for d in (big, small))
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)


def test_split_adjust_counts_later_splits_only(spark):
    bars = spark.createDataFrame(
        [("a", d, 80.0) for d in ("2020-01-01", "2020-06-01", "2020-06-02", "2021-01-01")] + [("b", "2020-01-01", 5.0)],
        "stock string, date string, close double").withColumn("date", F.col("date").cast("timestamp_ntz"))
    splits = spark.createDataFrame([("a", "2020-06-01", 2.0), ("a", "2020-12-01", 4.0)],
                                   "stock string, date string, ratio double").withColumn("date", F.col("date").cast("timestamp_ntz"))
    got = [round(r[0], 6) for r in ops.split_adjust(bars, splits).orderBy("stock", "date").select("split_factor").collect()]
    assert got == [8.0, 4.0, 4.0, 1.0, 1.0]


def test_scored_returns_equal_the_two_passes_and_read_the_bars_once_less(spark):
    rows = [(s, f"20{y:02d}-{m:02d}-{d:02d}", float(1 + (y * 31 + m * 7 + d * 13) % 17) if d != 9 else None, (d * m * 37) % 101)
            for s in "AB" for y in (23, 24) for m in (1, 2, 5, 12) for d in range(1, 28)]
    bars = spark.createDataFrame(rows, "stock string, date string, close double, volume long").withColumn("date", F.col("date").cast("timestamp_ntz"))
    found = ops.scored_returns(bars, block_rows=30)
    two = ops.zscore(ops.log_returns(bars), "volume", block_rows=30)
    as_text = lambda df: sorted(str(r) for r in df.select(*found.columns).collect())
    assert as_text(found) == as_text(two) and len(as_text(found)) == len(rows)
    scans = [df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") for df in (found, two)]
    assert scans[0] < scans[1]
