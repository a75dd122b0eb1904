"""Returns, adaptive volume baselines, scores and seasonality of bars.

Every function takes bars with unique, non-null (``keys``, ``order``) and adds
columns. How one very long key is spread over tasks is told in ``series``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from math import exp, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.calendar import minute_of_day
from barlake.operators import series
from barlake.operators.series import BLOCK_ROWS

KEYS = ["stock"]
ORDER = "date"

# Bands of |log return| that hint at a corporate action.
ACTION_BANDS = [(0.69, "large_split_or_merger"), (0.51, "definite_split"), (0.26, "likely_split")]
# Bands of |z|.
OUTLIER_BANDS = [(4.0, "extreme"), (3.0, "strong"), (2.0, "moderate")]
FAST_HALFLIFE, SLOW_HALFLIFE, FAST_WEIGHT = 5, 40, 0.7


def _framed(df: DataFrame, keys: Sequence[str], order: str, halo: int, block_rows: int,
            add: Callable[[DataFrame], DataFrame], value: str | None = None) -> DataFrame:
    return series.without_blocks(add(series.in_blocks(df, keys, order, halo, block_rows, value)))


def _gross_log(now: Column, before: Column) -> Column:
    return F.when((now > 0) & (before > 0), F.ln(now / before))


def log_returns(df: DataFrame, keys: Sequence[str] = KEYS, order: str = ORDER) -> DataFrame:
    """Add log_return and return_pct of close against the previous bar.

    Only the first bar of a month looks at another month: its previous close is
    carried in from the last bar of the nearest earlier month.
    """
    keys = list(keys)
    before = F.last("_last").over(series.earlier_chunks(keys))
    carried = series.with_carry(
        series.with_chunk(df, order), keys,
        {"_last": F.struct(F.max_by("close", order).alias("close"))},
        {"_in": before},
    )
    window = series.chunk_window(keys, order)
    first = F.row_number().over(window) == 1
    previous = F.when(first, F.col("_in.close")).otherwise(F.lag("close").over(window))
    return (
        carried.withColumn("log_return", _gross_log(F.col("close"), previous))
        .withColumn("return_pct", (F.exp("log_return") - 1) * 100)
        .select(*df.columns, "log_return", "return_pct")
    )


def add_returns(b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``log_returns``, of rows in blocks."""
    out = b.withColumn("log_return", _gross_log(F.col("close"), F.lag("close").over(series.block_window(keys))))
    return out.withColumn("return_pct", (F.exp("log_return") - 1) * 100)


def intraday_log_return(df: DataFrame) -> DataFrame:
    return df.withColumn("log_return", _gross_log(F.col("close"), F.col("open")))


def cumulative_return(df: DataFrame, keys: Sequence[str] = KEYS, order: str = ORDER) -> DataFrame:
    """Running product of gross returns from the first bar; needs ``log_return``."""
    keys = list(keys)
    total = F.coalesce(F.sum("_sum").over(series.earlier_chunks(keys)), F.lit(0.0))
    carried = series.with_carry(
        series.with_chunk(df, order), keys,
        {"_sum": F.coalesce(F.sum("log_return"), F.lit(0.0))}, {"_in": total},
    )
    window = series.chunk_window(keys, order).rowsBetween(series.Window.unboundedPreceding, 0)
    inside = F.coalesce(F.sum("log_return").over(window), F.lit(0.0))
    return carried.withColumn("cumulative_return", F.exp(F.col("_in") + inside)).select(
        *df.columns, "cumulative_return"
    )


def halflife_to_span(halflife: float) -> float:
    return 2 * halflife - 1


def _span_decay(span: float) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def span_memory(spans: Iterable[float]) -> int:
    return max(series.memory_rows(_span_decay(s)) for s in spans)


def add_ewma(b: DataFrame, value: str, spans: dict[str, float], keys: Sequence[str],
             stretch: int | None = None) -> DataFrame:
    x = F.col(value).cast("double")
    terms = {}
    for name, span in spans.items():
        terms[f"_num_{name}"] = (_span_decay(span), F.coalesce(x, F.lit(0.0)))
        terms[f"_den_{name}"] = (_span_decay(span), F.when(x.isNotNull(), 1.0).otherwise(0.0))
    solved = series.decayed_sums(b, keys, terms, series.row_steps(keys), stretch)
    so_far = series.block_window(keys).rowsBetween(series.Window.unboundedPreceding, 0)
    means = {n: F.when(x.isNotNull(), F.try_divide(F.col(f"_num_{n}"), F.col(f"_den_{n}"))) for n in spans}
    return solved.select(*b.columns, *[F.last(m, ignorenulls=True).over(so_far).alias(n) for n, m in means.items()])


def ewma(df: DataFrame, value: str, spans: dict[str, float], keys: Sequence[str] = KEYS,
         order: str = ORDER, block_rows: int = BLOCK_ROWS, stretch: int | None = None) -> DataFrame:
    """Exponentially weighted means, weights normalised from the first value on.

    Numerator and denominator are two sums with the same decay. Null values keep
    decaying the weights and repeat the last mean.
    """
    return _framed(
        df, keys, order, span_memory(spans.values()), block_rows,
        lambda b: add_ewma(b, value, spans, keys, stretch), value,
    )


def add_tema(b: DataFrame, value: str, spans: dict[str, float], keys: Sequence[str],
             stretch: int | None = None) -> DataFrame:
    has = F.col(value).isNotNull()
    out = b.withColumn("_seen", F.count(value).over(series.block_window(keys)))
    first = has & (F.col("_seen") == 1)
    for level in (1, 2, 3):
        terms = {}
        for name, span in spans.items():
            x = F.col(value if level == 1 else f"_e{level - 1}_{name}").cast("double")
            gain = F.when(first, x).when(has, x * (1.0 - _span_decay(span))).otherwise(0.0)
            terms[f"_e{level}_{name}"] = (_span_decay(span), gain)
        out = series.decayed_sums(out, keys, terms, F.when(has, 1).otherwise(0), stretch)
    mean = {n: 3 * F.col(f"_e1_{n}") - 3 * F.col(f"_e2_{n}") + F.col(f"_e3_{n}") for n in spans}
    return out.select(*b.columns, *[F.when(F.col("_seen") > 0, m).alias(n) for n, m in mean.items()])


def tema(df: DataFrame, value: str, spans: dict[str, float], keys: Sequence[str] = KEYS,
         order: str = ORDER, block_rows: int = BLOCK_ROWS, stretch: int | None = None) -> DataFrame:
    """3·e1 - 3·e2 + e3, each e the recursive mean of the one before, started at its first value.

    A null value leaves the means as they are; before the first value there is
    none. The start of a block fades like any old value, so the halo is the same
    as for one mean, doubled for the two that follow it.
    """
    halo = 2 * span_memory(spans.values())
    return _framed(df, keys, order, halo, block_rows, lambda b: add_tema(b, value, spans, keys, stretch), value)


def _wma(value: Column, n: int, keys: Sequence[str]) -> Column:
    """Weights 1..n, newest heaviest; null until n values are there.

    With positions p in the key, the weighted sum is sum(p·x) less (p_now - n)
    times sum(x). Positions are taken relative to the block, which keeps the
    difference exact to rounding.
    """
    frame = series.last_rows(keys, n)
    place = (F.col("rn") - F.col("block") * F.lit(BLOCK_ROWS)).cast("double")
    weighted = F.sum(value * place).over(frame) - (place - n) * F.sum(value).over(frame)
    return F.when(F.count(value).over(frame) == n, weighted / F.lit(n * (n + 1) / 2))


def wma(df: DataFrame, value: str, periods: dict[str, int], keys: Sequence[str] = KEYS,
        order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    x = F.col(value).cast("double")
    return _framed(
        df, keys, order, max(periods.values()) - 1, block_rows,
        lambda b: b.withColumns({n: _wma(x, p, keys) for n, p in periods.items()}),
    )


def hma_memory(periods: Iterable[int]) -> int:
    return max(p + isqrt(p) for p in periods) - 2


def add_hma(b: DataFrame, value: str, periods: dict[str, int], keys: Sequence[str]) -> DataFrame:
    x = F.col(value).cast("double")
    raw = {f"_raw_{n}": 2 * _wma(x, p // 2, keys) - _wma(x, p, keys) for n, p in periods.items()}
    b = b.withColumns(raw)
    b = b.withColumns({n: _wma(F.col(f"_raw_{n}"), isqrt(p), keys) for n, p in periods.items()})
    return b.drop(*raw)


def hma(df: DataFrame, value: str, periods: dict[str, int], keys: Sequence[str] = KEYS,
        order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """WMA over ⌊√n⌋ of 2·WMA(⌊n/2⌋) - WMA(n); all passes share one shuffle."""
    return _framed(
        df, keys, order, hma_memory(periods.values()), block_rows, lambda b: add_hma(b, value, periods, keys)
    )


def add_alma(b: DataFrame, value: str, name: str, keys: Sequence[str], window: int = 30,
             offset: float = 0.85, sigma: float = 6.0) -> DataFrame:
    centre, width = offset * (window - 1), window / sigma
    weights = [exp(-((i - centre) ** 2) / (2 * width * width)) for i in range(window)]
    total = sum(weights)
    x = F.col(value).cast("double")
    frame = series.last_rows(keys, window)
    fixed = F.array(*[F.lit(w / total) for w in weights])
    terms = F.zip_with(F.collect_list(x).over(frame), fixed, lambda v, w: v * w)
    mean = F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    return b.withColumn(name, F.when(F.count(x).over(frame) == window, mean))


def alma(df: DataFrame, value: str, name: str, window: int = 30, keys: Sequence[str] = KEYS,
         order: str = ORDER, block_rows: int = BLOCK_ROWS, **shape) -> DataFrame:
    """Gaussian weights centred at ``offset`` of the window; null until it is full."""
    return _framed(
        df, keys, order, window - 1, block_rows, lambda b: add_alma(b, value, name, keys, window, **shape)
    )


def kama_memory(period: int = 10, slow: int = 30) -> int:
    return period + series.memory_rows(1.0 - (2.0 / (slow + 1)) ** 2)


def add_kama(b: DataFrame, value: str, name: str, keys: Sequence[str], period: int = 10,
             fast: int = 2, slow: int = 30, start: Column | None = None) -> DataFrame:
    """``start``, where it is not null, stands for the value at position ``period - 1``."""
    x = F.col(value).cast("double")
    quick, calm = 2.0 / (fast + 1), 2.0 / (slow + 1)
    window = series.block_window(keys)
    out = b.withColumn("_move", F.abs(x - F.lag(x).over(window)))
    moves = F.sum("_move").over(series.last_rows(keys, period))
    ratio = F.coalesce(F.try_divide(F.abs(x - F.lag(x, period).over(window)), moves), F.lit(0.0))
    steep = ratio * (quick - calm) + calm
    seed, before = F.col("rn") == period - 1, F.col("rn") < period - 1
    first = x if start is None else F.coalesce(start, x)
    # a block begins from its first value, which its halo lets fade
    opens = F.row_number().over(window) == 1
    solved = series.recurrence(out, keys, steep * steep, x, F.when(seed, first).when(before | opens, x), "_k")
    return solved.select(*b.columns, F.when(~before, F.col("_k")).alias(name))


def kama(df: DataFrame, value: str, name: str, period: int = 10, fast: int = 2, slow: int = 30,
         keys: Sequence[str] = KEYS, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adaptive mean: the gain follows the efficiency ratio of the last ``period`` moves.

    Starts from the value at position ``period - 1``; null before. The gain
    depends on values only, so the mean is a linear recurrence with varying
    coefficients. Values must not be null.
    """
    return _framed(
        df, keys, order, kama_memory(period, slow), block_rows,
        lambda b: add_kama(b, value, name, keys, period, fast, slow),
    )


BASELINES = ("volume_ewma_fast", "volume_ewma_slow")


def baseline_memory(kind: str, fast_halflife: int = FAST_HALFLIFE, slow_halflife: int = SLOW_HALFLIFE,
                    **options) -> int:
    """Rows before a bar that its baseline can depend on."""
    halves = (fast_halflife, slow_halflife)
    if kind in ("ewma", "tema"):
        rows = span_memory([halflife_to_span(h) for h in halves])
        return rows if kind == "ewma" else 2 * rows
    if kind == "hma":
        return hma_memory(halves)
    if kind == "alma":
        return options.get("window", 30) - 1
    if kind == "kama":
        return kama_memory(options.get("period", 10), options.get("slow", 30))
    raise ValueError(f"unknown moving average: {kind}")


def add_volume_baseline(b: DataFrame, kind: str, keys: Sequence[str], fast_halflife: int = FAST_HALFLIFE,
                        slow_halflife: int = SLOW_HALFLIFE, fast_weight: float = FAST_WEIGHT,
                        **options) -> DataFrame:
    halves = (fast_halflife, slow_halflife)
    if kind in ("ewma", "tema"):
        mean = add_ewma if kind == "ewma" else add_tema
        out = mean(b, "volume", {n: halflife_to_span(h) for n, h in zip(BASELINES, halves)}, keys, **options)
    elif kind == "hma":
        out = add_hma(b, "volume", dict(zip(BASELINES, halves)), keys)
    elif kind == "alma":
        return add_alma(b, "volume", "volume_baseline", keys, **options)
    else:
        return add_kama(b, "volume", "volume_baseline", keys, **options)
    fast, slow = (F.col(n) for n in BASELINES)
    return out.withColumn("volume_baseline", fast_weight * fast + (1 - fast_weight) * slow)


def volume_baseline(df: DataFrame, kind: str = "ewma", keys: Sequence[str] = KEYS, order: str = ORDER,
                    block_rows: int = BLOCK_ROWS, **options) -> DataFrame:
    """Add volume_ewma_fast, volume_ewma_slow (two-speed kinds) and volume_baseline."""
    halo = baseline_memory(kind, **options)
    return _framed(
        df, keys, order, halo, block_rows, lambda b: add_volume_baseline(b, kind, keys, **options), "volume"
    )


def relative_volume(df: DataFrame) -> DataFrame:
    return df.withColumn("relative_volume", F.try_divide(F.col("volume").cast("double"), F.col("volume_baseline")))


def add_zscore(b: DataFrame, value: str, name: str, keys: Sequence[str], window: int = 20) -> DataFrame:
    x = F.col(value).cast("double")
    frame = series.last_rows(keys, window)
    enough = F.count(x).over(frame) >= window // 2
    score = F.try_divide(x - F.avg(x).over(frame), F.stddev_samp(x).over(frame))
    return b.withColumn(name, F.when(enough, score))


def zscore(df: DataFrame, value: str, name: str = "volume_zscore", window: int = 20,
           keys: Sequence[str] = KEYS, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distance from the rolling mean in sample deviations; needs half a window of values."""
    return _framed(
        df, keys, order, window - 1, block_rows, lambda b: add_zscore(b, value, name, keys, window)
    )


def scored_returns(df: DataFrame, value: str = "volume", name: str = "volume_zscore", window: int = 20,
                   keys: Sequence[str] = KEYS, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``log_returns`` and ``zscore`` in one set of blocks, so the input is read and shuffled for both at once."""
    def add(b: DataFrame) -> DataFrame:
        return add_zscore(add_returns(b, keys), value, name, keys, window)

    return _framed(df, keys, order, max(window - 1, 1), block_rows, add)


def add_percentile(b: DataFrame, value: str, name: str, keys: Sequence[str], window: int = 20) -> DataFrame:
    x = F.col(value).cast("double")
    recent = b.withColumn("_recent", F.collect_list(x).over(series.last_rows(keys, window)))
    below = F.size(F.filter("_recent", lambda v: v <= x))
    share = F.try_divide(below * F.lit(100.0), F.size("_recent"))
    return recent.withColumn(name, F.when(x.isNotNull(), share)).drop("_recent")


def volume_percentile(df: DataFrame, value: str = "volume", name: str = "volume_percentile",
                      window: int = 20, keys: Sequence[str] = KEYS, order: str = ORDER,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Share (0-100) of the last ``window`` values that are not above the current one."""
    return _framed(
        df, keys, order, window - 1, block_rows, lambda b: add_percentile(b, value, name, keys, window)
    )


def _band(value: Column, bands: Sequence[tuple[float, str]]) -> Column:
    result = F.lit(None).cast("string")
    for limit, label in reversed(bands):
        result = F.when(value > limit, label).otherwise(result)
    return result


def detect_corporate_actions(df: DataFrame, threshold: float = 0.26) -> DataFrame:
    """Rows whose |log_return| is above the threshold, with the band it falls in."""
    size = F.abs("log_return")
    return df.filter(size > threshold).withColumn("action", _band(size, ACTION_BANDS))


def clean_returns(df: DataFrame, threshold: float = 0.26, keys: Sequence[str] = KEYS,
                  order: str = ORDER) -> DataFrame:
    """Add clean_return: flagged returns replaced by linear interpolation over rows.

    Leading gaps stay null, trailing ones repeat the last value. The nearest
    known return outside the month is carried in with its row position.
    """
    keys = list(keys)
    kept = F.when(F.abs("log_return") <= threshold, F.col("log_return"))
    numbered = series.number_rows(df.withColumn("_x", kept), keys, order)
    known = F.when(F.col("_x").isNotNull(), F.struct(F.col("rn").alias("at"), F.col("_x").alias("x")))
    carried = series.with_carry(
        numbered, keys,
        {"_first": F.min_by(known, F.when(known.isNotNull(), F.col("rn"))),
         "_last": F.max_by(known, F.when(known.isNotNull(), F.col("rn")))},
        {"_left": F.last("_last", ignorenulls=True).over(series.earlier_chunks(keys)),
         "_right": F.first("_first", ignorenulls=True).over(series.later_chunks(keys))},
    )
    window = series.chunk_window(keys, order)
    left = F.coalesce(
        F.last(known, ignorenulls=True).over(window.rowsBetween(series.Window.unboundedPreceding, 0)), F.col("_left")
    )
    right = F.coalesce(
        F.first(known, ignorenulls=True).over(window.rowsBetween(0, series.Window.unboundedFollowing)), F.col("_right")
    )
    placed = carried.withColumn("_l", left).withColumn("_r", right)
    slope = F.try_divide(F.col("_r.x") - F.col("_l.x"), (F.col("_r.at") - F.col("_l.at")).cast("double"))
    between = F.col("_l.x") + slope * (F.col("rn") - F.col("_l.at"))
    value = (
        F.when(F.col("_x").isNotNull(), F.col("_x"))
        .when(F.col("_l").isNull(), F.lit(None))
        .when(F.col("_r").isNull(), F.col("_l.x"))
        .otherwise(between)
    )
    return placed.select(*df.columns, value.alias("clean_return"))


def overnight_gap(df: DataFrame, limit: float = 0.20, keys: Sequence[str] = KEYS,
                  order: str = ORDER) -> DataFrame:
    """Previous close to open of the next trading date, flagged above ``limit``.

    Bars of a date are first reduced to its open and close, so one key has one
    row per date.
    """
    keys = list(keys)
    daily = df.groupBy(*keys, F.to_date(order).alias("day")).agg(
        F.min_by("open", order).alias("open"), F.max_by("close", order).alias("close")
    )
    before = series.Window.partitionBy(*keys).orderBy("day")
    return (
        daily.withColumn("previous_close", F.lag("close").over(before))
        .withColumn("gap", F.try_divide(F.col("open"), F.col("previous_close")) - 1)
        .filter(F.abs("gap") > limit)
    )


def seasonality_profile(bars: DataFrame, as_of: str, lookback_days: int = 90,
                        keys: Sequence[str] = (), order: str = ORDER) -> DataFrame:
    """Median volume per minute of day over the lookback, divided by its mean."""
    keys = list(keys)
    end = F.lit(as_of).cast("date")
    recent = bars.filter(
        (F.to_date(order) > F.date_sub(end, lookback_days)) & (F.to_date(order) <= end)
    ).select(*keys, minute_of_day(order).alias("minute_of_day"), F.col("volume").cast("double").alias("volume"))
    medians = series.exact_median(recent, [*keys, "minute_of_day"], "volume", "median_volume")
    mean = F.avg("median_volume").over(series.Window.partitionBy(*(keys or [F.lit(0)])))
    return medians.select(
        *keys, "minute_of_day", F.try_divide(F.col("median_volume"), mean).alias("seasonality_factor")
    )


def seasonality_lookup(bars: DataFrame, market: DataFrame, ticker: DataFrame | None = None,
                       keys: Sequence[str] = KEYS, order: str = ORDER) -> DataFrame:
    """Add seasonality_factor: the ticker's own, else the market's, else 1.

    The market profile is brought to one row a minute, 1,440 at most, and may be
    broadcast whatever the bars' size (of repeated minutes the largest factor
    counts); how the ticker profiles are joined is left to the planner.
    """
    placed = bars.withColumn("minute_of_day", minute_of_day(order))
    general = (market.filter(F.col("minute_of_day").between(0, 1439)).groupBy("minute_of_day")
               .agg(F.max("seasonality_factor").alias("_market")))
    out = placed.join(F.broadcast(general), "minute_of_day", "left")
    factor = [F.col("_market"), F.lit(1.0)]
    if ticker is not None:
        own = ticker.select(*keys, "minute_of_day", F.col("seasonality_factor").alias("_own"))
        out = out.join(own, [*keys, "minute_of_day"], "left")
        factor.insert(0, F.col("_own"))
    return out.select(*bars.columns, F.coalesce(*factor).alias("seasonality_factor"))


def adjust_for_seasonality(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "relative_volume_adjusted", F.try_divide(F.col("relative_volume"), F.col("seasonality_factor"))
    )


def normalize_analytics(bars: DataFrame, market: DataFrame, ticker: DataFrame | None = None,
                        kind: str = "ewma", window: int = 20, keys: Sequence[str] = KEYS, order: str = ORDER,
                        block_rows: int = BLOCK_ROWS, **options) -> DataFrame:
    """All normalised columns of a bar table.

    One set of blocks serves returns, baseline, scores and percentile; its halo
    is the memory of the baseline plus that of the score. Seasonality is joined
    before the blocks are formed, so no join stands between the windows.
    """
    halo = baseline_memory(kind, **options) + window
    seasoned = seasonality_lookup(bars, market, ticker, keys, order)

    def add(b: DataFrame) -> DataFrame:
        out = relative_volume(add_volume_baseline(add_returns(b, keys), kind, keys, **options))
        out = adjust_for_seasonality(out)
        out = add_zscore(out, "relative_volume_adjusted", "volume_zscore", keys, window)
        return add_percentile(out, "relative_volume_adjusted", "volume_percentile", keys, window)

    return cumulative_return(_framed(seasoned, keys, order, halo, block_rows, add, "volume"), keys, order)


def movers(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("log_return").alias("total_return"),
        F.stddev_samp("log_return").alias("volatility"),
        F.max("volume_zscore").alias("max_volume_spike"),
    ).orderBy(F.desc_nulls_last(F.abs("total_return")), *keys)


def market_volatility(df: DataFrame, market: str = "market", keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean over tickers of each ticker's volatility and mean volume score."""
    per_ticker = df.groupBy(market, *keys).agg(
        F.stddev_samp("log_return").alias("volatility"), F.avg("volume_zscore").alias("score")
    )
    return per_ticker.groupBy(market).agg(
        F.avg("volatility").alias("avg_volatility"), F.avg("score").alias("avg_relative_volume")
    )


def intraday_profile(df: DataFrame, order: str = ORDER) -> DataFrame:
    return df.groupBy(F.hour(order).alias("hour"), F.minute(order).alias("minute")).agg(
        F.avg("volume_zscore").alias("avg_zscore"),
        F.avg("relative_volume_adjusted").alias("avg_relative_volume"),
    )


def anomaly_filter(df: DataFrame, threshold: float = 3.0, sanity: float = 5.0) -> DataFrame:
    """Scores above the threshold, their band, and an alert on implausible ones."""
    size = F.abs("volume_zscore")
    return df.filter(F.col("volume_zscore") > threshold).withColumns(
        {"tier": _band(size, OUTLIER_BANDS), "sanity_alert": size > sanity}
    )


def split_factors(splits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per key, half-open date ranges [valid_from, valid_to) and their split factor.

    The factor of a range is the product of the ratios of all later splits, so
    each bar meets one range and the join never multiplies rows.
    """
    keys = list(keys)
    per_day = splits.groupBy(*keys, F.col("date").alias("split_date")).agg(
        F.sum(F.ln("ratio")).alias("_ln")
    )
    ahead = series.Window.partitionBy(*keys).orderBy("split_date")
    here = per_day.select(
        *keys,
        F.lag("split_date").over(ahead).alias("valid_from"),
        F.col("split_date").alias("valid_to"),
        F.exp(F.sum("_ln").over(ahead.rowsBetween(0, series.Window.unboundedFollowing))).alias("split_factor"),
    )
    return here


def split_adjust(bars: DataFrame, splits: DataFrame, keys: Sequence[str] = KEYS,
                 order: str = ORDER) -> DataFrame:
    """Add split_factor and adjusted_close; splits dated after the bar count."""
    keys = list(keys)
    ranges = split_factors(splits, keys)
    for k in keys:
        ranges = ranges.withColumnRenamed(k, f"_k_{k}")
    match = (F.col(order) < F.col("valid_to")) & (
        F.col("valid_from").isNull() | (F.col(order) >= F.col("valid_from"))
    )
    for k in keys:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    joined = bars.join(ranges, match, "left")
    factor = F.coalesce("split_factor", F.lit(1.0))
    return joined.select(
        *bars.columns, factor.alias("split_factor"), (F.col("close") / factor).alias("adjusted_close")
    )


def linear_fit(df: DataFrame, group: str, x: str, y: str, feasible: str | None = None) -> DataFrame:
    """Slope, intercept and R² per group of two or more feasible points."""
    points = df.filter(F.col(feasible)) if feasible else df
    return (
        points.groupBy(group)
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r_squared"),
            F.count(F.lit(1)).alias("points"),
        )
        .filter(F.col("points") >= 2)
    )


def fit_residuals(df: DataFrame, fit: DataFrame, group: str, x: str, y: str) -> DataFrame:
    predicted = F.col("slope") * F.col(x) + F.col("intercept")
    return df.join(fit, group).select(
        *df.columns, predicted.alias("predicted"), (F.col(y) - predicted).alias("residual")
    )
