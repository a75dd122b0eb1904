"""Queries of returns, volume baselines, scores, seasonality and adjustments."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import analytics as ops
from barlake.plans import views
from barlake.plans.catalog import query, rounded
from barlake.plans.views import table

BARS = f"WITH {views.BARS_DAILY}"
KEY = "PARTITION BY stock ORDER BY date"
RETURNS = f"""{BARS}, r AS (SELECT *, ln(close / lag(close) OVER ({KEY})) AS log_return FROM bars)"""


def _returns(spark, sf):
    return ops.log_returns(views.bars_daily(spark, sf))


@query("log_returns", f"{RETURNS} SELECT stock, date, round(log_return, 6) AS log_return, round((exp(log_return) - 1) * 100, 4) AS return_pct FROM r")
def log_returns(spark, sf):
    out = _returns(spark, sf).select("stock", "date", "log_return", "return_pct")
    return rounded(rounded(out, 6, "log_return"), 4, "return_pct")


@query("intraday_log_return", f"{BARS} SELECT stock, date, round(ln(close / open), 6) AS log_return FROM bars")
def intraday_log_return(spark, sf):
    return rounded(ops.intraday_log_return(views.bars_daily(spark, sf)), 6, "log_return").select("stock", "date", "log_return")


@query("cumulative_return", f"""{RETURNS} SELECT stock, date, round(exp(coalesce(sum(log_return) OVER ({KEY} ROWS UNBOUNDED PRECEDING), 0)), 6) AS cumulative_return FROM r""")
def cumulative_return(spark, sf):
    return rounded(ops.cumulative_return(_returns(spark, sf)), 6, "cumulative_return").select("stock", "date", "cumulative_return")


# Weighted sums over all earlier bars of the key, spelled out.
POWERS = f"""{BARS}, n AS (SELECT stock, date, volume, row_number() OVER ({KEY}) AS t FROM bars),
  e AS (SELECT a.stock, a.date, sum(pow(0.8, a.t - b.t) * b.volume) / sum(pow(0.8, a.t - b.t)) AS fast,
               sum(pow(0.975, a.t - b.t) * b.volume) / sum(pow(0.975, a.t - b.t)) AS slow
        FROM n a JOIN n b ON a.stock = b.stock AND b.t <= a.t GROUP BY a.stock, a.date)"""


@query("ewma_baseline", f"""{POWERS} SELECT stock, date, round(fast, 6) AS volume_ewma_fast, round(slow, 6) AS volume_ewma_slow,
  round(0.7 * fast + 0.3 * slow, 6) AS volume_baseline FROM e""")
def ewma_baseline(spark, sf):
    out = ops.volume_baseline(views.bars_daily(spark, sf))
    names = ["volume_ewma_fast", "volume_ewma_slow", "volume_baseline"]
    return rounded(out, 6, *names).select("stock", "date", *names)


@query("relative_volume", f"""{POWERS} SELECT e.stock, e.date, round(n.volume / (0.7 * fast + 0.3 * slow), 6) AS relative_volume
  FROM e JOIN n ON e.stock = n.stock AND e.date = n.date""")
def relative_volume(spark, sf):
    out = ops.relative_volume(ops.volume_baseline(views.bars_daily(spark, sf)))
    return rounded(out, 6, "relative_volume").select("stock", "date", "relative_volume")


def _wma_sql(value: str, n: int, source: str, name: str) -> str:
    terms = " + ".join(f"{n - i} * lag({value}, {i}) OVER ({KEY})" for i in range(n))
    return f"SELECT *, ({terms}) / {n * (n + 1) / 2} AS {name} FROM {source}"


@query("wma", f"""{BARS} SELECT stock, date, round(w, 6) AS wma_5, round(v, 6) AS wma_10 FROM ({_wma_sql('volume', 10, '(' + _wma_sql('volume', 5, 'bars', 'w') + ')', 'v')})""")
def wma(spark, sf):
    out = ops.wma(views.bars_daily(spark, sf), "volume", {"wma_5": 5, "wma_10": 10})
    return rounded(out, 6, "wma_5", "wma_10").select("stock", "date", "wma_5", "wma_10")


@query("hma", f"""{BARS}, a AS ({_wma_sql('volume', 8, 'bars', 'half')}), b AS ({_wma_sql('volume', 16, 'a', 'whole')}),
  c AS (SELECT *, 2 * half - whole AS raw FROM b), d AS ({_wma_sql('raw', 4, 'c', 'h')}) SELECT stock, date, round(h, 6) AS hma_16 FROM d""")
def hma(spark, sf):
    out = ops.hma(views.bars_daily(spark, sf), "volume", {"hma_16": 16})
    return rounded(out, 6, "hma_16").select("stock", "date", "hma_16")


def _hma_sql(n: int, name: str, source: str) -> str:
    from math import isqrt

    half, whole = _wma_sql("volume", n // 2, source, "half"), _wma_sql("volume", n, "h1", "whole")
    return f"""h1 AS ({half}), h2 AS ({whole}), h3 AS (SELECT * EXCLUDE (half, whole), 2 * half - whole AS raw FROM h2),
  {name} AS ({_wma_sql("raw", isqrt(n), "h3", name)})"""


@query("hma_baseline", f"""{BARS}, {_hma_sql(5, "fast", "bars")}, {_hma_sql(40, "slow", "bars").replace("h1", "g1").replace("h2", "g2").replace("h3", "g3")}
  SELECT f.stock, f.date, round(0.7 * f.fast + 0.3 * s.slow, 6) AS volume_baseline FROM fast f JOIN slow s ON f.stock = s.stock AND f.date = s.date""")
def hma_baseline(spark, sf):
    out = ops.volume_baseline(views.bars_daily(spark, sf), "hma")
    return rounded(out, 6, "volume_baseline").select("stock", "date", "volume_baseline")


def _recursive_mean_sql(source: str, value: str, name: str) -> str:
    """Recursive means of both speeds, each written as a weighted sum of all earlier rows."""
    def term(a: float, column: str) -> str:
        return f"sum(pow({a}, a.t - b.t) * b.{column} * CASE WHEN b.t = 1 THEN 1.0 ELSE {1 - a:.3f} END)"

    fast, slow = (f"fast_{value}", f"slow_{value}") if value != "volume" else ("volume", "volume")
    return f"""SELECT a.stock, a.date, a.t, {term(0.8, fast)} AS fast_{name}, {term(0.975, slow)} AS slow_{name}
        FROM {source} a JOIN {source} b ON a.stock = b.stock AND b.t <= a.t GROUP BY a.stock, a.date, a.t"""


@query("tema_baseline", f"""{BARS}, n AS (SELECT stock, date, volume, row_number() OVER ({KEY}) AS t FROM bars),
  m1 AS ({_recursive_mean_sql("n", "volume", "e1")}), m2 AS ({_recursive_mean_sql("m1", "e1", "e2")}), m3 AS ({_recursive_mean_sql("m2", "e2", "e3")})
  SELECT m1.stock, m1.date, floor((0.7 * (3 * fast_e1 - 3 * fast_e2 + fast_e3) + 0.3 * (3 * slow_e1 - 3 * slow_e2 + slow_e3)) * 100000 + 0.31) / 100000 AS volume_baseline
  FROM m1 JOIN m2 ON m1.stock = m2.stock AND m1.t = m2.t JOIN m3 ON m1.stock = m3.stock AND m1.t = m3.t""")
def tema_baseline(spark, sf):
    # means of few whole numbers end in exact halves: cut off-centre, as in split_adjust
    out = ops.volume_baseline(views.bars_daily(spark, sf), "tema")
    cut = (F.floor(F.col("volume_baseline") * 100000 + 0.31) / 100000).alias("volume_baseline")
    return out.select("stock", "date", cut)


def _alma_sql(window: int) -> str:
    from math import exp

    centre, width = 0.85 * (window - 1), window / 6.0
    weights = [exp(-((i - centre) ** 2) / (2 * width * width)) for i in range(window)]
    terms = " + ".join(f"{w / sum(weights)!r}::DOUBLE * lag(volume, {window - 1 - i}) OVER ({KEY})" for i, w in enumerate(weights))
    return f"{BARS} SELECT stock, date, round({terms}, 6) AS volume_baseline FROM bars"


@query("alma", _alma_sql(9))
def alma(spark, sf):
    out = ops.volume_baseline(views.bars_daily(spark, sf), "alma", window=9)
    return rounded(out, 6, "volume_baseline").select("stock", "date", "volume_baseline")


MOVES = "sum(abs(volume - before)) OVER (PARTITION BY stock ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query("kama", f"""WITH RECURSIVE {BARS.removeprefix("WITH ")}, n AS (SELECT stock, date, volume, row_number() OVER ({KEY}) AS t,
    lag(volume) OVER ({KEY}) AS before, lag(volume, 10) OVER ({KEY}) AS past FROM bars),
  g AS (SELECT *, pow(coalesce(abs(volume - past) / nullif({MOVES}, 0), 0) * (2.0::DOUBLE / 3 - 2.0::DOUBLE / 31) + 2.0::DOUBLE / 31, 2) AS gain FROM n),
  k AS (SELECT stock, date, t, CAST(volume AS DOUBLE) AS y FROM g WHERE t = 10
    UNION ALL SELECT g.stock, g.date, g.t, k.y + g.gain * (g.volume - k.y) FROM k JOIN g ON g.stock = k.stock AND g.t = k.t + 1)
  SELECT n.stock, n.date, round(k.y, 6) AS volume_baseline FROM n LEFT JOIN k ON n.stock = k.stock AND n.t = k.t""")
def kama(spark, sf):
    out = ops.volume_baseline(views.bars_daily(spark, sf), "kama")
    return rounded(out, 6, "volume_baseline").select("stock", "date", "volume_baseline")


FRAME = f"({KEY} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
SCORES = f"""{RETURNS}, z AS (SELECT *, CASE WHEN count(volume) OVER {FRAME} >= 10 THEN
  (volume - avg(volume) OVER {FRAME}) / nullif(stddev_samp(volume) OVER {FRAME}, 0) END AS volume_zscore FROM r)"""


def _scores(spark, sf):
    return ops.scored_returns(views.bars_daily(spark, sf))


@query("volume_zscore", f"{SCORES} SELECT stock, date, round(volume_zscore, 6) AS volume_zscore FROM z")
def volume_zscore(spark, sf):
    out = ops.zscore(views.bars_daily(spark, sf), "volume")
    return rounded(out, 6, "volume_zscore").select("stock", "date", "volume_zscore")


@query("volume_percentile", f"""{BARS}, l AS (SELECT *, list(volume) OVER {FRAME} AS recent FROM bars)
  SELECT stock, date, round(100.0 * len([v for v in recent if v <= volume]) / len(recent), 6) AS volume_percentile FROM l""")
def volume_percentile(spark, sf):
    out = ops.volume_percentile(views.bars_daily(spark, sf))
    return rounded(out, 6, "volume_percentile").select("stock", "date", "volume_percentile")


@query("detect_corporate_actions", f"""{RETURNS} SELECT stock, date, CASE WHEN abs(log_return) > 0.69 THEN 'large_split_or_merger'
  WHEN abs(log_return) > 0.51 THEN 'definite_split' ELSE 'likely_split' END AS action FROM r WHERE abs(log_return) > 0.26""")
def detect_corporate_actions(spark, sf):
    return ops.detect_corporate_actions(_returns(spark, sf)).select("stock", "date", "action")


@query("clean_returns", f"""{RETURNS}, k AS (SELECT stock, date, CASE WHEN abs(log_return) <= 0.26 THEN log_return END AS x, row_number() OVER ({KEY}) AS t FROM r),
  p AS (SELECT *, last_value(x IGNORE NULLS) OVER w AS lx, last_value(CASE WHEN x IS NOT NULL THEN t END IGNORE NULLS) OVER w AS lt,
    first_value(x IGNORE NULLS) OVER v AS rx, first_value(CASE WHEN x IS NOT NULL THEN t END IGNORE NULLS) OVER v AS rt FROM k
    WINDOW w AS ({KEY} ROWS UNBOUNDED PRECEDING), v AS ({KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  SELECT stock, date, round(CASE WHEN x IS NOT NULL THEN x WHEN lx IS NULL THEN NULL WHEN rx IS NULL THEN lx
    ELSE lx + (rx - lx) / (rt - lt) * (t - lt) END, 6) AS clean_return FROM p""")
def clean_returns(spark, sf):
    out = ops.clean_returns(_returns(spark, sf))
    return rounded(out, 6, "clean_return").select("stock", "date", "clean_return")


@query("overnight_gap", f"""{BARS}, g AS (SELECT stock, CAST(date AS DATE) AS day, open / lag(close) OVER ({KEY}) - 1 AS gap FROM bars)
  SELECT stock, day, round(gap, 6) AS gap FROM g WHERE abs(gap) > 0.20""")
def overnight_gap(spark, sf):
    return rounded(ops.overnight_gap(views.bars_daily(spark, sf)), 6, "gap").select("stock", "day", "gap")


HOURS = f"WITH {views.HOUR_BARS}"
PROFILE = f"""{HOURS}, m AS (SELECT hour(date) * 60 + minute(date) AS minute_of_day, median(volume) AS v FROM hour_bars
  WHERE CAST(date AS DATE) > DATE '2023-11-01' AND CAST(date AS DATE) <= DATE '2024-01-30' GROUP BY 1),
  profile AS (SELECT CAST(minute_of_day AS INTEGER) AS minute_of_day, v / avg(v) OVER () AS seasonality_factor FROM m)"""
AS_OF = "2024-01-30"


def _profile(spark, sf):
    return ops.seasonality_profile(views.hour_bars(spark, sf), AS_OF)


@query("seasonality_profile", f"{PROFILE} SELECT minute_of_day, round(seasonality_factor, 6) AS seasonality_factor FROM profile")
def seasonality_profile(spark, sf):
    return rounded(_profile(spark, sf), 6, "seasonality_factor")


@query("seasonality_per_ticker", f"""{HOURS}, m AS (SELECT stock, CAST(hour(date) * 60 + minute(date) AS INTEGER) AS minute_of_day, median(volume) AS v FROM hour_bars GROUP BY 1, 2)
  SELECT stock, minute_of_day, round(v / avg(v) OVER (PARTITION BY stock), 6) AS seasonality_factor FROM m""")
def seasonality_per_ticker(spark, sf):
    return rounded(ops.seasonality_profile(views.hour_bars(spark, sf), AS_OF, keys=["stock"]), 6, "seasonality_factor")


OWN = """own AS (SELECT stock, CAST(hour(date) * 60 + minute(date) AS INTEGER) AS minute_of_day, median(volume) AS v FROM hour_bars WHERE trade_count > 1 GROUP BY 1, 2),
  factors AS (SELECT stock, minute_of_day, v / avg(v) OVER (PARTITION BY stock) AS f FROM own)"""


@query("seasonality_lookup", f"""{PROFILE}, {OWN} SELECT h.stock, h.date, round(coalesce(f.f, p.seasonality_factor, 1.0), 6) AS seasonality_factor
  FROM hour_bars h LEFT JOIN factors f ON h.stock = f.stock AND hour(h.date) * 60 + minute(h.date) = f.minute_of_day
  LEFT JOIN profile p ON hour(h.date) * 60 + minute(h.date) = p.minute_of_day""")
def seasonality_lookup(spark, sf):
    hours = views.hour_bars(spark, sf)
    own = ops.seasonality_profile(hours.filter(F.col("trade_count") > 1), AS_OF, keys=["stock"])
    out = ops.seasonality_lookup(hours, _profile(spark, sf), own)
    return rounded(out, 6, "seasonality_factor").select("stock", "date", "seasonality_factor")


HOUR_POWERS = f"""{PROFILE}, n AS (SELECT *, row_number() OVER ({KEY}) AS t FROM hour_bars),
  e AS (SELECT a.stock, a.date, any_value(a.volume) AS volume, sum(pow(0.8, a.t - b.t) * b.volume) / sum(pow(0.8, a.t - b.t)) AS fast,
        sum(pow(0.975, a.t - b.t) * b.volume) / sum(pow(0.975, a.t - b.t)) AS slow
        FROM n a JOIN n b ON a.stock = b.stock AND b.t <= a.t GROUP BY a.stock, a.date),
  adjusted AS (SELECT stock, date, volume / (0.7 * fast + 0.3 * slow) / coalesce(seasonality_factor, 1.0) AS x
        FROM e LEFT JOIN profile p ON hour(date) * 60 + minute(date) = p.minute_of_day),
  z AS (SELECT *, CASE WHEN count(x) OVER {FRAME} >= 10 THEN (x - avg(x) OVER {FRAME}) / nullif(stddev_samp(x) OVER {FRAME}, 0) END AS volume_zscore FROM adjusted)"""


def _normalized_hours(spark, sf):
    return ops.normalize_analytics(views.hour_bars(spark, sf), _profile(spark, sf))


@query("relative_volume_adjusted", f"{HOUR_POWERS} SELECT stock, date, round(x, 6) AS relative_volume_adjusted FROM z")
def relative_volume_adjusted(spark, sf):
    out = ops.relative_volume(ops.volume_baseline(views.hour_bars(spark, sf)))
    out = ops.adjust_for_seasonality(ops.seasonality_lookup(out, _profile(spark, sf)))
    return rounded(out, 6, "relative_volume_adjusted").select("stock", "date", "relative_volume_adjusted")


@query("normalize_analytics", f"{HOUR_POWERS} SELECT stock, date, round(x, 6) AS relative_volume_adjusted, round(volume_zscore, 5) AS volume_zscore FROM z")
def normalize_analytics(spark, sf):
    out = _normalized_hours(spark, sf).select("stock", "date", "relative_volume_adjusted", "volume_zscore")
    return rounded(rounded(out, 6, "relative_volume_adjusted"), 5, "volume_zscore")


@query("intraday_profile", f"""{HOUR_POWERS} SELECT CAST(hour(date) AS INTEGER) AS hour, CAST(minute(date) AS INTEGER) AS minute,
  round(avg(volume_zscore), 5) AS avg_zscore, round(avg(x), 6) AS avg_relative_volume FROM z GROUP BY 1, 2""")
def intraday_profile(spark, sf):
    return rounded(rounded(ops.intraday_profile(_normalized_hours(spark, sf)), 5, "avg_zscore"), 6, "avg_relative_volume")


@query("movers", f"""{SCORES} SELECT stock, round(sum(log_return), 6) AS total_return, round(stddev_samp(log_return), 6) AS volatility,
  round(max(volume_zscore), 6) AS max_volume_spike FROM z GROUP BY 1""")
def movers(spark, sf):
    return rounded(ops.movers(_scores(spark, sf)), 6, "total_return", "volatility", "max_volume_spike")


@query("market_volatility", f"""{SCORES}, m AS (SELECT p_brand AS market, stock, stddev_samp(log_return) AS v, avg(volume_zscore) AS s
    FROM z JOIN part ON stock = printf('P%06d', p_partkey) GROUP BY 1, 2)
  SELECT market, round(avg(v), 6) AS avg_volatility, round(avg(s), 6) AS avg_relative_volume FROM m GROUP BY 1""")
def market_volatility(spark, sf):
    brand = table(spark, sf, "part").select(F.format_string("P%06d", "p_partkey").alias("stock"), F.col("p_brand").alias("market"))
    out = ops.market_volatility(_scores(spark, sf).join(brand, "stock"))
    return rounded(out, 6, "avg_volatility", "avg_relative_volume")


@query("anomaly_filter", f"""{SCORES} SELECT stock, date, volume, round(volume_zscore, 6) AS volume_zscore,
  CASE WHEN volume_zscore > 4 THEN 'extreme' WHEN volume_zscore > 3 THEN 'strong' WHEN volume_zscore > 2 THEN 'moderate' END AS tier,
  volume_zscore > 5 AS sanity_alert FROM z WHERE volume_zscore > 3""")
def anomaly_filter(spark, sf):
    out = ops.anomaly_filter(_scores(spark, sf))
    return rounded(out, 6, "volume_zscore").select("stock", "date", "volume", "volume_zscore", "tier", "sanity_alert")


# Prices over a quantity and a split end in exact halves of the last digit, which
# engines round differently; cutting off-centre keeps the comparison exact.
@query("split_adjust", f"""{BARS}, {views.SPLITS}, j AS (SELECT b.stock, b.date, coalesce(exp(sum(ln(ratio))), 1) AS f, any_value(close) AS close
    FROM bars b LEFT JOIN splits s ON s.stock = b.stock AND s.date > b.date GROUP BY b.stock, b.date)
  SELECT stock, date, round(f, 6) AS split_factor, floor(close / f * 100000 + 0.3) / 100000 AS adjusted_close FROM j""")
def split_adjust(spark, sf):
    out = ops.split_adjust(views.bars_daily(spark, sf), views.splits(spark, sf))
    cut = (F.floor(F.col("adjusted_close") * 100000 + 0.3) / 100000).alias("adjusted_close")
    return out.select("stock", "date", F.round("split_factor", 6).alias("split_factor"), cut)


FIT = """f AS (SELECT l_returnflag AS grp, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
  regr_r2(l_extendedprice, l_quantity) AS r_squared, count(*) AS points FROM lineitem WHERE l_discount > 0 GROUP BY 1)"""


def _points(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"),
        (F.col("l_discount") > 0).alias("feasible"), "l_orderkey",
    )


@query("linear_fit", f"WITH {FIT} SELECT grp, round(slope, 4) AS slope, round(intercept, 3) AS intercept, round(r_squared, 6) AS r_squared, points FROM f")
def linear_fit(spark, sf):
    fit = ops.linear_fit(_points(spark, sf), "grp", "x", "y", "feasible")
    return rounded(rounded(rounded(fit, 4, "slope"), 3, "intercept"), 6, "r_squared")


@query("fit_residuals", f"""WITH {FIT} SELECT l_orderkey, l_returnflag AS grp, round(l_extendedprice - (slope * l_quantity + intercept), 3) AS residual
  FROM lineitem JOIN f ON grp = l_returnflag""")
def fit_residuals(spark, sf):
    points = _points(spark, sf)
    out = ops.fit_residuals(points, ops.linear_fit(points, "grp", "x", "y", "feasible"), "grp", "x", "y")
    return rounded(out, 3, "residual").select("l_orderkey", "grp", "residual")
