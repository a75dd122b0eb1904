"""Queries of bar building, roll-up, calendars and session checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions import calendar
from barlake.operators import bars as ops
from barlake.plans import views
from barlake.plans.catalog import query, rounded
from barlake.plans.views import table

TRADES = f"WITH {views.TRADES}"
BAR_SQL = """round(first(price ORDER BY trade_time, tick_id), 6) AS open, round(max(price), 6) AS high, round(min(price), 6) AS low,
  round(last(price ORDER BY trade_time, tick_id), 6) AS close, sum(volume) AS volume, count(*) AS trade_count,
  round(sum(price * volume) / sum(volume), 6) AS vwap"""
PRICES = ["open", "high", "low", "close", "vwap"]


def _bars_oracle(bucket: str) -> str:
    return f"""{TRADES} SELECT isin, {bucket} AS bar, {BAR_SQL} FROM trades GROUP BY ALL HAVING sum(volume) > 0"""


@query("ohlcv_1m", _bars_oracle("date_trunc('minute', trade_time)"))
def ohlcv_1m(spark, sf):
    return rounded(ops.ohlcv_from_trades(views.trades(spark, sf), "1m"), 6, *PRICES)


@query("ohlcv_1h", _bars_oracle("date_trunc('hour', trade_time)"))
def ohlcv_1h(spark, sf):
    return rounded(ops.ohlcv_from_trades(views.trades(spark, sf), "1h"), 6, *PRICES)


BERLIN_DAY = "CAST(CAST((trade_time AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS DATE) AS TIMESTAMP)"


@query("ohlcv_1d_berlin", _bars_oracle(BERLIN_DAY))
def ohlcv_1d_berlin(spark, sf):
    return rounded(ops.local_day_bars(views.trades(spark, sf), "Europe/Berlin"), 6, *PRICES)


@query("ohlcv_rollup_1d_from_1h", f"""{TRADES} SELECT isin, CAST(CAST(trade_time AS DATE) AS TIMESTAMP) AS bar, {BAR_SQL}
  FROM (SELECT *, sum(volume) OVER (PARTITION BY isin, date_trunc('hour', trade_time)) AS hour_volume FROM trades)
  WHERE hour_volume > 0 GROUP BY ALL""")
def ohlcv_rollup_1d_from_1h(spark, sf):
    hours = ops.ohlcv_from_trades(views.trades(spark, sf), "1h")
    return rounded(ops.ohlcv_rollup(hours, "1d"), 6, *PRICES)


@query("ohlcv_rollup_berlin_days", _bars_oracle(BERLIN_DAY).replace(
    "FROM trades", "FROM (SELECT *, sum(volume) OVER (PARTITION BY isin, date_trunc('minute', trade_time)) AS v FROM trades) WHERE v > 0"))
def ohlcv_rollup_berlin_days(spark, sf):
    minutes = ops.ohlcv_from_trades(views.trades(spark, sf), "1m")
    return rounded(ops.ohlcv_rollup(minutes, "1d", market_zone="Europe/Berlin"), 6, *PRICES)


@query("drop_zero_volume_bars", f"""{TRADES} SELECT isin, trade_time AS bar, volume FROM trades WHERE volume > 0""")
def drop_zero_volume_bars(spark, sf):
    return ops.drop_zero_volume_bars(views.trades(spark, sf)).select("isin", F.col("trade_time").alias("bar"), "volume")


@query("volume_conservation", f"""{TRADES}, l AS (SELECT isin, CAST(trade_time AS DATE) AS day, sum(volume) AS trade_volume FROM trades GROUP BY ALL)
  SELECT isin, day, trade_volume, trade_volume AS bar_volume, true AS conserved FROM l""")
def volume_conservation(spark, sf):
    trades = views.trades(spark, sf)
    return ops.volume_conservation(trades, ops.ohlcv_from_trades(trades, "1h"))


@query("ohlc_consistency", f"""WITH {views.BARS_DAILY}, b AS (SELECT *, CASE WHEN volume > 90 THEN close / 2 ELSE high END AS h FROM bars)
  SELECT stock, date, 'high' AS rule FROM b WHERE h < greatest(open, close, low)
  UNION ALL SELECT stock, date, 'low' FROM b WHERE low > least(open, close, h)""")
def ohlc_consistency(spark, sf):
    b = views.bars_daily(spark, sf)
    broken = b.withColumn("high", F.when(F.col("volume") > 90, F.col("close") / 2).otherwise(F.col("high")))
    return ops.ohlc_violations(broken).select("stock", "date", "rule")


# Minute bars rolled up against hours from trades, of which a part is altered. A trade without volume shows in an hour's
# prices, yet its minute has no bar: such hours come out as different, too.
ROLLED = f"""{TRADES}, m AS (
    SELECT isin, date_trunc('minute', trade_time) AS minute, first(price ORDER BY trade_time, tick_id) AS open, max(price) AS high,
           min(price) AS low, last(price ORDER BY trade_time, tick_id) AS close, sum(volume) AS volume, count(*) AS trade_count
    FROM trades GROUP BY ALL HAVING sum(volume) > 0),
  r AS (SELECT isin, date_trunc('hour', minute) AS bar, round(first(open ORDER BY minute), 6) AS open, round(max(high), 6) AS high,
               round(min(low), 6) AS low, round(last(close ORDER BY minute), 6) AS close, sum(volume) AS volume,
               sum(trade_count) AS trade_count FROM m GROUP BY ALL),
  h AS (SELECT isin, date_trunc('hour', trade_time) AS bar, {BAR_SQL} FROM trades GROUP BY ALL HAVING sum(volume) > 0)"""
COMPARED = f"""SELECT isin, bar, CASE WHEN h.volume IS NULL THEN 'missing_stored' WHEN r.volume IS NULL THEN 'missing_rolled' ELSE 'different' END AS status
  FROM r FULL JOIN h USING (isin, bar)
  WHERE {" OR ".join(f"r.{c} IS DISTINCT FROM h.{c}" for c in ops.BAR_VALUES)}"""


@query("interval_consistency", f"""{ROLLED}, s AS (SELECT * REPLACE (CASE WHEN volume > 120 THEN high + 1 ELSE high END AS high) FROM h WHERE volume <= 150)
  {COMPARED.replace("h.", "s.").replace("JOIN h ", "JOIN s ")}""")
def interval_consistency(spark, sf):
    trades = views.trades(spark, sf)
    rolled = ops.ohlcv_rollup(ops.ohlcv_from_trades(trades, "1m"), "1h")
    hours = ops.ohlcv_from_trades(trades, "1h").filter(F.col("volume") <= 150)
    stored = hours.withColumn("high", F.when(F.col("volume") > 120, F.col("high") + 1).otherwise(F.col("high")))
    return ops.interval_mismatches(rolled, stored).select("isin", "bar", "status")


@query("interval_consistency_all_trades", f"""{ROLLED}
  {COMPARED}""")
def interval_consistency_all_trades(spark, sf):
    # nothing is filtered or altered: a trade without volume shows in an hour's prices, yet its minute has no bar
    trades = views.trades(spark, sf)
    rolled = ops.ohlcv_rollup(ops.ohlcv_from_trades(trades, "1m"), "1h")
    return ops.interval_mismatches(rolled, ops.ohlcv_from_trades(trades, "1h")).select("isin", "bar", "status")


@query("interval_volumes_agree", f"""{TRADES} SELECT isin, CAST(trade_time AS DATE) AS day, sum(volume) AS volume, true AS agree FROM trades GROUP BY ALL""")
def interval_volumes_agree(spark, sf):
    trades = views.trades(spark, sf)
    parts = None
    for interval in ("1m", "1h", "1d"):
        part = ops.ohlcv_from_trades(trades, interval).select("isin", F.to_date("bar").alias("day"), F.lit(interval).alias("i"), "volume")
        parts = part if parts is None else parts.unionByName(part)
    # a day without volume has no bar, yet still is a traded day
    days = trades.select("isin", F.to_date("trade_time").alias("day"), F.lit("1d").alias("i"), F.lit(0.0).alias("volume"))
    total = {i: F.sum(F.when(F.col("i") == i, F.col("volume")).otherwise(0.0)) for i in ("1m", "1h", "1d")}
    return parts.unionByName(days).groupBy("isin", "day").agg(
        total["1d"].alias("volume"), ((total["1m"] == total["1h"]) & (total["1h"] == total["1d"])).alias("agree")
    )


@query("cross_venue_compare", f"""{TRADES}, h AS (SELECT feed_venue, isin, date_trunc('hour', trade_time) AS bar, last(price ORDER BY trade_time, tick_id) AS close
  FROM trades GROUP BY ALL HAVING sum(volume) > 0)
  SELECT a.isin, a.bar, a.close AS close_a, b.close AS close_b, round(a.close - b.close, 6) AS price_diff,
         round(abs(a.close - b.close) / ((a.close + b.close) / 2) * 10000, 4) AS spread_bps
  FROM h a JOIN h b ON a.isin = b.isin AND a.bar = b.bar AND a.feed_venue = 'click' AND b.feed_venue = 'view'""")
def cross_venue_compare(spark, sf):
    hours = ops.ohlcv_from_trades(views.trades(spark, sf), "1h", ["feed_venue", "isin"])
    return rounded(rounded(ops.cross_venue_compare(hours, "click", "view"), 6, "price_diff"), 4, "spread_bps")


@query("cross_source_union", f"""WITH {views.BARS_DAILY}, {views.TRADES}
  SELECT isin AS instrument, date_trunc('hour', trade_time) AS bar, sum(volume) AS volume, 'de' AS market, 'xetra' AS source, count(*) AS trade_count
  FROM trades GROUP BY ALL HAVING sum(volume) > 0
  UNION ALL SELECT stock, date, CAST(volume AS DOUBLE), 'us', 'yahoo', NULL FROM bars""")
def cross_source_union(spark, sf):
    both = ops.cross_source_union(
        ops.ohlcv_from_trades(views.trades(spark, sf), "1h"), views.bars_daily(spark, sf)
    )
    return both.select("instrument", "bar", "volume", "market", "source", "trade_count")


def _sessions(spark, sf):
    """Each venue-day that traded, open from 08:00 to 10:00."""
    days = views.trades(spark, sf).select("feed_venue", F.to_date("trade_time").alias("day")).distinct()
    start = F.col("day").cast("timestamp_ntz")
    return days.withColumns({
        "open": F.timestamp_add("HOUR", F.lit(8), start), "close": F.timestamp_add("HOUR", F.lit(10), start)
    })


@query("missing_minutes", f"""{TRADES}, s AS (SELECT DISTINCT feed_venue, CAST(trade_time AS DATE) AS day FROM trades),
  e AS (SELECT feed_venue, day, unnest(generate_series(day + INTERVAL 8 HOUR, day + INTERVAL 599 MINUTE, INTERVAL 1 MINUTE)) AS minute FROM s)
  SELECT feed_venue, day, minute FROM e WHERE NOT EXISTS (
    SELECT 1 FROM trades t WHERE t.feed_venue = e.feed_venue AND date_trunc('minute', t.trade_time) = e.minute)""")
def missing_minutes(spark, sf):
    return ops.missing_minutes(_sessions(spark, sf), views.trades(spark, sf)).select("feed_venue", "day", "minute")


@query("session_gaps", f"""{TRADES}, g AS (SELECT feed_venue, CAST(trade_time AS DATE) AS day, trade_time AS gap_end,
    lag(trade_time) OVER (PARTITION BY feed_venue, CAST(trade_time AS DATE) ORDER BY trade_time) AS gap_start FROM trades)
  SELECT feed_venue, day, gap_start, gap_end, round(date_diff('microsecond', gap_start, gap_end) / 1000000, 6) AS gap_seconds
  FROM g WHERE date_diff('microsecond', gap_start, gap_end) > 3600000000""")
def session_gaps(spark, sf):
    return rounded(ops.session_gaps(views.trades(spark, sf), 60), 6, "gap_seconds")


BERLIN = "(trade_time AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin'"


@query("session_filter", f"""{TRADES}, v AS (SELECT *, CASE feed_venue WHEN 'click' THEN 'DETR' WHEN 'view' THEN 'DFRA' ELSE feed_venue END AS code FROM trades)
  SELECT code, tick_id FROM v WHERE code NOT IN ('DETR', 'DFRA') OR strftime({BERLIN}, '%H:%M') BETWEEN '07:30' AND '18:30'""")
def session_filter(spark, sf):
    code = F.when(F.col("feed_venue") == "click", "DETR").when(F.col("feed_venue") == "view", "DFRA").otherwise(F.col("feed_venue"))
    trades = views.trades(spark, sf).withColumn("code", code)
    return trades.filter(calendar.in_venue_minutes("trade_time", "code")).select("code", "tick_id")


@query("is_within_hours", f"""{TRADES}, l AS (SELECT tick_id, CAST({BERLIN} AS TIME) AS t FROM trades)
  SELECT tick_id, t BETWEEN TIME '09:00:00' AND TIME '17:30:00' AS day_session,
         t >= TIME '22:00:00' OR t <= TIME '02:00:00' AS night_session FROM l""")
def is_within_hours(spark, sf):
    return views.trades(spark, sf).select(
        "tick_id", calendar.is_within_hours("trade_time", "09:00", "17:30", "Europe/Berlin").alias("day_session"),
        calendar.is_within_hours("trade_time", "22:00", "02:00", "Europe/Berlin").alias("night_session"),
    )


# January: Berlin is one hour ahead of UTC on every day of the table.
@query("session_position", f"""{TRADES}, l AS (SELECT tick_id, trade_time, CAST(trade_time + INTERVAL 1 HOUR AS DATE) AS d FROM trades),
  w AS (SELECT *, d + INTERVAL 8 HOUR AS o, d + INTERVAL '16 hours 30 minutes' AS c FROM l)
  SELECT tick_id, trade_time BETWEEN o AND c AS is_open,
    round(CASE WHEN trade_time BETWEEN o AND c THEN 0 WHEN trade_time < o THEN date_diff('microsecond', trade_time, o) / 1000000
      ELSE date_diff('microsecond', trade_time, o + INTERVAL 1 DAY) / 1000000 END, 6) AS seconds_until_open,
    CASE WHEN trade_time BETWEEN o AND c THEN trade_time WHEN trade_time < o THEN o ELSE o + INTERVAL 1 DAY END AS next_open,
    round(CASE WHEN trade_time > c THEN 0 ELSE date_diff('microsecond', trade_time, c) / 1000000 END, 6) AS seconds_until_close FROM w""")
def session_position(spark, sf):
    at = calendar.session_position("trade_time", "09:00", "17:30", "Europe/Berlin")
    out = views.trades(spark, sf).select("tick_id", at.alias("p")).select("tick_id", "p.*")
    return rounded(out, 6, "seconds_until_open", "seconds_until_close")


@query("parse_active_hours", """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN printf('%02d:15', c_nationkey % 24) END AS open,
  CASE WHEN c_acctbal >= 0 THEN '17:30' END AS close FROM customer""")
def parse_active_hours(spark, sf):
    text = F.when(F.col("c_acctbal") >= 0, F.concat((F.col("c_nationkey") % 24).cast("string"), F.lit(":15 - 17:30"))).otherwise("closed")
    return table(spark, sf, "customer").select("c_custkey", calendar.parse_active_hours(text).alias("h")).select("c_custkey", "h.open", "h.close")


# Request rows: start at the order date, end a number of days later.
REQUESTS = """r AS (SELECT o_orderkey, o_orderdate AS s, o_orderdate + INTERVAL 1 DAY * CAST(o_orderkey % 40 AS INTEGER) AS e,
  CASE o_orderpriority WHEN '1-URGENT' THEN '1m' WHEN '2-HIGH' THEN '60m' WHEN '3-MEDIUM' THEN '5m' WHEN '5-LOW' THEN '1h' ELSE '1d' END AS interval,
  TIMESTAMP '2001-08-03 17:00:00' AS today FROM orders)"""


def _requests(spark, sf):
    kinds = {"1-URGENT": "1m", "2-HIGH": "60m", "3-MEDIUM": "5m", "5-LOW": "1h"}
    interval = F.lit("1d")
    for priority, kind in kinds.items():
        interval = F.when(F.col("o_orderpriority") == priority, kind).otherwise(interval)
    end = F.timestamp_add("DAY", (F.col("o_orderkey") % 40).cast("int"), F.col("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("s"), end.alias("e"), interval.alias("interval"))


@query("business_days_between", f"""WITH {REQUESTS}
  SELECT o_orderkey, CAST(len([x for x in generate_series(s, e, INTERVAL 1 DAY) if isodow(x) < 6]) - CASE WHEN isodow(s) < 6 THEN 1 ELSE 0 END AS INTEGER) AS days FROM r""")
def business_days_between(spark, sf):
    return _requests(spark, sf).select("o_orderkey", calendar.business_days_between("s", "e").alias("days"))


@query("reference_day", """SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(greatest(isodow(o_orderdate) - 5, 0) AS INTEGER) + INTERVAL 17 HOUR AS day FROM orders""")
def reference_day(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", calendar.reference_day("o_orderdate").alias("day"))


@query("clamp_fetch_window", f"""WITH {REQUESTS}, h AS (SELECT *, interval IN ('60m', '1h') AS hourly, interval IN ('1m', '5m') AS minutely,
    date_diff('second', s, today) // 86400 AS back_s, date_diff('second', e, today) // 86400 AS back_e FROM r),
  c AS (SELECT *, CASE WHEN hourly AND back_s >= 729 THEN TIMESTAMP '1999-08-05 08:00:00' WHEN minutely AND back_s >= 7 THEN TIMESTAMP '2001-07-27 00:00:00' ELSE s END AS cs,
    CASE WHEN (hourly AND back_e >= 729) OR (minutely AND back_e >= 7) THEN today ELSE e END AS ce FROM h)
  SELECT o_orderkey, CASE WHEN hourly AND date_diff('second', cs, ce) >= 729 * 86400 THEN ce ELSE cs END AS start, ce AS "end" FROM c""")
def clamp_fetch_window(spark, sf):
    today = F.lit("2001-08-03 17:00:00").cast("timestamp_ntz")
    w = calendar.clamp_fetch_window(F.col("s"), F.col("e"), F.col("interval"), today)
    return _requests(spark, sf).select("o_orderkey", w.alias("w")).select("o_orderkey", "w.start", "w.end")


@query("full_history_period", f"""WITH {REQUESTS} SELECT o_orderkey, CASE WHEN interval IN ('60m', '1h') THEN '730d' WHEN interval IN ('1m', '5m') THEN '7d' ELSE 'max' END AS period FROM r""")
def full_history_period(spark, sf):
    return _requests(spark, sf).select("o_orderkey", calendar.full_history_period(F.col("interval")).alias("period"))
