"""Queries of the work list, the registry and the ingest bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import ingest, registry
from barlake.plans import views
from barlake.plans.catalog import query
from barlake.plans.views import REGISTRY_AS_OF as AS_OF
from barlake.plans.views import table
from barlake.schemas import INTERVALS

REG = f"WITH {views.REGISTRY}"
MAN = f"WITH {views.TRADES}, {views.MANIFEST}, {views.DOWNLOAD_LOG}"
SINCE = f"date_diff('day', try_cast(last_not_found_date AS DATE), DATE '{AS_OF}')"


@query("files_for_date", f"{MAN} SELECT venue, file_name FROM manifest WHERE date = '2024-01-16'")
def files_for_date(spark, sf):
    return ingest.files_for_date(views.manifest(spark, sf), "2024-01-16")


@query("missing_files", f"""{MAN} SELECT venue, file_name FROM manifest m WHERE NOT EXISTS (
  SELECT 1 FROM log l WHERE l.venue = m.venue AND l.timestamp = m.minute) UNION ALL SELECT DISTINCT venue, venue || '-odd.txt' FROM manifest""")
def missing_files(spark, sf):
    # one listed name per venue that cannot be parsed: it is fetched until it is logged under itself
    odd = views.manifest(spark, sf).select("venue", F.concat("venue", F.lit("-odd.txt")).alias("file_name")).distinct()
    listed = views.manifest(spark, sf).unionByName(odd)
    return ingest.missing_files(listed, views.download_log(spark, sf))


@query("missing_dates", f"""{MAN} SELECT DISTINCT m.venue, m.date, CASE WHEN l.date IS NULL THEN 'missing' ELSE 'recheck' END AS status
  FROM manifest m LEFT JOIN (SELECT DISTINCT venue, date FROM log) l ON m.venue = l.venue AND m.date = l.date""")
def missing_dates(spark, sf):
    return ingest.missing_dates(views.manifest(spark, sf), views.download_log(spark, sf))


# A log that stops at noon leaves dates partial.
NOON_LOG = f"{MAN}, noon AS (SELECT * FROM log WHERE date[9:10] <> '05' OR timestamp[12:13] < '12')"


def _noon_log(spark, sf):
    return views.download_log(spark, sf).filter(
        (F.substring("date", 9, 2) != "05") | (F.substring("timestamp", 12, 2) < "12")
    )


COMPLETENESS = """SELECT m.venue, m.date, count(*) AS listed_files, count(l.timestamp) AS logged_files, bool_or(l.timestamp IS NOT NULL) AS has_data,
  CASE WHEN count(*) = count(l.timestamp) THEN 'complete' WHEN count(l.timestamp) > 0 THEN 'partial' ELSE 'missing' END AS status
  FROM manifest m LEFT JOIN noon l ON m.venue = l.venue AND m.minute = l.timestamp GROUP BY ALL"""


@query("download_completeness", f"{NOON_LOG} {COMPLETENESS}")
def download_completeness(spark, sf):
    return ingest.download_completeness(views.manifest(spark, sf), _noon_log(spark, sf))


@query("months_ready", f"{NOON_LOG} SELECT venue, date[1:7] AS month, count(*) AS dates_with_data FROM ({COMPLETENESS}) WHERE has_data GROUP BY ALL")
def months_ready(spark, sf):
    return ingest.months_ready(ingest.download_completeness(views.manifest(spark, sf), _noon_log(spark, sf)))


@query("ingest_run_summary", f"""{NOON_LOG}, b AS ({COMPLETENESS}),
  t AS (SELECT feed_venue AS venue, count(*) AS trades, count(DISTINCT isin) AS isins FROM trades GROUP BY 1)
  SELECT b.venue, count(*) AS dates_checked, count(*) FILTER (WHERE logged_files < listed_files) AS dates_fetched,
    0::BIGINT AS dates_partial, count(*) FILTER (WHERE logged_files = listed_files) AS dates_skipped,
    CAST(sum(listed_files - logged_files) AS BIGINT) AS files, any_value(trades) AS trades, any_value(isins) AS isins
  FROM b JOIN t ON b.venue = t.venue GROUP BY b.venue""")
def ingest_run_summary(spark, sf):
    before = ingest.download_completeness(views.manifest(spark, sf), _noon_log(spark, sf))
    run = before.withColumn("logged_before", F.col("logged_files")).withColumn("logged_files", F.col("listed_files"))
    return ingest.ingest_run_summary(run, views.trades(spark, sf))


@query("traded_isins", f"WITH {views.TRADES} SELECT DISTINCT feed_venue AS venue, isin FROM trades")
def traded_isins(spark, sf):
    return ingest.traded_isins(views.trades(spark, sf))


@query("log_rows", f"""{MAN} SELECT venue, date, minute AS timestamp, true AS has_data, count(*) AS trade_count
  FROM manifest m JOIN trades t ON m.venue = t.feed_venue AND m.minute = strftime(t.trade_time, '%Y-%m-%dT%H_%M') GROUP BY ALL
  UNION ALL SELECT 'quiet', '2024-01-01', '2024-01-01T00_00', false, 0""")
def log_rows(spark, sf):
    from barlake.functions.names import trade_filename

    counts = views.trades(spark, sf).groupBy(
        trade_filename("feed_venue", "trade_time").alias("file_name")
    ).agg(F.count(F.lit(1)).alias("trade_count"))
    quiet = spark.createDataFrame([("quiet", "quiet-posttrade-2024-01-01T00_00.json.gz")], "venue string, file_name string")
    listed = views.manifest(spark, sf).unionByName(quiet)
    return ingest.log_rows(listed, counts, "2024-02-01 00:00:00").drop("downloaded_at")


WANTED = [*views.STORED_INTERVALS, "1d"]
WANTED_SQL = f"(SELECT unnest({WANTED}) AS interval)"


@query("work_list", f"""{REG} SELECT t.ticker, w.interval, i.last_data_date FROM tickers t, {WANTED_SQL} w
  LEFT JOIN intervals i ON i.ticker = t.ticker AND i.interval = w.interval
  WHERE t.status = 'active' AND (i.status IS NULL OR i.status <> 'not_found' OR {SINCE} IS NULL OR {SINCE} >= 30)""")
def work_list(spark, sf):
    return registry.work_list(*views.registry(spark, sf), WANTED, AS_OF)


@query("fetch_plan", f"""{REG}, w AS (SELECT t.ticker, w.interval, try_cast(i.last_data_date AS TIMESTAMP) AS s FROM tickers t, {WANTED_SQL} w
  LEFT JOIN intervals i ON i.ticker = t.ticker AND i.interval = w.interval
  WHERE t.status = 'active' AND (i.status IS NULL OR i.status <> 'not_found' OR {SINCE} IS NULL OR {SINCE} >= 30))
  SELECT ticker, interval, s IS NULL AS full_history, CASE WHEN s IS NULL THEN 'max' END AS period, s AS start,
    CASE WHEN s IS NOT NULL THEN TIMESTAMP '2001-07-31 17:00:00' END AS "end",
    s IS NULL OR len([x for x in generate_series(s, TIMESTAMP '2001-07-31 17:00:00', INTERVAL 1 DAY) if isodow(x) < 6]) - CASE WHEN isodow(s) < 6 THEN 1 ELSE 0 END > 0 AS should_fetch
  FROM (SELECT ticker, interval, least(s, CASE WHEN s IS NULL THEN NULL ELSE TIMESTAMP '2001-07-31 17:00:00' END) AS s FROM w)""")
def fetch_plan(spark, sf):
    work = registry.work_list(*views.registry(spark, sf), WANTED, AS_OF)
    return registry.fetch_plan(work, "2001-07-31 17:00:00")


@query("is_eligible", f"""{REG} SELECT i.ticker, i.interval, CASE WHEN t.status = 'not_found' THEN false WHEN i.status <> 'not_found' THEN true
  ELSE coalesce({SINCE} >= 30, true) END AS eligible FROM intervals i JOIN tickers t ON i.ticker = t.ticker""")
def is_eligible(spark, sf):
    tickers, intervals = views.registry(spark, sf)
    joined = intervals.join(tickers.select("ticker", F.col("status").alias("ticker_status")), "ticker")
    verdict = registry.is_eligible(
        F.col("ticker_status"), F.lit(True), F.col("status"), F.col("last_not_found_date"), AS_OF
    )
    return joined.select("ticker", "interval", verdict.alias("eligible"))


@query("last_data_date", f"{REG} SELECT ticker, interval, try_cast(last_not_found_date AS DATE) AS day FROM intervals")
def last_data_date(spark, sf):
    _, intervals = views.registry(spark, sf)
    return intervals.select("ticker", "interval", registry.last_data_date("last_not_found_date").alias("day"))


@query("merge_symbol_list", f"""{REG}, fresh AS (SELECT DISTINCT CAST(o_custkey + 50 AS VARCHAR) AS ticker FROM orders WHERE o_orderpriority = '1-URGENT')
  SELECT coalesce(t.ticker, f.ticker) AS ticker, CASE WHEN t.ticker IS NULL THEN '{AS_OF}' ELSE added_date END AS added_date,
    CASE WHEN t.ticker IS NULL OR f.ticker IS NOT NULL THEN 'active' ELSE status END AS status, last_checked
  FROM tickers t FULL JOIN fresh f ON t.ticker = f.ticker""")
def merge_symbol_list(spark, sf):
    tickers, _ = views.registry(spark, sf)
    fresh = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        (F.col("o_custkey") + 50).cast("string").alias("ticker")
    ).distinct().select("ticker", F.lit(AS_OF).alias("added_date"), F.lit("active").alias("status"), F.lit(None).cast("string").alias("last_checked"))
    return registry.merge_symbol_list(tickers, fresh)


# One outcome per customer and status: an open order means data was found.
OUTCOMES = """outcomes AS (SELECT CAST(o_custkey + 50 AS VARCHAR) AS ticker, CASE o_orderpriority WHEN '1-URGENT' THEN '1-URGENT' ELSE '5-LOW' END AS interval,
  bool_or(o_orderstatus = 'O') AS found, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY ALL)"""


def _outcomes(spark, sf):
    interval = F.when(F.col("o_orderpriority") == "1-URGENT", "1-URGENT").otherwise("5-LOW")
    return table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).groupBy(
        (F.col("o_custkey") + 50).cast("string").alias("ticker"), interval.alias("interval")
    ).agg(
        F.bool_or(F.col("o_orderstatus") == "O").alias("found"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_date"),
    ).withColumn("storage", F.lit(None).cast(INTERVALS["storage"].dataType))


@query("apply_fetch_outcomes_intervals", f"""{REG}, {OUTCOMES}
  SELECT coalesce(i.ticker, o.ticker) AS ticker, coalesce(i.interval, o.interval) AS interval,
    CASE WHEN found THEN 'active' WHEN NOT found THEN 'not_found' ELSE status END AS status,
    CASE WHEN found THEN '{AS_OF}' ELSE last_found_date END AS last_found_date,
    CASE WHEN found THEN last_date ELSE last_data_date END AS last_data_date,
    CASE WHEN NOT found THEN '{AS_OF}' ELSE last_not_found_date END AS last_not_found_date,
    CASE WHEN found IS NOT NULL THEN '{AS_OF}' ELSE last_checked END AS last_checked
  FROM intervals i FULL JOIN outcomes o ON i.ticker = o.ticker AND i.interval = o.interval""")
def apply_fetch_outcomes_intervals(spark, sf):
    _, intervals = registry.apply_fetch_outcomes(*views.registry(spark, sf), _outcomes(spark, sf), AS_OF)
    return intervals.drop("storage")


@query("apply_fetch_outcomes", f"""{REG}, {OUTCOMES}, j AS (
    SELECT coalesce(i.ticker, o.ticker) AS ticker, found, CASE WHEN found THEN 'active' WHEN NOT found THEN 'not_found' ELSE status END AS status
    FROM intervals i FULL JOIN outcomes o ON i.ticker = o.ticker AND i.interval = o.interval),
  v AS (SELECT ticker, bool_or(found) AS any_found, bool_and(status = 'not_found') AS all_lost FROM j GROUP BY 1 HAVING count(found) > 0)
  SELECT coalesce(t.ticker, v.ticker) AS ticker, coalesce(added_date, '{AS_OF}') AS added_date,
    CASE WHEN any_found THEN 'active' WHEN all_lost THEN 'not_found' ELSE coalesce(status, 'active') END AS status,
    CASE WHEN v.ticker IS NOT NULL THEN '{AS_OF}' ELSE last_checked END AS last_checked
  FROM tickers t FULL JOIN v ON t.ticker = v.ticker""")
def apply_fetch_outcomes(spark, sf):
    tickers, _ = registry.apply_fetch_outcomes(*views.registry(spark, sf), _outcomes(spark, sf), AS_OF)
    return tickers


RECENT = f"""(SELECT DISTINCT ticker FROM intervals WHERE status = 'active' AND date_diff('day', try_cast(last_found_date AS DATE), DATE '{AS_OF}') <= 90)"""


@query("reactivate", f"""{REG} SELECT ticker, added_date, CASE WHEN status = 'not_found' AND ticker IN {RECENT} THEN 'active' ELSE status END AS status,
  CASE WHEN status = 'not_found' AND ticker IN {RECENT} THEN '{AS_OF}' ELSE last_checked END AS last_checked FROM tickers""")
def reactivate(spark, sf):
    return registry.reactivate(*views.registry(spark, sf), AS_OF)


PROBES = """probes AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal > 5000 AS found FROM customer WHERE c_nationkey < 20)"""


@query("recheck_not_found", f"""{REG}, {PROBES} SELECT t.ticker, added_date,
  CASE WHEN status = 'not_found' AND (coalesce(found, false) OR t.ticker IN {RECENT}) THEN 'active' ELSE status END AS status,
  CASE WHEN status = 'not_found' AND (found IS NOT NULL OR t.ticker IN {RECENT}) THEN '{AS_OF}' ELSE last_checked END AS last_checked
  FROM tickers t LEFT JOIN probes p ON t.ticker = p.ticker""")
def recheck_not_found(spark, sf):
    probes = table(spark, sf, "customer").filter(F.col("c_nationkey") < 20).select(
        F.col("c_custkey").cast("string").alias("ticker"), (F.col("c_acctbal") > 5000).alias("found"),
        F.lit("2001-08-14").alias("last_date"),
    )
    return registry.recheck_not_found(*views.registry(spark, sf), probes, AS_OF)[0]


@query("global_not_found", f"{REG} SELECT ticker, bool_and(status = 'not_found') AS not_found FROM intervals GROUP BY 1")
def global_not_found(spark, sf):
    return registry.global_not_found(views.registry(spark, sf)[1])


@query("registry_counts", f"""{REG} SELECT count(*) AS tickers, count(*) FILTER (WHERE status = 'active') AS active,
  count(*) FILTER (WHERE status = 'not_found') AS not_found,
  count(*) FILTER (WHERE ticker IN (SELECT ticker FROM intervals WHERE interval = '1-URGENT' AND status = 'active')) AS active_1d FROM tickers""")
def registry_counts(spark, sf):
    tickers, intervals = views.registry(spark, sf)
    daily = intervals.withColumn("interval", F.when(F.col("interval") == "1-URGENT", "1d").otherwise(F.col("interval")))
    return registry.registry_counts(tickers, daily)


@query("registry_repair", f"""{REG} SELECT t.ticker, '1d' AS interval, CASE WHEN t.status = 'not_found' THEN 'not_found' ELSE 'active' END AS status,
  CASE WHEN t.status = 'not_found' THEN NULL ELSE '{AS_OF}' END AS last_found_date,
  CASE WHEN t.status = 'not_found' THEN NULL ELSE added_date END AS last_data_date,
  CASE WHEN t.status = 'not_found' THEN coalesce(last_checked, added_date) END AS last_not_found_date,
  CASE WHEN t.status = 'not_found' THEN coalesce(last_checked, added_date) ELSE '{AS_OF}' END AS last_checked
  FROM tickers t WHERE ticker NOT IN (SELECT ticker FROM intervals WHERE interval = '1-URGENT')""")
def registry_repair(spark, sf):
    tickers, intervals = views.registry(spark, sf)
    known = intervals.withColumn("interval", F.when(F.col("interval") == "1-URGENT", "1d").otherwise(F.col("interval")))
    _, repaired = registry.registry_repair(tickers, known, AS_OF)
    added = repaired.join(known.select("ticker", "interval"), ["ticker", "interval"], "left_anti")
    return added.drop("storage")


@query("registry_unify", f"""WITH cur AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_acctbal > 0),
  nf AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, CASE WHEN c_nationkey < 12 THEN '2000-01-03' END AS found FROM customer WHERE c_mktsegment = 'MACHINERY'),
  u AS (SELECT ticker, 'active' AS status, '{AS_OF}' AS found, true AS is_cur FROM cur WHERE ticker NOT IN (SELECT ticker FROM nf)
        UNION ALL SELECT ticker, 'not_found', found, false FROM nf)
  SELECT ticker, status AS ticker_status, CASE WHEN found IS NULL THEN 'not_found' ELSE 'active' END AS status, found AS last_found_date,
    CASE WHEN is_cur THEN '1994-12-31' ELSE found END AS last_data_date, CASE WHEN found IS NULL THEN '2001-08-01' END AS last_not_found_date,
    CASE WHEN is_cur THEN '{AS_OF}' ELSE '2001-08-01' END AS last_checked FROM u""")
def registry_unify(spark, sf):
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"), F.lit("1994-12-31").alias("added_date"),
        F.lit("2001-08-01").alias("last_checked"), "c_acctbal", "c_mktsegment", "c_nationkey",
    )
    lost = base.filter(F.col("c_mktsegment") == "MACHINERY").withColumn(
        "last_date_found", F.when(F.col("c_nationkey") < 12, "2000-01-03")
    )
    tickers, daily = registry.registry_unify(base.filter(F.col("c_acctbal") > 0), lost, AS_OF)
    return daily.drop("interval", "storage").join(tickers.select("ticker", F.col("status").alias("ticker_status")), "ticker")


@query("latest_by_added_date", """SELECT CAST(o_custkey AS VARCHAR) AS ticker, strftime(min(o_orderdate), '%Y-%m-%d') AS added_date FROM orders GROUP BY 1""")
def latest_by_added_date(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("added_date"), "o_orderkey"
    )
    return registry.latest_by_added_date(rows).select("ticker", "added_date")


@query("validate_registry", f"""{REG} SELECT ticker, NULL AS interval, 'missing_last_checked' AS rule FROM tickers WHERE last_checked IS NULL
  UNION ALL SELECT ticker, interval, 'missing_last_not_found_date' FROM intervals WHERE status = 'not_found' AND last_not_found_date IS NULL
  UNION ALL SELECT ticker, interval, 'missing_last_found_date' FROM intervals WHERE status = 'active' AND last_found_date IS NULL""")
def validate_registry(spark, sf):
    return registry.validate_registry(*views.registry(spark, sf))


@query("registry_map_view", f"""{REG}, n AS (SELECT ticker, count(*) AS n, string_agg(interval, ',' ORDER BY interval) AS names FROM intervals GROUP BY 1)
  SELECT t.ticker, t.status, n.names AS intervals FROM tickers t LEFT JOIN n ON t.ticker = n.ticker""")
def registry_map_view(spark, sf):
    nested = registry.registry_map_view(*views.registry(spark, sf))
    return nested.select("ticker", "status", F.array_join(F.map_keys("intervals"), ",").alias("intervals"))


@query("resolve_layout", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN true WHEN c_nationkey < 5 THEN true WHEN c_mktsegment = 'BUILDING' THEN false ELSE true END AS partitioned FROM customer""")
def resolve_layout(spark, sf):
    requests = table(spark, sf, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("market"), F.when(F.col("c_nationkey") < 5, "a").otherwise("b").alias("source"),
        F.when(F.col("c_acctbal") < 0, "partitioned").alias("storage_mode"),
    )
    segments = requests.select("market").distinct()
    by_source = segments.select("market", F.lit("a").alias("source"), F.lit(True).alias("enabled"))
    by_market = segments.filter(F.col("market") == "building").select("market", F.lit(None).cast("string").alias("source"), F.lit(False).alias("enabled"))
    return registry.resolve_layout(requests, by_source.unionByName(by_market), True).select("c_custkey", "partitioned")


@query("backfill_storage_metadata", f"""{REG}, d AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, '1-URGENT' AS interval FROM customer WHERE c_acctbal > 0)
  SELECT coalesce(i.ticker, d.ticker) AS ticker, coalesce(i.interval, d.interval) AS interval,
    CASE WHEN d.ticker IS NOT NULL THEN 'partitioned' END AS mode, d.ticker IS NOT NULL AS changed
  FROM intervals i FULL JOIN d ON i.ticker = d.ticker AND i.interval = d.interval""")
def backfill_storage_metadata(spark, sf):
    tickers, intervals = views.registry(spark, sf)
    found = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("ticker"), F.lit("1-URGENT").alias("interval")
    )
    storage = F.struct(*[F.lit(v).alias(n) for n, v in dict(
        mode="partitioned", market="us", source="yahoo", dataset="stocks", root="data", venue="us:yahoo", verified_at=AS_OF).items()])
    out = registry.backfill_storage_metadata(intervals, tickers, found, storage)
    return out.select("ticker", "interval", "storage.mode", "changed")
