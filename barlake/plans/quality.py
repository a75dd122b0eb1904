"""Queries of copy verification, file audit and migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import audit, lake, ledger
from barlake.operators import bars as bar_ops
from barlake.operators import coverage as coverage_ops
from barlake.plans import views
from barlake.plans.catalog import CATALOG, query
from barlake.schemas import BARS
from barlake.session import scratch_dir
from barlake.sources.bars import scan_partitions

BARS_SQL = f"WITH {views.BARS_DAILY}"
# The copy differs by what the rows say: dropped, altered, redated and whole tickers lost.
PERTURBED = f"""{BARS_SQL}, copy AS (SELECT stock, CASE WHEN stock LIKE '%3' AND date = min(date) OVER (PARTITION BY stock) THEN date - INTERVAL 1 DAY ELSE date END AS date,
    open, high, low, CASE WHEN stock LIKE '%7' AND volume > 45 THEN close + 1 ELSE close END AS close, volume, sequence
  FROM bars WHERE NOT (stock LIKE '%11' OR (stock LIKE '%5' AND volume = 50)))"""


def _copy(spark, sf):
    return _perturbed(views.bars_daily(spark, sf))


def _perturbed(bars):
    from pyspark.sql import Window

    # only the tickers that lose their first date are grouped; all others pass as they are
    redated = F.col("stock").endswith("3")
    first = F.min("date").over(Window.partitionBy("stock"))
    shifted = F.when(F.col("date") == first, F.timestamp_add("DAY", F.lit(-1), F.col("date"))).otherwise(F.col("date"))
    moved = bars.filter(~redated).unionByName(bars.filter(redated).withColumn("date", shifted)).withColumn(
        "close", F.when(F.col("stock").endswith("7") & (F.col("volume") > 45), F.col("close") + 1).otherwise(F.col("close"))
    )
    lost = F.col("stock").endswith("11") | (F.col("stock").endswith("5") & (F.col("volume") == 50))
    return moved.filter(~lost)


COUNTS = """c AS (SELECT coalesce(a.stock, b.stock) AS stock, coalesce(a.n, 0) AS o, coalesce(b.n, 0) AS m,
    a.lo IS NOT DISTINCT FROM b.lo AND a.hi IS NOT DISTINCT FROM b.hi AS same_range FROM
  (SELECT stock, count(*) AS n, min(date) AS lo, max(date) AS hi FROM bars GROUP BY 1) a
  FULL JOIN (SELECT stock, count(*) AS n, min(date) AS lo, max(date) AS hi FROM copy GROUP BY 1) b ON a.stock = b.stock),
  d AS (SELECT DISTINCT stock FROM (SELECT stock, date, close FROM bars EXCEPT ALL SELECT stock, date, close FROM copy))"""


@query("verify_copies", f"""{PERTURBED}, {COUNTS} SELECT c.stock, o AS flat_rows, m AS stored_rows,
  CASE WHEN o <> m THEN 'row_count_mismatch' WHEN d.stock IS NOT NULL THEN 'checksum_mismatch' ELSE 'ok' END AS verdict
  FROM c LEFT JOIN d ON c.stock = d.stock""")
def verify_copies(spark, sf):
    return audit.verify_copies(views.bars_daily(spark, sf), _copy(spark, sf))


def _ledgers(spark, sf):
    """Ledgers of both copies, refreshed before and after one year of the stored copy arrives."""
    flat, stored, known = (scratch_dir(spark, n) for n in ("flat", "stored", "ledgers"))
    views.bars_daily(spark, sf).select(*BARS.names).write.option("compression", "zstd").parquet(flat)
    # the bars are made once, and the copy is taken from where they are stored
    copy = _perturbed(spark.read.schema(BARS).parquet(flat))
    late = F.year("date") == 1995
    lake.write_bars_monthly(copy.filter(~late), stored)
    ledger.refresh_ledger(spark, stored, f"{known}/stored")
    lake.write_bars_monthly(copy.filter(late), stored)
    return (ledger.refresh_ledger(spark, folder, f"{known}/{side}") for folder, side in ((flat, "flat"), (stored, "stored")))


@query("verify_ledgers", CATALOG["verify_copies"].oracle)
def verify_ledgers(spark, sf):
    return ledger.verify_ledgers(*_ledgers(spark, sf))


@query("differing_months", f"""{PERTURBED}, a AS (SELECT stock, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n FROM bars GROUP BY 1, 2),
  b AS (SELECT stock, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n FROM copy GROUP BY 1, 2),
  d AS (SELECT DISTINCT stock, CAST(date_trunc('month', date) AS DATE) AS month FROM (SELECT stock, date, close FROM bars EXCEPT ALL SELECT stock, date, close FROM copy))
  SELECT stock, month, coalesce(a.n, 0) AS flat_rows, coalesce(b.n, 0) AS stored_rows,
         CASE WHEN a.n IS DISTINCT FROM b.n THEN 'row_count_mismatch' ELSE 'checksum_mismatch' END AS verdict
  FROM a FULL JOIN b USING (stock, month) WHERE a.n IS DISTINCT FROM b.n OR (stock, month) IN (SELECT (stock, month) FROM d)""")
def differing_months(spark, sf):
    return ledger.differing_months(*_ledgers(spark, sf))


@query("rowwise_compare", f"""{PERTURBED}, {COUNTS} SELECT c.stock, CAST(o AS BIGINT) AS original_rows, CAST(m AS BIGINT) AS migrated_rows,
  CASE WHEN m = 0 THEN 'no_migrated_rows' WHEN o = 0 THEN 'no_original_rows' WHEN o <> m THEN 'row_count_mismatch'
       WHEN NOT same_range THEN 'date_range_mismatch' WHEN d.stock IS NOT NULL THEN 'content_mismatch' ELSE 'ok' END AS verdict
  FROM c LEFT JOIN d ON c.stock = d.stock""")
def rowwise_compare(spark, sf):
    return audit.rowwise_compare(views.bars_daily(spark, sf), _copy(spark, sf))


@query("multiset_difference", f"""{PERTURBED}, a AS (SELECT stock, volume, count(*) AS n FROM bars GROUP BY ALL), b AS (SELECT stock, volume, count(*) AS n FROM copy GROUP BY ALL)
  SELECT a.stock, a.volume, CAST(a.n AS BIGINT) AS left_copies, CAST(coalesce(b.n, 0) AS BIGINT) AS right_copies FROM a LEFT JOIN b ON a.stock = b.stock AND a.volume = b.volume WHERE a.n <> coalesce(b.n, 0)""")
def multiset_difference(spark, sf):
    return audit.multiset_difference(
        views.bars_daily(spark, sf).select("stock", "volume"), _copy(spark, sf).select("stock", "volume")
    )


@query("frame_checksum", f"{BARS_SQL} SELECT stock, count(*) AS rows, true AS survives_round_trip FROM bars GROUP BY 1")
def frame_checksum(spark, sf):
    bars = views.bars_daily(spark, sf)
    root = scratch_dir(spark, "round-trip")
    lake.write_bars_monthly(bars, root)
    before = audit.frame_checksum(bars)
    after = audit.frame_checksum(scan_partitions(spark, root).select(*BARS.names)).select(
        "stock", F.col("checksum").alias("again")
    )
    return before.join(after, "stock").select("stock", "rows", (F.col("checksum") == F.col("again")).alias("survives_round_trip"))


@query("migration_totals", f"""{PERTURBED}, {COUNTS}, v AS (SELECT o, m, o = m AND d.stock IS NULL AS ok FROM c LEFT JOIN d ON c.stock = d.stock)
  SELECT 'us:yahoo' AS venue, '1d' AS interval, CASE WHEN bool_and(ok) THEN 'complete' ELSE 'failed' END AS status, CAST(sum(o) AS BIGINT) AS flat_rows,
  CAST(sum(m) AS BIGINT) AS stored_rows, count(*) AS jobs_total, count(*) FILTER (WHERE ok) AS jobs_completed FROM v""")
def migration_totals(spark, sf):
    return audit.migration_totals(verify_copies(spark, sf), "us:yahoo", "1d")


@query("all_intervals_verified", f"""{PERTURBED}, {COUNTS}, v AS (SELECT o = m AND d.stock IS NULL AS ok FROM c LEFT JOIN d ON c.stock = d.stock)
  SELECT 'us:yahoo' AS venue, bool_and(ok) AS activate_layout, CASE WHEN bool_and(ok) THEN 0::BIGINT ELSE 1::BIGINT END AS pending FROM v""")
def all_intervals_verified(spark, sf):
    bars = views.bars_daily(spark, sf)
    good = audit.migration_totals(audit.verify_copies(bars, bars), "us:yahoo", "1wk")
    return audit.all_intervals_verified(migration_totals(spark, sf).unionByName(good))


# Raw bars hold several rows for some keys; those tickers fail, the others are copied.
@query("migrate_interval", f"""WITH {views.BARS_RAW}, k AS (SELECT stock, count(*) AS n, count(DISTINCT date) AS keys FROM bars_raw GROUP BY 1)
  SELECT stock, n AS flat_rows, keys AS stored_rows, CASE WHEN n = keys THEN 'ok' ELSE 'row_count_mismatch' END AS verdict FROM k""")
def migrate_interval(spark, sf):
    verdicts, _ = lake.migrate_interval(
        spark, views.bars_raw(spark, sf).select(*BARS.names), scratch_dir(spark, "lake"), "us:yahoo", "1d"
    )
    return verdicts


@query("migrated_bars", f"""WITH {views.BARS_RAW}, k AS (SELECT stock FROM bars_raw GROUP BY 1 HAVING count(*) = count(DISTINCT date))
  SELECT stock, date, price AS close, volume FROM bars_raw WHERE stock IN (SELECT stock FROM k)""")
def migrated_bars(spark, sf):
    root = scratch_dir(spark, "lake")
    lake.migrate_interval(spark, views.bars_raw(spark, sf).select(*BARS.names), root, "us:yahoo", "1d")
    return scan_partitions(spark, root).select("stock", "date", "close", "volume")


@query("audit_parquet_files", """SELECT 'ok' AS status, '' AS missing_columns, false AS deletable, count(*) AS rows FROM lineitem
  UNION ALL SELECT 'missing_columns', 'close', false, count(*) FROM lineitem
  UNION ALL SELECT 'recoverable', 'sequence', false, count(*) FROM lineitem
  UNION ALL SELECT 'empty', '', false, 0
  UNION ALL SELECT 'unreadable', '', true, NULL""")
def audit_parquet_files(spark, sf):
    root = scratch_dir(spark, "audit")
    bars = views.bars_raw(spark, sf).select(*BARS.names)
    bars.write.parquet(f"{root}/good")
    bars.drop("close").write.parquet(f"{root}/lacking")
    bars.drop("sequence").write.parquet(f"{root}/recoverable")
    bars.limit(0).coalesce(1).write.parquet(f"{root}/nothing")
    bars.limit(1).select(F.lit("not parquet").alias("value")).write.text(f"{root}/broken")
    good = audit.audit_parquet_files(spark, root)
    broken = audit.list_files(spark, root, "*.txt").select("path")
    probed = audit.probe_files(broken.withColumn("length", F.lit(0).cast("bigint")))
    return good.unionByName(probed).groupBy("status", "missing_columns", "deletable").agg(
        F.sum("rows").alias("rows")
    )


@query("storage_footprint", """SELECT i AS interval, count(*) > 0 AS has_bytes, true AS margin_holds, true AS fits, 'copy' AS advice
  FROM lineitem, (SELECT unnest(['1d', '1wk']) AS i) GROUP BY i""")
def storage_footprint(spark, sf):
    root = scratch_dir(spark, "footprint")
    for interval in ("1d", "1wk"):
        views.bars_raw(spark, sf).select(*BARS.names).write.parquet(f"{root}/stocks_{interval}")
    sizes = audit.storage_footprint(audit.list_files(spark, root), 10**15)
    margin = F.col("required_bytes") == F.ceil(F.col("bytes") * F.lit(1.05))
    return sizes.select("interval", (F.col("bytes") > 0).alias("has_bytes"), margin.alias("margin_holds"), "fits", "advice")


@query("write_contract_check", f"""WITH {views.BARS_RAW} SELECT CASE WHEN volume = 13 THEN 'blank_ticker' ELSE 'foreign_ticker' END AS rule, count(*) AS rows
  FROM bars_raw WHERE volume IN (13, 14) GROUP BY 1""")
def write_contract_check(spark, sf):
    raw = views.bars_raw(spark, sf)
    wanted = raw.withColumn("wanted", F.when(F.col("volume") == 14, "other").otherwise(F.col("stock"))).withColumn(
        "stock", F.when(F.col("volume") == 13, " ").otherwise(F.col("stock"))
    )
    broken = lake.write_contract_violations(wanted, F.col("wanted"), market="us", source="yahoo", dataset="stocks", interval="1d")
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


VALIDATION = f"""WITH {views.TRADES}, d AS (SELECT CAST(trade_time AS DATE) AS day, count(DISTINCT date_trunc('minute', trade_time)) AS minutes FROM trades GROUP BY 1),
  v AS (SELECT isin, CAST(trade_time AS DATE) AS day, sum(volume) AS total, sum(CASE WHEN hour(trade_time) = 23 THEN volume ELSE 0 END) AS lost FROM trades GROUP BY ALL),
  checks AS (SELECT 'volume_conservation' AS "check", day, 'critical' AS severity, isin AS detail FROM v WHERE lost > 0.0001 * total
    UNION ALL SELECT 'minute_coverage', day, 'warning', CASE WHEN minutes >= 540 THEN '✓ Complete' WHEN minutes >= 450 THEN '⚠ Partial' ELSE '✗ Incomplete' END
    FROM d WHERE round(100.0 * minutes / 600, 2) < 75.0)"""


def _checks(spark, sf):
    trades = views.trades(spark, sf)
    bars = bar_ops.ohlcv_from_trades(trades.filter(F.hour("trade_time") != 23), "1h")
    return audit.aggregation_validation(
        bar_ops.volume_conservation(trades, bars), coverage_ops.trade_day_stats(trades, top=None), bar_ops.ohlc_violations(bars)
    )


@query("aggregation_validation", f"{VALIDATION} SELECT * FROM checks")
def aggregation_validation(spark, sf):
    return _checks(spark, sf)


@query("validation_outcome", f"""{VALIDATION} SELECT count(*) FILTER (WHERE severity = 'critical') AS critical,
  count(*) FILTER (WHERE severity = 'warning') AS warnings, 'hold' AS outcome FROM checks""")
def validation_outcome(spark, sf):
    return audit.validation_outcome(_checks(spark, sf))
