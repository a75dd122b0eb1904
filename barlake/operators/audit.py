"""Checksums, copy verification, file audit, validation and health."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schemas import BARS


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row; the null pattern is hashed too, since hashing skips nulls."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*columns, nulls)


def frame_checksum(df: DataFrame, keys: Sequence[str] = ("stock",)) -> DataFrame:
    """Row count and order-insensitive content hash per key."""
    hashed = row_hash(df.columns).cast("decimal(20,0)")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(hashed).cast("string").alias("checksum")
    )


def _copies(flat: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Both copies in one grouping, tagged by side."""
    columns = list(BARS.names)
    tagged = flat.select(*columns, F.lit(1).alias("_side")).unionByName(
        stored.select(*columns, F.lit(2).alias("_side"))
    )
    hashed = row_hash(columns).cast("decimal(20,0)")

    def on(side: int, value: Column) -> Column:
        return F.when(F.col("_side") == side, value)

    return tagged.groupBy(key).agg(
        F.count_if(F.col("_side") == 1).alias("flat_rows"),
        F.count_if(F.col("_side") == 2).alias("stored_rows"),
        F.coalesce(F.sum(on(1, hashed)).cast("string"), F.lit("empty")).alias("flat_checksum"),
        F.coalesce(F.sum(on(2, hashed)).cast("string"), F.lit("empty")).alias("stored_checksum"),
    )


def verify_copies(flat: DataFrame, stored: DataFrame, key: str = "stock") -> DataFrame:
    """Per ticker: rows on both sides and the verdict; a ticker on one side only is a mismatch."""
    verdict = (
        F.when(F.col("flat_rows") != F.col("stored_rows"), "row_count_mismatch")
        .when(F.col("flat_checksum") != F.col("stored_checksum"), "checksum_mismatch")
        .otherwise("ok")
    )
    return _copies(flat, stored, key).select(key, "flat_rows", "stored_rows", verdict.alias("verdict"))


def rowwise_compare(original: DataFrame, migrated: DataFrame, key: str = "stock", order: str = "date") -> DataFrame:
    """Per ticker: emptiness, row count, date range, then contents of the common columns.

    Contents are compared as multisets: equal rows of both sides cancel out in
    one grouping on all columns.
    """
    common = [c for c in original.columns if c in migrated.columns]
    if key not in common or order not in common:
        raise ValueError("no common key and date columns")
    tagged = original.select(*common, F.lit(1).alias("_o"), F.lit(0).alias("_m")).unionByName(
        migrated.select(*common, F.lit(0).alias("_o"), F.lit(1).alias("_m"))
    )
    distinct_rows = tagged.groupBy(*common).agg(F.sum("_o").alias("_o"), F.sum("_m").alias("_m"))
    date = F.col(order)
    per_key = distinct_rows.groupBy(key).agg(
        F.sum("_o").alias("original_rows"),
        F.sum("_m").alias("migrated_rows"),
        F.sum(F.abs(F.col("_o") - F.col("_m"))).alias("differing_rows"),
        F.min(F.when(F.col("_o") > 0, date)).alias("_o_min"),
        F.max(F.when(F.col("_o") > 0, date)).alias("_o_max"),
        F.min(F.when(F.col("_m") > 0, date)).alias("_m_min"),
        F.max(F.when(F.col("_m") > 0, date)).alias("_m_max"),
    )
    same_range = (F.col("_o_min") == F.col("_m_min")) & (F.col("_o_max") == F.col("_m_max"))
    verdict = (
        F.when(F.col("migrated_rows") == 0, "no_migrated_rows")
        .when(F.col("original_rows") == 0, "no_original_rows")
        .when(F.col("original_rows") != F.col("migrated_rows"), "row_count_mismatch")
        .when(~F.coalesce(same_range, F.lit(False)), "date_range_mismatch")
        .when(F.col("differing_rows") > 0, "content_mismatch")
        .otherwise("ok")
    )
    return per_key.select(key, "original_rows", "migrated_rows", verdict.alias("verdict"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with both counts."""
    tagged = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counted = tagged.groupBy(*left.columns).agg(
        F.sum("_l").alias("left_copies"), F.sum("_r").alias("right_copies")
    )
    return counted.filter(F.col("left_copies") != F.col("right_copies"))


def migration_totals(verified: DataFrame, venue: str, interval: str) -> DataFrame:
    """One status row per interval out of ``verify_copies`` rows."""
    ok = F.col("verdict") == "ok"
    return verified.agg(
        F.coalesce(F.sum("flat_rows"), F.lit(0)).cast("bigint").alias("flat_rows"),
        F.coalesce(F.sum("stored_rows"), F.lit(0)).cast("bigint").alias("stored_rows"),
        F.count(F.lit(1)).alias("jobs_total"),
        F.count_if(ok).alias("jobs_completed"),
    ).select(
        F.lit(venue).alias("venue"), F.lit(interval).alias("interval"),
        F.when(F.col("jobs_total") == F.col("jobs_completed"), "complete").otherwise("failed").alias("status"),
        "flat_rows", "stored_rows", "jobs_total", "jobs_completed",
    )


def all_intervals_verified(status: DataFrame) -> DataFrame:
    """Per venue: is every interval complete with equal rows, and how many are pending."""
    done = (F.col("status") == "complete") & (F.col("flat_rows") == F.col("stored_rows"))
    return status.groupBy("venue").agg(
        F.bool_and(done).alias("activate_layout"),
        F.count_if(F.col("status") != "complete").alias("pending"),
    )


# --- files -----------------------------------------------------------------

AUDIT = (
    "path STRING, length BIGINT, status STRING, rows BIGINT, missing_columns STRING, "
    "deletable BOOLEAN"
)


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Paths and sizes below a root; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )


# Fixed value: nanoseconds from the epoch to 2000-01-01; larger integers are taken for timestamps.
FIRST_EPOCH = 946_684_800_000_000_000


def _index_stands_in(file) -> bool:
    """Are the values of the file's ``index`` column whole numbers, and not all timestamps?"""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = file.schema_arrow.field("index").type
    if not (pa.types.is_integer(kind) or pa.types.is_floating(kind)):
        return False
    all_recent = True
    for batch in file.iter_batches(columns=["index"]):
        values = batch.column(0)
        if values.null_count or (pa.types.is_floating(kind) and not pc.all(pc.equal(pc.floor(values), values)).as_py()):
            return False
        all_recent = all_recent and pc.min(values).as_py() >= FIRST_EPOCH
    return not all_recent


def _probe(path: str, required: set[str]) -> tuple[str, int | None, str]:
    """Status, rows and missing columns from a footer (and the index column where that may stand in)."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    try:
        filesystem, inner = pafs.FileSystem.from_uri(path)
        with filesystem.open_input_file(inner) as handle:
            file = pq.ParquetFile(handle)
            rows, columns = file.metadata.num_rows, {f.name: f.type for f in file.schema_arrow}
            if rows == 0:
                return "empty", 0, ""
            missing = required - set(columns)
            if missing == {"sequence"} and ("index" not in columns or _index_stands_in(file)):
                return "recoverable", rows, "sequence"
            if missing:
                return "missing_columns", rows, ",".join(sorted(missing))
            if "stock" in columns and not (pa.types.is_string(columns["stock"]) or pa.types.is_large_string(columns["stock"])):
                return "bad_type", rows, "stock"
            return "ok", rows, ""
    except (OSError, pa.ArrowInvalid):
        return "unreadable", None, ""


def audit_parquet_files(spark: SparkSession, root: str, required: Sequence[str] = tuple(BARS.names)) -> DataFrame:
    """One row per parquet file below a root. Only unreadable files are deletable; nothing is deleted here."""
    return probe_files(list_files(spark, root), required)


def probe_files(files: DataFrame, required: Sequence[str] = tuple(BARS.names)) -> DataFrame:
    """Probe the footers of listed files (path, length) on the executors, spread by path."""
    wanted = set(required)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_probe(p, wanted) for p in batch["path"]]
            yield pd.DataFrame({
                "path": batch["path"],
                "length": batch["length"],
                "status": [f[0] for f in found],
                "rows": pd.array([f[1] for f in found], dtype="Int64"),
                "missing_columns": [f[2] for f in found],
                "deletable": [f[0] == "unreadable" for f in found],
            })

    return files.select("path", "length").repartition("path").mapInPandas(probe, AUDIT)


def storage_footprint(files: DataFrame, free_bytes: int, margin: float = 0.05) -> DataFrame:
    """Bytes per interval folder ``stocks_<interval>``, bytes needed for a copy, and whether they fit."""
    interval = F.regexp_extract("path", r"stocks_([^/]+)/", 1)
    need = F.ceil(F.col("bytes") * F.lit(1 + margin)).cast("bigint")
    return (
        files.groupBy(interval.alias("interval"))
        .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
        .withColumn("required_bytes", need)
        .withColumn("fits", F.col("required_bytes") <= F.lit(free_bytes))
        .withColumn("advice", F.when(F.col("fits"), "copy").otherwise("delete_flat_after_each_ticker"))
    )


def layout_stats(files: DataFrame, rows: DataFrame, baseline: str) -> DataFrame:
    """Rows, tickers, files and bytes per layout and the byte ratio to a baseline.

    ``files`` has layout, path, length; ``rows`` has layout, rows, tickers (a
    handful of layouts).
    """
    sizes = files.groupBy("layout").agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    base = sizes.filter(F.col("layout") == baseline).select(F.col("bytes"))
    return rows.join(sizes, "layout").withColumn("_base", base.scalar()).select(
        "layout", "tickers", "rows", "files", "bytes",
        F.round(F.col("bytes") / F.col("_base"), 4).alias("ratio"),
    )


# --- validation and health ---------------------------------------------------


def aggregation_validation(conservation: DataFrame, coverage: DataFrame, broken_bars: DataFrame,
                           min_coverage_pct: float = 75.0) -> DataFrame:
    """(check, day, severity, detail): volume and price breaks are critical, low coverage a warning."""
    volume = conservation.filter(~F.col("conserved")).select(
        F.lit("volume_conservation").alias("check"), "day", F.lit("critical").alias("severity"),
        F.col("isin").alias("detail"),
    )
    minutes = coverage.filter(F.col("capture_rate_pct") < min_coverage_pct).select(
        F.lit("minute_coverage").alias("check"), F.col("trade_date").alias("day"),
        F.lit("warning").alias("severity"), F.col("status").alias("detail"),
    )
    prices = broken_bars.select(
        F.lit("ohlc_consistency").alias("check"), F.to_date("bar").alias("day"),
        F.lit("critical").alias("severity"), F.concat_ws(":", "isin", "rule").alias("detail"),
    )
    return volume.unionByName(minutes).unionByName(prices)


def validation_outcome(checks: DataFrame) -> DataFrame:
    """One row: publish, partial (warnings only) or hold (any critical)."""
    critical, warnings = (F.count_if(F.col("severity") == s) for s in ("critical", "warning"))
    return checks.agg(critical.alias("critical"), warnings.alias("warnings")).withColumn(
        "outcome",
        F.when(F.col("critical") > 0, "hold").when(F.col("warnings") > 0, "partial").otherwise("publish"),
    )


def freshness(bars: DataFrame, as_of: str, keys: Sequence[str], ts: str = "bar", warn_days: int = 3,
              error_days: int = 7) -> DataFrame:
    """Age in days of the latest row per key and its status."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("latest"))
    return (
        bars.groupBy(*keys)
        .agg(F.max(F.to_date(ts)).alias("latest"))
        .withColumn("age_days", age)
        .withColumn(
            "status",
            F.when(F.col("age_days") > error_days, "error").when(F.col("age_days") > warn_days, "stale").otherwise("ok"),
        )
    )


def mapping_freshness(mapping: DataFrame, as_of: str, warn_days: int = 2) -> DataFrame:
    return mapping.agg(
        F.max("last_seen").alias("latest"), F.count_if(F.col("status") == "active").alias("active")
    ).withColumn("age_days", F.datediff(F.lit(as_of).cast("date"), F.col("latest"))).withColumn(
        "status", F.when(F.col("age_days") <= warn_days, "ok").otherwise("warn")
    )


def download_freshness(log: DataFrame, as_of: str, alert_hours: int = 18) -> DataFrame:
    """Hours since the last logged download per venue."""
    hours = F.timestamp_diff("SECOND", F.col("latest"), F.lit(as_of).cast("timestamp_ntz")) / 3600
    return (
        log.groupBy("venue").agg(F.max("downloaded_at").alias("latest"))
        .withColumn("age_hours", hours)
        .withColumn("status", F.when(F.col("age_hours") > alert_hours, "alert").otherwise("ok"))
    )


LEVELS = {"ok": 0, "stale": 1, "warn": 1, "alert": 1, "error": 2}


def health_report(checks: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(check, subject, status, level) of every check; see ``exit_level``."""
    report = None
    for name, (df, subject) in checks.items():
        level = F.lit(2)
        for status, number in LEVELS.items():
            level = F.when(F.col("status") == status, number).otherwise(level)
        part = df.select(
            F.lit(name).alias("check"), subject.cast("string").alias("subject"), "status", level.alias("level")
        )
        report = part if report is None else report.unionByName(part)
    return report


def exit_level(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.max("level"), F.lit(0)).alias("exit_level"))
