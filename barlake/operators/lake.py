"""Writing, merging, compacting and publishing lake tables."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.names import partition_day, partition_month, partition_year
from barlake.operators import folders
from barlake.operators.audit import frame_checksum, migration_totals, verify_copies
from barlake.operators.dedupe import dedupe_bars, dedupe_trades, keep_last
from barlake.operators.mapping import map_isin_to_ticker, split_mapped
from barlake.operators.normalize import normalize_bars, split_null_dates
from barlake.schemas import BARS
from barlake.session import hadoop_path as _path
from barlake.session import listing, local_path, scratch_dir
from barlake.sources.bars import LAYOUT_COLUMNS, read_folders, scan_partitions


def write_partitioned(
    df: DataFrame, root: str, partition_by: Sequence[str], sort_by: Sequence[str], many_folders: bool = False, **options
) -> None:
    """Range-partitioned write of sorted files; only partitions in ``df`` are replaced.

    ``many_folders`` is for layouts with small folders, such as one per
    instrument. There the work is files and not bytes: adaptive execution would
    put the few bytes of thousands of folders in one task, so the number of
    ranges is fixed at that of shuffle partitions. A new table on a local disk is
    written by ``folders``, unless an option other than the compression is named.

    Ranges over the partition and sort columns split a heavy partition over
    several tasks, and keep a light one in few files.

    A lookup by a sort column skips row groups by their least and largest value.
    ``bloom`` names columns of equality lookups that are not sorted, such as the
    instrument in trades sorted by time: a row group without the value is then
    skipped as well (by its dictionary, or by a Bloom filter where the values do
    not fit in one). ``block_bytes`` sets the size of row groups.
    """
    by = [*partition_by, *sort_by]
    if many_folders:
        ranged = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
    else:
        ranged = df.repartitionByRange(*by)
    if many_folders and set(options) <= {"compression"} and local_path(df.sparkSession, root):
        if _write_new_folders(ranged.sortWithinPartitions(*by), root, partition_by, **options):
            return
    _write_sorted(ranged, root, partition_by, sort_by, **options)


def _write_new_folders(df: DataFrame, root: str, partition_by: Sequence[str], **options) -> bool:
    """A new local table of many folders, written beside its place and renamed as a whole; False where there is one already."""
    files, place = _path(df.sparkSession, root)
    if files.exists(place):
        return False
    target = local_path(df.sparkSession, root)
    beside = f"{target}-{uuid.uuid4().hex}.writing"
    folders.write_folders(df, beside, partition_by, **options)
    os.rename(beside, target)
    return True


def _write_sorted(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    compression: str = "gzip",
    rows_per_file: int = 0,
    block_bytes: int | None = None,
    bloom: Sequence[str] = (),
) -> None:
    """Sorted files in their folders; a new table is written beside its place and renamed as a whole.

    So tasks place the files of a new table themselves. Replacing partitions of
    a table leaves that to the driver, which moves folders one by one.
    """
    writer = (
        df.sortWithinPartitions(*partition_by, *sort_by)
        .write.partitionBy(*partition_by)
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
    )
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    if bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    files, place = _path(df.sparkSession, root)
    if files.exists(place):
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)
        return
    beside = f"{root.rstrip('/')}-{uuid.uuid4().hex}.writing"
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(beside)
    if not files.rename(_path(df.sparkSession, beside)[1], place):
        raise OSError(f"cannot move {beside} to {root}")


def _bar_partitions(df: DataFrame, layout: str) -> DataFrame:
    values: dict[str, Column] = {
        "ticker": F.col("stock"), "year": partition_year("date"), "month": partition_month("date")
    }
    return df.withColumns({c: values[c] for c in LAYOUT_COLUMNS[layout]})


def write_bars_monthly(
    bars: DataFrame, root: str, layout: str = "by_month", compression: str = "gzip", **options
) -> DataFrame:
    """Write bars by year and month (default) or by ticker, year and month.

    Rows without a date have no place; they are returned.
    """
    placed, undated = split_null_dates(bars.select(*BARS.names))
    write_partitioned(
        _bar_partitions(placed, layout), root, LAYOUT_COLUMNS[layout], ["stock", "date"],
        many_folders=layout == "by_ticker", compression=compression, **options,
    )
    return undated


def write_contract_violations(
    bars: DataFrame, ticker: Column | None = None, **location: str
) -> DataFrame:
    """Rows that break the write contract, with the rule.

    Market, source, dataset and interval must be named. A row needs a ticker,
    and it must be the requested one where one is requested.
    """
    absent = [n for n in ("market", "source", "dataset", "interval") if not (location.get(n) or "").strip()]
    if absent:
        raise ValueError(f"partitioned storage needs {', '.join(absent)}")
    blank = F.coalesce(F.trim("stock"), F.lit("")) == ""
    rule = F.when(blank, "blank_ticker")
    if ticker is not None:
        rule = rule.when(~F.col("stock").eqNullSafe(ticker), "foreign_ticker")
    return bars.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def merge_bars(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both batches normalised, latest version of each key kept; the new batch wins ties."""
    old = normalize_bars(existing).withColumn("batch_rank", F.lit(0))
    fresh = normalize_bars(new).withColumn("batch_rank", F.lit(1))
    return dedupe_bars(old.unionByName(fresh)).drop("batch_rank")


PRUNED_PARTITIONS = 10_000


def prune_to(stored: DataFrame, batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored rows of the calendar (and venue) partitions that a batch touches.

    Up to ``PRUNED_PARTITIONS`` values are fetched and become a literal partition
    filter, so no other folder is read. A batch that touches more, such as a
    backfill of years, is joined instead, and Spark prunes while it runs.
    """
    key = F.concat_ws("/", *columns)
    touched = [r[0] for r in batch.select(key).distinct().limit(PRUNED_PARTITIONS + 1).collect()]
    if len(touched) > PRUNED_PARTITIONS:
        return stored.join(batch.select(*columns).distinct(), list(columns), "left_semi").select(*stored.columns)
    return stored.filter(key.isin(touched))


def upsert_bars(spark: SparkSession, root: str, new: DataFrame, layout: str = "by_month",
                quarantine: str | None = None, **options) -> DataFrame:
    """Merge a batch into the lake, rewriting only the partitions it touches.

    Rows without a date are returned, and stored in ``quarantine`` if that folder
    is named. It is the folder of this batch: a batch that comes again replaces it.

    The merge is staged first, since Spark cannot overwrite what it reads, and
    its folders are then moved; see ``publish``. Running it twice is the same as
    once.
    """
    parts = LAYOUT_COLUMNS[layout]
    # read once: the batch is asked for its partitions, its ranges and its rows
    staged = scratch_dir(spark, "batch")
    normalize_bars(new).write.parquet(staged)
    dated, undated = split_null_dates(spark.read.schema(BARS).parquet(staged))
    if quarantine:
        undated.write.mode("overwrite").parquet(quarantine)
    touched = _bar_partitions(dated, layout).select(*parts).distinct()
    existing = prune_to(scan_partitions(spark, root, layout), touched, ["year", "month"])
    if layout == "by_ticker":
        existing = existing.join(touched, parts, "left_semi")
    stage = scratch_dir(spark, "upsert")
    write_bars_monthly(merge_bars(existing, dated), stage, layout, **options)
    publish(spark, stage, root, parts)
    return undated


def _text_partitions(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in schema.fields]
    )


def read_staged(
    spark: SparkSession, root: str, partition_by: Sequence[str], schema: T.StructType | None = None, many_folders: bool = False
) -> DataFrame:
    """A partitioned table with its partition values kept as text.

    Name the schema where the table may be empty: no file then tells it. Else
    one file does, so that the folders are listed once and not twice.
    ``many_folders`` is for tables written with it: see ``read_folders``.
    """
    if schema is None:
        one = _any_file(spark, root)
        schema = spark.read.option("basePath", root).parquet(one or root).schema
    if many_folders:
        return read_folders(spark, root, schema, [c for c in partition_by if c in schema.names])
    with listing(spark):
        return spark.read.schema(_text_partitions(schema, partition_by)).option("basePath", root).parquet(root)


READY = "_publish.json"
MOVES_AT_ONCE = 16


def _any_file(spark: SparkSession, root: str) -> str | None:
    """The first data file of a table, found by going down its folders; None if it has none."""
    files, place = _path(spark, root)
    if not files.exists(place):
        return None
    top = files.makeQualified(place).toString().rstrip("/")
    found = files.listFiles(place, True)  # goes down one folder at a time
    while found.hasNext():
        path = found.next().getPath().toString()
        if not any(name.startswith(("_", ".")) for name in path[len(top) + 1:].split("/")):
            return path
    return None


def publish(spark: SparkSession, stage: str, active: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions of the active table that the stage holds, by moving their folders.

    The stage is a complete write, so no file is written twice. Before the first
    folder moves, a note in the stage names the target; ``resume_publishes``
    finishes a publish that stopped anywhere after that, and one that stopped
    before has changed nothing. A replaced folder is moved into the stage and the
    new one takes its place, several at a time, and the stage is removed at the
    end: old rows are away for the time between two renames and not for that of a
    delete. Where a store renames folders in one step, as HDFS and POSIX do, a
    reader meets the old or the new month or, between the two, none of it. Object
    stores that copy on rename need a table format for more than that.
    """
    note = json.dumps({"active": active, "depth": len(partition_by)})
    files, place = _path(spark, f"{stage}/{READY}")
    out = files.create(place, True)
    out.write(bytearray(note, "utf-8"))
    out.close()
    _move_partitions(spark, stage, active, len(partition_by))


def _move_partitions(spark: SparkSession, stage: str, active: str, depth: int) -> None:
    source, root = _path(spark, stage)
    target, top = _path(spark, active)
    base = source.makeQualified(root).toString()
    target.mkdirs(top)
    # looked up once: every name on the way to a class is a call to the JVM
    util, conf, place = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    same = source.getUri().equals(target.getUri())

    def move(folder) -> None:
        within = source.makeQualified(folder).toString()[len(base):]
        to = place(active + within)
        if not same:  # copied beside its place first, then renamed like the others
            beside = place(f"{active}/_publish{within}")
            util.copy(source, folder, target, beside, False, True, conf)
        if target.exists(to):
            aside = place(f"{stage if same else active}/_replaced{within}")
            target.delete(aside, True)
            target.mkdirs(aside.getParent())
            if not target.rename(to, aside):
                raise OSError(f"cannot move {to.toString()} away")
        target.mkdirs(to.getParent())
        if not target.rename(folder if same else beside, to):
            raise OSError(f"cannot move {folder.toString()}")
        if not same:
            source.delete(folder, True)

    def to_move(folder, level: int) -> list:
        """Folders to move of those under this one: whatever the target has nothing of moves as a whole."""
        found = []
        for status in source.listStatus(folder):
            path = status.getPath()
            if not status.isDirectory() or "=" not in path.getName():
                continue
            within = source.makeQualified(path).toString()[len(base):]
            if level == depth or not target.exists(place(active + within)):
                found.append(path)
            else:
                found += to_move(path, level + 1)
        return found

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(move, to_move(root, 1)))
    if not same:
        for left in ("_publish", "_replaced"):
            target.delete(_path(spark, f"{active}/{left}")[1], True)
    source.delete(root, True)


def resume_publishes(spark: SparkSession, base: str) -> list[str]:
    """Finish the publishes whose stages are left under a scratch folder; the tables that were touched."""
    files, _ = _path(spark, base)
    done = []
    for found in files.globStatus(_path(spark, f"{base}/*/{READY}")[1]):
        stream = files.open(found.getPath())
        note = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        _move_partitions(spark, found.getPath().getParent().toString(), note["active"], note["depth"])
        done.append(note["active"])
    return done


TRADE_PARTITIONS = ["feed_venue", "year", "month", "day"]


def with_trade_partitions(trades: DataFrame, ts: str = "trade_time") -> DataFrame:
    return trades.withColumns(
        {"year": partition_year(ts), "month": partition_month(ts), "day": partition_day(ts)}
    )


def append_trades_daily(spark: SparkSession, root: str, new: DataFrame, **options) -> None:
    """Add trades (with ``feed_venue``) to their venue-days, each trade once.

    A re-delivered trade is dropped; an unreadable stored file fails the job
    instead of being overwritten.
    """
    placed = with_trade_partitions(new)
    stored = read_trades(spark, root, placed)
    existing = prune_to(stored, placed, TRADE_PARTITIONS)
    both = existing.withColumn("batch_rank", F.lit(0)).unionByName(placed.withColumn("batch_rank", F.lit(1)))
    merged = dedupe_trades(both).drop("batch_rank")
    stage = scratch_dir(spark, "trades")
    write_partitioned(merged, stage, TRADE_PARTITIONS, ["trade_time", "tick_id"], **options)
    publish(spark, stage, root, TRADE_PARTITIONS)


def read_trades(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """Stored trades under the schema of ``like``; empty when nothing is stored."""
    try:
        return spark.read.schema(like.schema).option("basePath", root).parquet(root).select(*like.columns)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], like.schema)
        raise


def consolidate_month(
    trades: DataFrame, root: str, venue: str, year: str, month: str, compression: str = "gzip", **options
) -> None:
    """Compact the daily files of a venue-month, sorted by time; the daily files stay."""
    chosen = trades.filter(
        (F.col("feed_venue") == venue) & (F.col("year") == year) & (F.col("month") == month)
    ).drop("day")
    write_partitioned(
        chosen, root, ["feed_venue", "year", "month"], ["trade_time", "tick_id"],
        compression=compression, **options,
    )


PERIODS = {"daily": "day", "weekly": "week", "monthly": "month", "yearly": "year"}


def period_start(name: str, ts: str = "date") -> Column:
    """First day of the row's period; weeks run Monday to Sunday."""
    day = F.to_date(ts)
    return day if name == "daily" else F.trunc(day, PERIODS[name])


def layout_write(bars: DataFrame, root: str, name: str, **options) -> None:
    """One of the layouts under comparison: bars by day, week, month or year."""
    placed = bars.withColumn("period", period_start(name).cast("string"))
    write_partitioned(placed, root, ["period"], ["stock", "date"], **options)


def write_ohlcv_dual(mapped_bars: DataFrame, root: str, **options) -> None:
    """Mapped bars under ``by_ticker`` without isin, unmapped ones under ``by_isin`` with it."""
    # stored once: either side is read for its ranges and for its rows
    rows = scratch_dir(mapped_bars.sparkSession, "mapped")
    mapped_bars.write.parquet(rows)
    stored = mapped_bars.sparkSession.read.schema(mapped_bars.schema).parquet(rows)
    placed = stored.withColumns({"year": partition_year("bar"), "month": partition_month("bar")})
    with_ticker, without = split_mapped(placed)
    write_partitioned(
        with_ticker, f"{root}/by_ticker", ["feed_venue", "ticker", "year", "month"], ["bar"], many_folders=True, **options
    )
    write_partitioned(
        without.withColumn("isin_part", F.col("isin")), f"{root}/by_isin",
        ["feed_venue", "isin_part", "year", "month"], ["bar"], many_folders=True, **options
    )


DUAL_PARTITIONS = {"by_ticker": ["feed_venue", "ticker", "year", "month"], "by_isin": ["feed_venue", "isin_part", "year", "month"]}


def backfill_moved(spark: SparkSession, root: str, mapping: DataFrame, **options) -> DataFrame:
    """Move stored bars whose ISIN has a ticker by now from ``by_isin`` to ``by_ticker``; how many rows went where.

    Bars of a ticker that are stored already stay, the moved ones are added; on
    the same bar the stored one wins. A folder of one ISIN moves as a whole, so
    nothing of ``by_isin`` is rewritten. The ticker side is published first: a
    run that stops in between repeats with the same result.
    """
    isin_root, ticker_root = f"{root}/by_isin", f"{root}/by_ticker"
    unmapped = read_staged(spark, isin_root, DUAL_PARTITIONS["by_isin"], many_folders=True)
    # the folder as it is stored: partition values are escaped in its name
    folder = F.regexp_extract("_metadata.file_path", "^(.*/isin_part=[^/]+)/", 1)
    moved, _ = split_mapped(map_isin_to_ticker(unmapped.withColumn("_folder", folder), mapping))
    # the many small files are read once
    rows = scratch_dir(spark, "backfill")
    moved.write.parquet(rows)
    moved = spark.read.schema(moved.schema).parquet(rows)
    counted = scratch_dir(spark, "backfill")
    moved.groupBy(F.col("isin_part").alias("isin"), "feed_venue").agg(
        F.count(F.lit(1)).alias("rows"), F.first("ticker").alias("ticker"), F.first("_folder").alias("folder")).write.parquet(counted)
    counts = spark.read.parquet(counted)
    columns = [c for c in unmapped.columns if c not in ("isin", "isin_part")]
    fresh = moved.select(*columns, "ticker").withColumn("_rank", F.lit(0))
    files, place = _path(spark, ticker_root)
    if files.exists(place):
        kind = fresh.drop("_rank").schema
        stored = read_staged(spark, ticker_root, DUAL_PARTITIONS["by_ticker"], kind, many_folders=True)
        near = prune_to(stored, fresh, DUAL_PARTITIONS["by_ticker"]).select(*columns, "ticker")
        fresh = near.withColumn("_rank", F.lit(1)).unionByName(fresh)
    keys = ["feed_venue", "ticker", "bar"]
    values = [F.col(c) for c in columns if c not in (*keys, "year", "month")]
    merged = keep_last(fresh, keys, [F.col("_rank"), *values]).drop("_rank")
    stage = scratch_dir(spark, "backfill")
    write_partitioned(merged, stage, DUAL_PARTITIONS["by_ticker"], ["bar"], many_folders=True, **options)
    publish(spark, stage, ticker_root, DUAL_PARTITIONS["by_ticker"])
    gone = counts.select("folder")
    if local_path(spark, isin_root):
        folders.delete_folders(gone, "folder")
        return counts.drop("folder")
    files, _ = _path(spark, isin_root)
    uri, path = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path

    def drop(row) -> None:
        files.delete(path(uri(row["folder"])), True)

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        for _ in pool.map(drop, gone.toLocalIterator()):
            pass
    return counts.drop("folder")


def trades_by_isin_archive(trades: DataFrame, root: str, **options) -> None:
    """Trades again, by instrument and month."""
    placed = trades.withColumns({"year": partition_year("trade_time"), "month": partition_month("trade_time")})
    write_partitioned(placed, root, ["isin", "year", "month"], ["trade_time", "tick_id"], many_folders=True, **options)


def retention(df: DataFrame, as_of: str, keep_days: int, ts: str) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, and the expired days with their row counts (the deletion list)."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date(ts))
    expired = df.filter(age > keep_days).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return df.filter(F.coalesce(age <= keep_days, F.lit(True))), expired


def staged_publish(
    spark: SparkSession,
    new: DataFrame,
    active: str,
    outcome: DataFrame,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    keys: Sequence[str],
    verified_at: str,
    **options,
) -> DataFrame:
    """Stage a table, publish it unless a critical check failed, return its manifest.

    ``outcome`` is the one row of ``validation_outcome``. The manifest has a
    checksum per key, the stage path and the status: published, partial or held.
    A held stage stays for inspection.
    """
    stage = scratch_dir(spark, "publish")
    write_partitioned(new, stage, partition_by, sort_by, **options)
    verdict = outcome.first()["outcome"]
    status = {"publish": "published", "partial": "partial", "hold": "held"}[verdict]
    staged = read_staged(spark, stage, partition_by, new.schema)
    manifest = scratch_dir(spark, "manifest")
    frame_checksum(staged.select(*sorted(staged.columns)), keys).withColumns(
        {"status": F.lit(status), "stage": F.lit(stage), "verified_at": F.lit(verified_at)}
    ).write.parquet(manifest)
    if verdict != "hold":
        publish(spark, stage, active, partition_by)
    return spark.read.parquet(manifest)


def migrate_interval(
    spark: SparkSession,
    flat: DataFrame,
    root: str,
    venue: str,
    interval: str,
    layout: str = "by_month",
    overwrite: bool = False,
    tickers: DataFrame | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Copy flat bars into the partitioned layout and verify every ticker.

    Returns the verdict per ticker and the status row of the interval. Tickers
    that fail (for one, those with repeated keys) are not published. With
    ``overwrite`` the stored bars of a ticker are replaced, else merged. A run
    limited to some ``tickers`` returns an empty status, as it settles nothing.
    """
    chosen = flat if tickers is None else flat.join(tickers.select("stock"), "stock", "left_semi")
    source = normalize_bars(chosen)
    stored = scan_partitions(spark, root, layout)
    mine = source.select("stock").distinct()
    base = spark.createDataFrame([], BARS) if overwrite else stored.join(mine, "stock", "left_semi").select(*BARS.names)
    stage = scratch_dir(spark, "migrate")
    write_bars_monthly(merge_bars(base, source), stage, layout, **options)
    staged = scan_partitions(spark, stage, layout)
    verdicts = verify_copies(source, staged.select(*BARS.names))
    checked = scratch_dir(spark, "verdicts")
    verdicts.write.parquet(checked)
    verdicts = spark.read.parquet(checked)
    passed = verdicts.filter(F.col("verdict") == "ok").select("stock")
    fresh = staged.join(passed, "stock", "left_semi").select(*BARS.names)
    # partitions are shared by tickers in the monthly layout: keep what the others hold
    parts = LAYOUT_COLUMNS[layout]
    touched = _bar_partitions(fresh, layout).select(*parts).distinct()
    near = prune_to(stored, touched, ["year", "month"]).join(touched, parts, "left_semi")
    others = near.join(passed, "stock", "left_anti").select(*BARS.names)
    final = scratch_dir(spark, "migrated")
    write_bars_monthly(others.unionByName(fresh), final, layout, **options)
    publish(spark, final, root, parts)
    totals = migration_totals(verdicts, venue, interval)
    return verdicts, totals if tickers is None else totals.limit(0)
