"""Writers and lake jobs on temporary folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barlake import schemas
from barlake.operators import audit, lake
from barlake.session import scratch_dir
from barlake.sources.bars import (
    discover_partitions,
    scan_bars_flat,
    scan_bars_partitioned,
    scan_partitions,
    select_prices,
)
from tests.test_fixtures import bar_rows, closes, trade_rows

TWO_MONTHS = [("123", "2024-01-01", 1.0, 1), ("BRK.B", "2024-01-31", 2.0, 1), ("123", "2024-02-01", 3.0, 1)]


def files_of(root, suffix=".parquet"):
    return [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(suffix)]


def test_missing_root_gives_the_schema(spark, folder):
    assert scan_bars_flat(spark, f"{folder}/none").schema == schemas.BARS
    assert scan_bars_partitioned(spark, f"{folder}/none").columns == schemas.BARS.names


@pytest.mark.parametrize("layout", ["by_month", "by_ticker"])
def test_layouts_keep_text_and_do_not_store_partitions(spark, folder, layout):
    lake.write_bars_monthly(bar_rows(spark, TWO_MONTHS), folder, layout)
    stored = scan_partitions(spark, folder, layout)
    assert {r["month"] for r in stored.select("month").collect()} == {"01", "02"}
    inner = spark.read.parquet(files_of(folder)[0])
    assert inner.columns == schemas.BARS.names
    assert closes(scan_bars_partitioned(spark, folder, layout)) == closes(bar_rows(spark, TWO_MONTHS))
    if layout == "by_ticker":
        assert {r[0] for r in discover_partitions(spark, folder).collect()} == {"123", "BRK.B"}


def test_rows_without_a_date_come_back(spark, folder):
    batch = bar_rows(spark, [*TWO_MONTHS, ("A", None, 9.0, 1)])
    undated = lake.upsert_bars(spark, f"{folder}/lake", batch, quarantine=f"{folder}/quarantine")
    assert [r["stock"] for r in undated.collect()] == ["A"] == [r["stock"] for r in spark.read.parquet(f"{folder}/quarantine").collect()]
    assert closes(scan_bars_partitioned(spark, f"{folder}/lake")) == closes(bar_rows(spark, TWO_MONTHS))
    assert lake.write_bars_monthly(batch, f"{folder}/again").count() == 1


def test_a_batch_over_many_partitions_is_joined(spark, folder, monkeypatch):
    lake.write_bars_monthly(bar_rows(spark, TWO_MONTHS), folder)
    touched = spark.createDataFrame([("2024", "02"), ("2024", "03")], "year string, month string")
    few = lake.prune_to(scan_partitions(spark, folder), touched, ["year", "month"])
    monkeypatch.setattr(lake, "PRUNED_PARTITIONS", 1)
    many = lake.prune_to(scan_partitions(spark, folder), touched, ["year", "month"])
    assert many.columns == few.columns and many.collect() == few.collect() and few.count() == 1


@pytest.mark.parametrize("compression", ["gzip", "snappy", "none"])
def test_compression(spark, folder, compression):
    lake.write_bars_monthly(bar_rows(spark, TWO_MONTHS), folder, compression=compression)
    suffix = {"gzip": ".gz.parquet", "snappy": ".snappy.parquet", "none": ".parquet"}[compression]
    assert files_of(folder, suffix)


def test_upsert_rewrites_touched_months_only_and_is_idempotent(spark, folder):
    lake.upsert_bars(spark, folder, bar_rows(spark, TWO_MONTHS))
    before = {f: os.stat(f).st_mtime_ns for f in files_of(f"{folder}/year=2024/month=01")}
    new = bar_rows(spark, [("123", "2024-02-01", 9.0, None), ("NEW", "2024-02-02", 4.0, None), ("BAD", None, 1.0, 1)])
    for _ in range(2):
        lake.upsert_bars(spark, folder, new)
        assert closes(scan_bars_partitioned(spark, folder)) == {
            ("123", "2024-01-01"): 1.0, ("BRK.B", "2024-01-31"): 2.0, ("123", "2024-02-01"): 9.0, ("NEW", "2024-02-02"): 4.0}
    assert {f: os.stat(f).st_mtime_ns for f in files_of(f"{folder}/year=2024/month=01")} == before


def test_unreadable_stored_file_fails_the_merge(spark, folder):
    lake.upsert_bars(spark, folder, bar_rows(spark, TWO_MONTHS))
    victim = files_of(f"{folder}/year=2024/month=02")[0]
    with open(victim, "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        lake.upsert_bars(spark, folder, bar_rows(spark, [("123", "2024-02-03", 1.0, 1)]))
    assert open(victim, "rb").read() == b"not parquet"


def test_select_prices_prunes_months(spark, folder):
    lake.write_bars_monthly(bar_rows(spark, TWO_MONTHS), folder)
    out = select_prices(spark, folder, ["123"], "2024-02-01", "2024-02-28")
    assert closes(out) == {("123", "2024-02-01"): 3.0}
    assert len(out.inputFiles()) >= 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def trades_of(spark, rows):
    return trade_rows(spark, rows).withColumns({"trans_id": F.concat("isin", "tick_id"), "feed_venue": F.lit("DETR")})


def test_redelivered_trades_are_stored_once(spark, folder):
    rows = [("A", "2025-01-02 10:00:00", 1, 1.0, 1.0), ("A", "2025-01-03 10:00:00", 2, 1.0, 1.0)]
    lake.append_trades_daily(spark, folder, trades_of(spark, rows))
    lake.append_trades_daily(spark, folder, trades_of(spark, rows[1:] + [("B", "2025-01-03 11:00:00", 3, 1.0, 1.0)]))
    stored = lake.read_staged(spark, folder, lake.TRADE_PARTITIONS)
    assert stored.count() == 3 and {r["day"] for r in stored.collect()} == {"02", "03"}
    root = f"{folder}-monthly"
    lake.consolidate_month(stored, root, "DETR", "2025", "01")
    month = lake.read_staged(spark, root, lake.TRADE_PARTITIONS[:3])
    assert month.count() == 3 and "day" not in month.columns
    times = [r["trade_time"] for r in month.collect()]
    assert times == sorted(times)
    assert stored.count() == 3


def test_migration_publishes_sound_tickers_only(spark, folder):
    flat = bar_rows(spark, TWO_MONTHS + [("DUP", "2024-01-05", 1.0, 1), ("DUP", "2024-01-05", 2.0, 2)])
    verdicts, totals = lake.migrate_interval(spark, flat, folder, "us:yahoo", "1d")
    assert {r["stock"]: r["verdict"] for r in verdicts.collect()} == {"123": "ok", "BRK.B": "ok", "DUP": "row_count_mismatch"}
    assert totals.first()["status"] == "failed"
    assert closes(scan_bars_partitioned(spark, folder)) == closes(bar_rows(spark, TWO_MONTHS))


def test_migration_meets_existing_rows(spark, folder):
    lake.write_bars_monthly(bar_rows(spark, [("123", "2024-01-09", 7.0, 1), ("OTHER", "2024-01-09", 8.0, 1)]), folder)
    flat = bar_rows(spark, TWO_MONTHS)
    verdicts, _ = lake.migrate_interval(spark, flat, folder, "us:yahoo", "1d")
    assert {r["stock"]: r["verdict"] for r in verdicts.collect()}["123"] == "row_count_mismatch"
    verdicts, totals = lake.migrate_interval(spark, flat, folder, "us:yahoo", "1d", overwrite=True)
    assert totals.first()["status"] == "complete"
    assert closes(scan_bars_partitioned(spark, folder)) == {**closes(flat), ("OTHER", "2024-01-09"): 8.0}


def test_partial_migration_settles_nothing(spark, folder):
    flat = bar_rows(spark, TWO_MONTHS)
    verdicts, totals = lake.migrate_interval(
        spark, flat, folder, "us:yahoo", "1d", tickers=spark.createDataFrame([("123",)], "stock string"))
    assert [r["stock"] for r in verdicts.collect()] == ["123"] and totals.count() == 0


def test_critical_check_holds_the_publish(spark, folder):
    bars = bar_rows(spark, TWO_MONTHS).withColumns({"year": F.lit("2024"), "month": F.lit("01")})
    checks = spark.createDataFrame([("v", dt.date(2024, 1, 1), "critical", "x")], "check string, day date, severity string, detail string")
    args = (["year", "month"], ["stock", "date"], ["stock"], "2024-02-02")
    manifest = lake.staged_publish(spark, bars, f"{folder}/active", audit.validation_outcome(checks), *args)
    assert {r["status"] for r in manifest.collect()} == {"held"} and not os.path.exists(f"{folder}/active")
    warned = checks.withColumn("severity", F.lit("warning"))
    manifest = lake.staged_publish(spark, bars, f"{folder}/active", audit.validation_outcome(warned), *args)
    assert {r["status"] for r in manifest.collect()} == {"partial"} and files_of(f"{folder}/active")


def test_file_audit(spark, folder):
    bars = bar_rows(spark, TWO_MONTHS).coalesce(1)
    bars.write.parquet(f"{folder}/ok")
    bars.drop("close", "open").write.parquet(f"{folder}/lacking")
    bars.limit(0).write.parquet(f"{folder}/empty")
    bars.drop("sequence").withColumn("index", F.lit(3)).write.parquet(f"{folder}/promoted")
    bars.drop("sequence").withColumn("index", F.lit(1_700_000_000_000_000_000)).write.parquet(f"{folder}/epoch")
    bars.drop("sequence").withColumn("index", F.col("date")).write.parquet(f"{folder}/dated")
    os.makedirs(f"{folder}/broken")
    with open(f"{folder}/broken/x.parquet", "wb") as f:
        f.write(b"PAR1 truncated")
    found = {r["path"].split("/")[-2]: r for r in audit.audit_parquet_files(spark, folder).collect()}
    assert {k: r["status"] for k, r in found.items()} == {
        "ok": "ok", "lacking": "missing_columns", "empty": "empty", "promoted": "recoverable", "epoch": "missing_columns",
        "dated": "missing_columns", "broken": "unreadable"}
    assert found["lacking"]["missing_columns"] == "close,open"
    assert [k for k, r in found.items() if r["deletable"]] == ["broken"] and os.path.exists(f"{folder}/broken/x.parquet")


def test_nanosecond_files_load_with_the_long_option(spark, folder):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from barlake.sources.bars import read_nano_parquet

    ns = 1_730_622_600_042_457_058
    table = pa.table({"trade_time": pa.array([ns], pa.timestamp("ns")), "price": [1.0]})
    pq.write_table(table, f"{folder}/n.parquet", version="2.6")
    row = read_nano_parquet(spark, f"{folder}/n.parquet", ["trade_time"]).first()
    assert row["trade_time"] == dt.datetime(2024, 11, 3, 8, 30, 0, 42457) and row["trade_time_ns"] == ns


class FakeConf:
    def __init__(self, folder, master="yarn"):
        self.folder, self.master = folder, master
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_scratch_follows_the_session():
    assert scratch_dir(FakeConf("hdfs://shared/tmp/"), "x").startswith("hdfs://shared/tmp/x-")
    assert scratch_dir(FakeConf(None, "local[2]"), "x").startswith("/")
    with pytest.raises(RuntimeError):
        scratch_dir(FakeConf(None), "x")


@pytest.mark.parametrize("moved", [0, 1])
def test_an_interrupted_publish_is_finished_from_its_stage(spark, folder, monkeypatch, moved):
    base, root = f"{folder}/scratch", f"{folder}/lake"
    lake.write_bars_monthly(bar_rows(spark, [("123", "2024-01-01", 9.0, 0), ("OLD", "2024-03-01", 7.0, 1)]), root)
    monkeypatch.setattr(lake, "scratch_dir", lambda spark, label: f"{base}/{label}-1")
    move = lake._move_partitions

    def stop(spark, stage, active, depth):
        if moved:
            month = "year=2024/month=01"
            files, to = lake._path(spark, f"{active}/{month}")
            files.delete(to, True)
            files.rename(lake._path(spark, f"{stage}/{month}")[1], to)
        raise KeyboardInterrupt

    monkeypatch.setattr(lake, "_move_partitions", stop)
    with pytest.raises(KeyboardInterrupt):
        lake.upsert_bars(spark, root, bar_rows(spark, TWO_MONTHS))
    monkeypatch.setattr(lake, "_move_partitions", move)
    assert lake.resume_publishes(spark, base) == [root] and lake.resume_publishes(spark, base) == []
    assert closes(scan_bars_partitioned(spark, root)) == {**closes(bar_rows(spark, TWO_MONTHS)), ("OLD", "2024-03-01"): 7.0}
    assert not os.path.exists(f"{base}/upsert-1")


def test_backfill_moves_on_disk_and_may_be_repeated(spark, folder):
    rows = [("V", "I1", "2024-01-02 00:00:00", 1.0), ("V", "I1", "2024-02-02 00:00:00", 2.0), ("V", "I2", "2024-01-02 00:00:00", 3.0)]
    bars = spark.createDataFrame(rows, "feed_venue string, isin string, bar string, volume double").withColumn(
        "bar", F.col("bar").cast("timestamp_ntz"))
    kind = "isin string, ticker string, status string"
    nothing, known = spark.createDataFrame([], kind), spark.createDataFrame([("I1", "t1", "active")], kind)
    lake.write_ohlcv_dual(lake.map_isin_to_ticker(bars, nothing), folder)
    for rows_moved in (2, 0):
        counts = lake.backfill_moved(spark, folder, known)
        assert sum(r["rows"] for r in counts.collect()) == rows_moved
        tickers = lake.read_staged(spark, f"{folder}/by_ticker", lake.DUAL_PARTITIONS["by_ticker"])
        left = lake.read_staged(spark, f"{folder}/by_isin", lake.DUAL_PARTITIONS["by_isin"])
        assert sorted((r["ticker"], r["month"], r["volume"]) for r in tickers.collect()) == [("t1", "01", 1.0), ("t1", "02", 2.0)]
        assert [(r["isin"], r["volume"]) for r in left.collect()] == [("I2", 3.0)]
