"""Streams against their batch twins, over several files and restarts."""

import gzip
import json

from pyspark.sql import functions as F

from barlake.operators.bars import ohlcv_from_trades
from barlake.operators.ingest import log_rows, missing_files
from barlake.operators.lake import TRADE_PARTITIONS, read_staged
from barlake.sources.trades import parse_trades, read_trade_lines
from barlake.streaming import trades as streams
from barlake.streaming import updates
from tests.test_fixtures import GOOD


def land(folder, minute, count, start=0):
    name = f"DETR-posttrade-2025-11-03T{minute}.json.gz"
    with gzip.open(f"{folder}/{name}", "wt") as f:
        for i in range(start, start + count):
            f.write(json.dumps({**GOOD, "transIdCode": f"T{i}", "tickId": i, "lastTrade": 10.0 + i,
                                "lastTradeTime": f"2025-11-03T08:{i % 60:02d}:00Z"}) + "\n")
    return name


def manifest(spark, *file_names):
    return spark.createDataFrame([("DETR", n) for n in file_names], "venue string, file_name string")


def test_files_are_stored_once_and_logged_even_when_empty(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    trades_root, log_root, checkpoint, failed = (str(tmp_path / n) for n in ("trades", "log", "checkpoint", "failed"))
    listed = [land(landing, "08_30", 5), land(landing, "08_31", 0), land(landing, "08_32", 4, start=3)]

    def run():
        at = "2025-11-03 12:00:00"
        sink = streams.store_and_log(spark, trades_root, log_root, at, failed)
        streams.run_available(streams.stream_lines(spark, str(landing), files_per_batch=1), checkpoint, sink)
        streams.log_empty_files(spark, log_root, manifest(spark, *listed), at, streams.read_failed(spark, failed))

    run()
    stored = read_staged(spark, trades_root, TRADE_PARTITIONS)
    assert stored.count() == 7 and {r["feed_venue"] for r in stored.collect()} == {"DETR"}   # two trades came twice
    log = {r["timestamp"][-5:]: (r["trade_count"], r["has_data"]) for r in streams.read_log(spark, log_root).collect()}
    assert log == {"08_30": (5, True), "08_31": (0, False), "08_32": (4, True)}
    listed.append(land(landing, "08_33", 2, start=20))
    run()
    assert read_staged(spark, trades_root, TRADE_PARTITIONS).count() == 9
    assert streams.read_log(spark, log_root).count() == 4


def test_damaged_files_are_rejected_whole_and_fetched_again(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    good, torn, half = land(landing, "08_30", 3), land(landing, "08_31", 2000, start=10), land(landing, "08_32", 2)
    raw = (landing / torn).read_bytes()
    (landing / torn).write_bytes(raw[: len(raw) // 2])
    with gzip.open(landing / half, "at") as f:
        f.write('{"isin": \n')
    trades_root, log_root, failed = (str(tmp_path / n) for n in ("trades", "log", "failed"))
    sink = streams.store_and_log(spark, trades_root, log_root, "2025-11-03 12:00:00", failed)
    streams.run_available(streams.stream_lines(spark, str(landing)), str(tmp_path / "checkpoint"), sink)
    listed = manifest(spark, good, torn, half, "odd-name.txt")
    streams.log_empty_files(spark, log_root, listed.filter("file_name <> 'odd-name.txt'"), "2025-11-03 12:00:00",
                            streams.read_failed(spark, failed))
    assert read_staged(spark, trades_root, TRADE_PARTITIONS).count() == 3
    lines = {r["file_name"]: r["n"] for r in streams.read_failed(spark, failed).groupBy("file_name").agg(F.count("*").alias("n")).collect()}
    assert lines == {torn: 1, half: 3}
    log = streams.read_log(spark, log_root)
    assert {r["file_name"] for r in missing_files(listed, log).collect()} == {torn, half, "odd-name.txt"}
    # a name that cannot be parsed is logged under itself, and is then done
    streams.log_empty_files(spark, log_root, listed.filter("file_name = 'odd-name.txt'"), "2025-11-03 13:00:00")
    assert {r["file_name"] for r in missing_files(listed, streams.read_log(spark, log_root)).collect()} == {torn, half}
    trades, report = parse_trades(read_trade_lines(spark, str(landing), skip_unreadable=True))
    assert trades.count() == 3
    assert {r["file_name"]: r["accepted"] for r in report.collect()} == {good: True, torn: False, half: False}


def test_the_last_delivery_of_a_file_counts(spark, tmp_path):
    root, name = str(tmp_path / "log"), "DETR-posttrade-2025-11-03T08_30.json.gz"
    for count, at in ((9, "2025-11-03 12:00:00"), (4, "2025-11-03 13:00:00")):
        counts = spark.createDataFrame([(name, count)], "file_name string, trade_count bigint")
        streams.merge_log(spark, root, log_rows(manifest(spark, name), counts, at))
    assert [r["trade_count"] for r in streams.read_log(spark, root).collect()] == [4]


def test_a_late_trade_keeps_the_trades_of_other_venues(spark, tmp_path):
    rows = [("X", "2025-11-03 09:10:00", 10.0, 1.0, 1, "1", "A"), ("X", "2025-11-03 09:20:00", 12.0, 1.0, 2, "2", "B"),
            ("X", "2025-11-03 12:00:00", 11.0, 1.0, 3, "3", "B"), ("X", "2025-11-03 09:30:00", 9.0, 1.0, 4, "4", "B")]
    schema = "isin string, trade_time string, price double, volume double, tick_id bigint, trans_id string, feed_venue string"
    trades = spark.createDataFrame(rows, schema).withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))
    landing = str(tmp_path / "landing")
    for part in ("tick_id < 4", "tick_id = 4"):
        trades.filter(part).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    stored, bars, late = (str(tmp_path / n) for n in ("trades", "bars", "late"))
    streams.run_available(stream, str(tmp_path / "c"), streams.store_with_late(spark, stored, bars, late, "1h"))
    assert [r["tick_id"] for r in streams.late_rows(spark, late).collect()] == [4]
    got = read_staged(spark, bars, streams.BAR_PARTITIONS).orderBy("bar").select("open", "low", "close", "trade_count")
    assert [tuple(r) for r in got.collect()] == [(10.0, 9.0, 9.0, 3), (11.0, 11.0, 11.0, 1)]


def test_stream_bars_equal_batch_bars_over_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(4):
        land(landing, f"08_3{k}", 30, start=k * 25)         # files overlap by five trades
    parsed = streams.stream_trades(spark, str(landing), files_per_batch=1)
    bars = streams.stream_ohlcv(streams.stream_dedupe(parsed), "1m", lateness="1 day")
    root = str(tmp_path / "bars")
    streams.run_available(bars, str(tmp_path / "checkpoint"), streams.bar_versions(spark, root), "append")
    # append emits a bar once the watermark passed it; update mode sees them all
    root = str(tmp_path / "updates")
    streams.run_available(
        streams.stream_ohlcv(streams.stream_trades(spark, str(landing), files_per_batch=1), "1m", lateness="1 day"),
        str(tmp_path / "checkpoint2"), streams.bar_versions(spark, root), "update")
    got = streams.latest_bars(spark, root)
    batch = ohlcv_from_trades(parse_trades(read_trade_lines(spark, str(landing)))[0], "1m")
    order = ["isin", "bar", "open", "high", "low", "close", "volume", "trade_count", "vwap"]
    assert sorted(map(tuple, got.select(order).collect())) == sorted(map(tuple, batch.select(order).collect()))


def test_live_state_is_independent_of_batches(spark, tmp_path):
    rows = [("A", "1d", True, "2025-01-01"), ("A", "1d", False, "2025-01-03"), ("A", "1h", False, "2025-01-02"),
            ("B", "1d", False, "2025-01-01"), ("B", "1d", True, "2025-01-02")]
    for n, part in enumerate((rows[:2], rows[2:4], rows[4:])):
        spark.createDataFrame(part, "ticker string, interval string, found boolean, at string").withColumn(
            "at", F.col("at").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    schema = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    root = str(tmp_path / "out")
    streams.run_available(updates.live_registry_state(stream), str(tmp_path / "c"), streams.bar_versions(spark, root), "update")
    last = updates.latest_state(spark, root)
    assert {r["ticker"]: (r["status"], r["intervals"]) for r in last.collect()} == {"A": ("not_found", 2), "B": ("active", 1)}
