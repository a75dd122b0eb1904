"""Streams with true lateness over several batches and restarts, against their batch twins."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barlake.operators.bars import local_day_bars, session_gaps
from barlake.operators.registry import apply_fetch_outcomes, is_eligible
from barlake.streaming import event_time as et
from barlake.streaming import trades as streams

TRADES = "isin string, trade_time string, price double, volume double, tick_id bigint, feed_venue string"


def land(df, folder, part):
    df.filter(part).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def trades_of(spark, seed, start, days, n, mark="2100-01-01 00:00:00"):
    """``n`` trades in the order of their time and a closing mark, the part they land in as a column."""
    rng = random.Random(seed)
    at = sorted(start + timedelta(seconds=rng.randrange(days * 86400)) for _ in range(n))
    rows = [(rng.choice("XY"), str(t), float(rng.randint(1, 90)), float(rng.randint(0, 3)), k, rng.choice("AB")) for k, t in enumerate(at)]
    rows.append(("mark", mark, 1.0, 1.0, n, "mark"))
    return spark.createDataFrame(rows, TRADES).withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz")).withColumn(
        "part", F.floor(F.col("tick_id") * 5 / (n + 1)))


def drained(stream, tmp_path, name, land_part, parts=range(5)):
    """All batches of a stream, each part landed and run on its own, so every one is a restart."""
    root, queries = str(tmp_path / name), []
    for part in parts:
        land_part(part)
        queries.append(streams.run_available(stream, str(tmp_path / f"{name}-checkpoint"), streams.bar_versions(stream.sparkSession, root)))
    return stream.sparkSession.read.parquet(root).drop("batch_id"), queries


@pytest.mark.parametrize("minutes", [30, 60])
def test_gaps_of_a_stream_equal_those_of_the_batch(spark, tmp_path, minutes):
    trades = trades_of(spark, minutes, datetime(2025, 3, 3), 4, 240)
    exact = spark.createDataFrame([("X", "2025-03-02 10:00:00", 1.0, 1.0, -2, "C"), ("X", f"2025-03-02 {10 + minutes // 60}:{minutes % 60:02d}:00", 1.0, 1.0, -1, "C")],
                                  TRADES).withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz")).withColumn("part", F.lit(0).cast("bigint"))
    trades = trades.unionByName(exact)  # a silence of exactly that length is none
    land(trades, str(tmp_path / "in"), "false")
    stream = et.stream_sessions(stream_of(spark, trades, str(tmp_path / "in")), minutes, "3 hours")
    sessions, queries = drained(stream, tmp_path, "sessions", lambda p: land(trades, str(tmp_path / "in"), f"part = {p}"))
    want = session_gaps(trades.filter("isin <> 'mark'"), minutes)
    order = ["feed_venue", "day", "gap_start", "gap_end", "gap_seconds"]
    got = sorted(map(tuple, et.gaps_between(sessions).select(order).collect()))
    assert got == sorted(map(tuple, want.select(order).collect())) and len(got) > 10
    assert sum(r["trade_count"] for r in sessions.collect()) == 242 and not any(map(et.late_count, queries))
    assert max(map(et.most_state, queries)) < sessions.count() / 2


@pytest.mark.parametrize("start", [datetime(2025, 10, 24), datetime(2025, 3, 28)])  # Berlin sets its clocks on the 26th and the 30th
def test_local_days_of_a_stream_equal_those_of_the_batch(spark, tmp_path, start):
    trades = trades_of(spark, 3, start, 5, 900)
    late = spark.createDataFrame([("X", str(start), 1.0, 1.0, -1, "A")], TRADES).withColumn(
        "trade_time", F.col("trade_time").cast("timestamp_ntz")).withColumn("part", F.lit(3).cast("bigint"))
    land(trades, str(tmp_path / "in"), "false")
    stream = et.stream_local_days(stream_of(spark, trades, str(tmp_path / "in")), "Europe/Berlin", lateness="3 hours")
    days, queries = drained(stream, tmp_path, "days", lambda p: land(trades.unionByName(late), str(tmp_path / "in"), f"part = {p}"))
    order = ["isin", "bar", "open", "high", "low", "close", "volume", "trade_count", "vwap"]
    want = local_day_bars(trades.filter("isin <> 'mark'"), "Europe/Berlin")
    rounded = lambda df: sorted((*r[:8], round(r[8], 9)) for r in df.select(order).collect())
    assert rounded(days) == rounded(want)
    assert sum(map(et.late_count, queries)) == 1  # and only that one
    hours = trades.select("isin", F.date_trunc("hour", "trade_time")).distinct().count()
    assert max(map(et.most_state, queries)) < hours / 3
    with pytest.raises(ValueError):
        et.stream_local_days(stream_of(spark, trades, str(tmp_path / "in")), "Europe/Berlin", lateness="1 hour")


def test_empty_files_are_logged_by_the_watermark(spark, tmp_path):
    name = lambda m: f"DETR-posttrade-2025-11-03T08_{m:02d}.json.gz"
    mark = "DETR-posttrade-2100-01-01T00_00.json.gz"
    listed = spark.createDataFrame([(name(m), m // 10) for m in range(40)] + [(mark, 3)], "file_name string, part bigint")
    trades = spark.createDataFrame([(name(m), m // 10, k) for m in range(40) if m % 3 for k in range(m)] + [(mark, 3, 0)],
                                   "file_name string, part bigint, tick_id bigint")
    roots = {n: str(tmp_path / n) for n in ("listed", "trades")}
    for part in range(4):
        for n, df in (("listed", listed), ("trades", trades)):
            land(df, roots[n], f"part = {part}")
        stream = et.stream_file_counts(stream_of(spark, listed, roots["listed"]), stream_of(spark, trades, roots["trades"]), "5 minutes")
        query = streams.run_available(stream, str(tmp_path / "checkpoint"), et.log_counts(spark, str(tmp_path / "log"), "2025-11-03 12:00:00"))
        assert et.late_count(query) == 0
    log = {r["timestamp"]: (r["trade_count"], r["has_data"]) for r in streams.read_log(spark, str(tmp_path / "log")).collect()}
    assert log == {f"2025-11-03T08_{m:02d}": (m if m % 3 else 0, m % 3 > 0) for m in range(40)}


def test_cool_downs_equal_the_batch_registry(spark, tmp_path):
    rng = random.Random(1)
    day = lambda n: str(datetime(2025, 1, 1) + timedelta(days=n))
    rows = sorted((n, t, i, rng.random() < 0.4) for t in "ABCDEFGH" for i in ("1d", "1h") for n in rng.sample(range(100), rng.randint(1, 4)))
    rows.append((100, "last", "1d", True))
    schema = "ticker string, interval string, found boolean, at string, part bigint"
    outcomes = spark.createDataFrame([(t, i, f, day(n), n // 26) for n, t, i, f in rows], schema).withColumn("at", F.col("at").cast("timestamp_ntz"))
    land(outcomes, str(tmp_path / "in"), "false")
    with et.timers(spark):
        stream = et.status_changes(stream_of(spark, outcomes, str(tmp_path / "in")))
        changes, queries = drained(stream, tmp_path, "changes", lambda p: land(outcomes, str(tmp_path / "in"), f"part = {p}"), range(4))
    # the batch registry, one day after another
    tickers = spark.createDataFrame([], "ticker string, added_date string, status string, last_checked string")
    from barlake.schemas import INTERVALS
    state: dict = {}
    for n, t, i, f in rows:
        state[t, i] = (f, n)
    one = spark.createDataFrame([], INTERVALS)
    _, after = apply_fetch_outcomes(tickers, one, spark.createDataFrame(
        [(t, i, f, day(n)[:10] if f else None) for (t, i), (f, n) in state.items()],
        "ticker string, interval string, found boolean, last_date string").withColumn("storage", F.lit(None).cast(INTERVALS["storage"].dataType)), day(100)[:10])
    dates = spark.createDataFrame([(t, i, day(n)[:10]) for (t, i), (_, n) in state.items()], "ticker string, interval string, day string")
    # may it be asked again on the last day: the day of the last outcome stands for that of the fetch
    asked = after.join(dates, ["ticker", "interval"]).select(
        "ticker", "interval", "status", is_eligible(F.lit("active"), F.lit(True), F.col("status"), F.col("day"), day(100)[:10]).alias("eligible"))
    want = {(r["ticker"], r["interval"]): "active" if r["status"] == "active" else "eligible" if r["eligible"] else "not_found" for r in asked.collect()}
    got = {(r["ticker"], r["interval"]): r["status"] for r in et.current_status(changes).collect()}
    assert got == want and {"active", "eligible", "not_found"} == set(got.values())
    # a cool-down that ended between two misses is told as well
    assert changes.count() == changes.distinct().count()
    ended = {(r["ticker"], r["interval"], str(r["at"])) for r in changes.filter("status = 'eligible'").collect()}
    for (t, i) in state:
        own = [(n, f) for n, a, b, f in rows if (a, b) == (t, i)]
        for (n, f), later in zip(own, [*own[1:], (10**6, None)]):
            assert ((t, i, day(n + 30)) in ended) == (not f and n + 30 <= min(later[0], 100))


def test_cool_downs_run_without_a_call_of_python_for_each_ticker(spark, tmp_path):
    """Repeated and untimely outcomes, one at the very end of a cool-down, and a found one in the same moment."""
    rows = [("A", "1d", False, "2025-01-01", 0), ("A", "1d", False, "2025-01-31", 0),  # the wait is over as the next miss comes
            ("B", "1d", False, "2025-01-10", 0), ("B", "1d", False, "2025-01-05", 1), ("B", "1d", False, "2025-01-10", 1),
            ("C", "1d", False, "2025-01-03", 0), ("C", "1d", True, "2025-01-03", 1),
            ("D", "1d", False, "2025-01-02", 0), ("D", "1d", True, "2025-01-20", 1),
            (None, None, None, "2025-05-01", 2)]
    schema = "ticker string, interval string, found boolean, at string, part int"
    outcomes = spark.createDataFrame(rows, schema).withColumn("at", F.col("at").cast("timestamp_ntz"))
    land(outcomes, str(tmp_path / "in"), "false")
    with et.timers(spark):
        stream = et.status_changes(stream_of(spark, outcomes, str(tmp_path / "in")), lateness="60 days")
        changes, queries = drained(stream, tmp_path, "changes", lambda p: land(outcomes, str(tmp_path / "in"), f"part = {p}"), range(3))
        plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "InPandas" not in plan
    assert not any(et.late_count(q) for q in queries)
    told = sorted((r["ticker"], str(r["at"])[:10], r["status"]) for r in changes.filter("ticker is not null").collect())
    assert told == [("A", "2025-01-01", "not_found"), ("A", "2025-01-31", "eligible"), ("A", "2025-01-31", "not_found"), ("A", "2025-03-02", "eligible"),
                    ("B", "2025-01-05", "not_found"), ("B", "2025-01-10", "not_found"), ("B", "2025-02-09", "eligible"),
                    ("C", "2025-01-03", "active"), ("C", "2025-01-03", "not_found"), ("D", "2025-01-02", "not_found"), ("D", "2025-01-20", "active")]
    last = {r["ticker"]: r["status"] for r in et.current_status(changes.filter("ticker is not null")).collect()}
    assert last == {"A": "eligible", "B": "eligible", "C": "active", "D": "active"}
