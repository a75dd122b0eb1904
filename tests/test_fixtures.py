"""Small fixtures for the rules of merging, parsing, calendars and the registry."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barlake import schemas
from barlake.functions import calendar, names
from barlake.operators import audit, bars, ingest, mapping, registry
from barlake.operators.dedupe import dedupe_bars, dedupe_trades
from barlake.operators.lake import merge_bars, write_contract_violations
from barlake.operators.normalize import normalize_bars, normalize_vendor_history, recover_sequence
from barlake.sources import trades as source

BAR = "stock string, date string, open double, high double, low double, close double, volume bigint, sequence bigint"


def bar_rows(spark, rows):
    """(stock, date, close, sequence)"""
    full = [(s, d, c, c, c, c, 10, q) for s, d, c, q in rows]
    return spark.createDataFrame(full, BAR).withColumn("date", F.col("date").cast("timestamp_ntz"))


def closes(df):
    return {(r["stock"], str(r["date"])[:10]): r["close"] for r in df.collect()}


@pytest.mark.parametrize("old, new, winner", [
    ((1.0, 1), (2.0, 2), 2.0),        # higher sequence
    ((1.0, 5), (2.0, 1), 1.0),        # an older version arrives late
    ((1.0, 3), (2.0, 3), 2.0),        # a tie goes to the new batch
    ((2.0, 3), (1.0, 3), 1.0),
    ((1.0, 9), (2.0, None), 2.0),     # fresh rows carry no sequence and win
    ((1.0, None), (2.0, 9), 1.0),
    ((2.0, None), (1.0, None), 1.0),
])
def test_version_order(spark, old, new, winner):
    a, b = (bar_rows(spark, [("A", "2024-01-01", *v)]) for v in (old, new))
    assert closes(merge_bars(a, b)) == {("A", "2024-01-01"): winner}


def test_empty_tables_have_the_schema(spark):
    for made, schema in ((schemas.empty_trades(spark), schemas.TRADES), (schemas.empty_bars(spark), schemas.BARS)):
        assert made.schema == schema and made.count() == 0


def test_merge_with_empty_sides(spark):
    rows = bar_rows(spark, [("A", "2024-01-01", 1.0, 1)])
    none = schemas.empty_bars(spark)
    assert merge_bars(none, none).count() == 0
    assert closes(merge_bars(rows, none)) == closes(merge_bars(none, rows)) == closes(rows)


def test_dedupe_does_not_depend_on_partitioning(spark):
    rows = bar_rows(spark, [("A", "2024-01-01", float(i % 7), None) for i in range(40)])
    assert {closes(dedupe_bars(rows.repartition(n)))[("A", "2024-01-01")] for n in (1, 3, 8)} == {6.0}


def test_normalize_coerces_and_completes(spark):
    raw = spark.createDataFrame(
        [("A", "2024-01-02", "1.5", "2.5", "x"), ("B", "bad", "n/a", "3.5", "y"), ("C", "2024-01-03", None, "-2.5", "z")],
        "stock string, date string, open string, volume string, extra string")
    out = normalize_bars(raw)
    assert out.columns == schemas.BARS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.BARS]
    got = {r["stock"]: r for r in out.collect()}
    assert got["A"]["open"] == 1.5 and got["A"]["volume"] == 2          # halves go to even
    assert got["B"]["date"] is None and got["B"]["open"] is None and got["B"]["volume"] == 4
    assert got["C"]["volume"] == -2 and got["C"]["close"] is None and got["C"]["sequence"] is None


def test_vendor_history_keeps_wall_clock(spark):
    raw = spark.createDataFrame([(1,)], "x int").select(
        F.lit("2024-07-01 13:30:00").cast("timestamp").alias("Date"),
        *[F.lit(1.0).alias(c) for c in ("Open", "High", "Low", "Close")], F.lit(5).alias("Volume"), F.lit(0).alias("Dividends"))
    row = normalize_vendor_history(raw, "AAPL", "America/New_York").first()
    assert row["date"] == dt.datetime(2024, 7, 1, 9, 30) and row["stock"] == "AAPL"
    assert normalize_vendor_history(raw.limit(0), "AAPL").columns == ["stock", "date", "open", "high", "low", "close", "volume"]


@pytest.mark.parametrize("values, recovered", [
    ([0, 1, 2], True), ([5.0, 7.0], True), ([0.5, 1.0], False), ([None, 1.0], False),
    ([1_700_000_000_000_000_000] * 2, False),
])
def test_index_promotion(spark, values, recovered):
    kind = "bigint" if all(isinstance(v, int) for v in values) else "double"
    df = spark.createDataFrame([(v, "f1") for v in values], f"index {kind}, file_path string")
    rows = recover_sequence(df).collect()
    assert {r["sequence_recovered"] for r in rows} == {recovered}
    want = [int(v) for v in values] if recovered else [None] * len(values)
    assert sorted((r["sequence"] for r in rows), key=str) == sorted(want, key=str)


def test_position_stands_in_for_a_missing_index(spark, folder):
    spark.range(3).select(F.col("id").alias("close")).coalesce(1).write.parquet(f"{folder}/x")
    df = spark.read.parquet(f"{folder}/x").select("close", "_metadata.file_path", "_metadata.row_index")
    assert [r["sequence"] for r in recover_sequence(df).orderBy("close").collect()] == [0, 1, 2]


def test_datetime_index_is_not_promoted(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "f")], "index timestamp, file_path string")
    assert recover_sequence(df).first()["sequence_recovered"] is False


# --- trades ---------------------------------------------------------------

GOOD = dict(isin="DE0007100000", lastTrade=56.2, lastQty=10, currency="EUR",
            lastTradeTime="2025-11-03T08:30:00.042457058Z", transIdCode="T1", tickId=7, mmtAlgoInd="H",
            executionVenueId="XETA", distributionDateTime="2025-11-03T09:30:01+01:00")


def lines(spark, *records, file="DETR-posttrade-2025-11-03T08_30.json.gz"):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame([(t, file) for t in texts], "value string, file_name string")


def test_trade_is_parsed(spark):
    trades, report = source.parse_trades(lines(spark, GOOD, "", "   "))
    row = trades.first()
    assert trades.columns == schemas.TRADES.names and trades.count() == 1
    assert row["trade_time"] == dt.datetime(2025, 11, 3, 8, 30, 0, 42457)
    assert row["distribution_time"] == dt.datetime(2025, 11, 3, 8, 30, 1)
    assert row["price"] == 56.2 and row["tick_id"] == 7 and row["algo_indicator"] is True
    assert row["exec_venue"] == "XETA" and row["benchmark_flag"] is None
    assert source.validate_trade_schema(trades) is trades
    assert report.first()["lines"] == 1


def test_malformed_line_fails_its_file_only(spark):
    both = lines(spark, GOOD, '{"isin": ').unionByName(lines(spark, GOOD, file="other"))
    trades, report = source.parse_trades(both)
    assert trades.count() == 1
    assert {r["file_name"]: r["accepted"] for r in report.collect()} == {
        "other": True, "DETR-posttrade-2025-11-03T08_30.json.gz": False}


def test_required_field_counts_per_file(spark):
    lacking = {k: v for k, v in GOOD.items() if k != "currency"}
    assert source.parse_trades(lines(spark, GOOD, lacking))[0].count() == 2
    trades, report = source.parse_trades(lines(spark, lacking))
    assert trades.count() == 0 and report.first()["missing_fields"] == "currency"
    sound, bad = source.parse_trades_by_row(lines(spark, GOOD, lacking, "{", {**GOOD, "lastTradeTime": "noon"}))
    assert sound.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["bad_time", "malformed", "missing_field"]


def test_bad_numbers_become_null(spark):
    row = source.parse_trades(lines(spark, {**GOOD, "lastTrade": "n/a", "tickId": "x", "mmtAlgoInd": None}))[0].first()
    assert row["price"] is None and row["tick_id"] is None and row["algo_indicator"] is False


def test_gzip_files_and_names(spark, folder):
    import gzip

    name = "DETR-posttrade-2025-11-03T08_30.json.gz"
    with gzip.open(f"{folder}/{name}", "wt") as f:
        f.write(json.dumps(GOOD) + "\n\n" + json.dumps({**GOOD, "transIdCode": "T2"}) + "\n")
    read = source.read_trade_lines(spark, folder)
    assert {r["file_name"] for r in read.collect()} == {name}
    assert source.parse_trades(read)[0].count() == 2


def test_trades_without_id_fall_back_to_their_values(spark):
    row = ("2025-01-01 10:00:00", 1.0, 2.0, "X")
    rows = [(*row, None), (*row, None), (*row[:3], "Y", None), (*row, "a"), (*row, "a")]
    df = spark.createDataFrame(rows, "trade_time string, price double, volume double, isin string, trans_id string").withColumn(
        "trade_time", F.col("trade_time").cast("timestamp_ntz"))
    assert dedupe_trades(df).count() == 3


def trade_rows(spark, rows):
    """(isin, time, tick, price, volume)"""
    return spark.createDataFrame(rows, "isin string, t string, tick_id bigint, price double, volume double").withColumn(
        "trade_time", F.col("t").cast("timestamp_ntz")).drop("t")


def test_bars_break_ties_by_tick_and_drop_empty_buckets(spark):
    t = "2025-01-02 10:00:00.000001"
    rows = [("A", t, 3, 30.0, 1.0), ("A", t, 1, 10.0, 1.0), ("A", t, 2, 20.0, 2.0), ("B", t, 1, 5.0, 0.0)]
    out = bars.ohlcv_from_trades(trade_rows(spark, rows), "1m").collect()
    assert len(out) == 1
    r = out[0]
    assert (r["open"], r["high"], r["low"], r["close"], r["volume"], r["trade_count"]) == (10.0, 30.0, 10.0, 30.0, 4.0, 3)
    assert r["vwap"] == 20.0


@pytest.mark.parametrize("utc, day", [
    ("2025-03-29 22:59:59", "2025-03-29"), ("2025-03-29 23:00:00", "2025-03-30"),   # winter side of the change
    ("2025-03-30 21:59:59", "2025-03-30"), ("2025-03-30 22:00:00", "2025-03-31"),   # a 23-hour day
    ("2025-10-25 22:00:00", "2025-10-26"), ("2025-10-26 22:59:59", "2025-10-26"),   # a 25-hour day
])
def test_local_days_across_clock_changes(spark, utc, day):
    out = bars.local_day_bars(trade_rows(spark, [("A", utc, 1, 1.0, 1.0)]), "Europe/Berlin")
    assert str(out.first()["bar"])[:10] == day


def test_unknown_source_and_interval(spark):
    with pytest.raises(ValueError):
        bars.source_to_price_volume(schemas.empty_bars(spark), "reuters")
    with pytest.raises(ValueError):
        bars.bucket_start("t", "3m")


# --- calendar -------------------------------------------------------------


def at(spark, ts, expression):
    df = spark.createDataFrame([(ts,)], "t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    return df.select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("hour, inside", [("23:00", True), ("01:00", True), ("03:00", False), ("02:00", True), ("21:59", False)])
def test_overnight_session(spark, hour, inside):
    check = calendar.is_within_hours("ts", "22:00", "02:00", "UTC")
    assert at(spark, f"2025-01-15 {hour}:00", check) is inside


@pytest.mark.parametrize("ts, is_open, until_open, until_close", [
    ("2025-01-15 12:00:00", False, 2.5 * 3600, 9 * 3600),     # 07:00 in New York
    ("2025-01-15 15:00:00", True, 0.0, 6 * 3600),
    ("2025-01-15 22:00:00", False, 16.5 * 3600, 0.0),         # after the close: tomorrow's open
])
def test_session_position(spark, ts, is_open, until_open, until_close):
    p = at(spark, ts, calendar.session_position("ts", "09:30", "16:00", "America/New_York"))
    assert (p["is_open"], p["seconds_until_open"], p["seconds_until_close"]) == (is_open, until_open, until_close)


def test_overnight_position_uses_yesterdays_window(spark):
    p = at(spark, "2025-01-16 01:00:00", calendar.session_position("ts", "22:00", "02:00", "UTC"))
    assert p["is_open"] and p["seconds_until_close"] == 3600


@pytest.mark.parametrize("text, result", [
    ("09:30-16:00", ("09:30", "16:00")), (" 8:05 - 17:00 ", ("08:05", "17:00")), ("25:00-26:00", (None, None)), ("x", (None, None)),
])
def test_active_hours(spark, text, result):
    v = spark.createDataFrame([(text,)], "t string").select(calendar.parse_active_hours("t").alias("v")).first()["v"]
    assert tuple(v) == result


@pytest.mark.parametrize("start, end", [
    ("2024-01-01", "2024-01-01"), ("2024-01-06", "2024-01-08"), ("2024-01-05", "2024-01-08"), ("2024-01-01", "2024-03-17"),
    ("2024-01-10", "2024-01-08"), ("2024-01-07", "2024-01-07"), ("2024-02-03", "2024-02-04"),
])
def test_business_days_by_counting(spark, start, end):
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    want = sum((s + dt.timedelta(i)).weekday() < 5 for i in range((e - s).days + 1)) - (s.weekday() < 5)
    got = at(spark, start, calendar.business_days_between("ts", F.lit(end).cast("timestamp_ntz")))
    assert got == want


@pytest.mark.parametrize("interval, start, end, want", [
    ("1h", "2020-01-01 00:00:00", "2025-06-01 00:00:00", ("2023-06-03 08:00:00", "2025-06-01 00:00:00")),
    ("60m", "2020-01-01 00:00:00", "2021-01-01 00:00:00", ("2025-06-01 17:00:00", "2025-06-01 17:00:00")),
    ("5m", "2025-05-01 10:00:00", "2025-06-01 00:00:00", ("2025-05-25 00:00:00", "2025-06-01 00:00:00")),
    ("5m", "2025-05-30 10:00:00", "2025-06-01 00:00:00", ("2025-05-30 10:00:00", "2025-06-01 00:00:00")),
    ("1d", "2001-01-01 00:00:00", "2025-06-01 00:00:00", ("2001-01-01 00:00:00", "2025-06-01 00:00:00")),
])
def test_fetch_window(spark, interval, start, end, want):
    ts = [F.lit(v).cast("timestamp_ntz") for v in (start, end, "2025-06-01 17:00:00")]
    w = at(spark, start, calendar.clamp_fetch_window(ts[0], ts[1], F.lit(interval), ts[2]))
    assert (str(w["start"]), str(w["end"])) == want


@pytest.mark.parametrize("name, venue, date", [
    ("DETR-posttrade-2025-11-03T08_30.json.gz", "DETR", "2025-11-03"),
    ("X-T1-posttrade-2025-11-03T08_30.json.gz", "X-T1", "2025-11-03"),
    ("DETR-posttrade-2025-11-03.json.gz", None, None), ("DETR-posttrade-2025-11-03Tab_cd.json.gz", None, None),
])
def test_file_names(spark, name, venue, date):
    p = spark.createDataFrame([(name,)], "n string").select(names.parse_trade_filename("n").alias("p")).first()["p"]
    assert (p and p["venue"], p and p["date"]) == (venue, date)


# --- registry ---------------------------------------------------------------

AS_OF = "2025-06-30"


def registry_of(spark, tickers, intervals):
    t = spark.createDataFrame([(k, "2024-01-01", s, "2025-01-01") for k, s in tickers], schemas.TICKERS)
    i = spark.createDataFrame([(*row, None) for row in intervals], schemas.INTERVALS)
    return t, i


def interval(ticker, name, status, found=None, data=None, lost=None):
    return (ticker, name, status, found, data, lost, "2025-01-01")


@pytest.mark.parametrize("lost, eligible", [
    ("2025-06-01", False), ("2025-05-31", True), ("2025-05-16", True), ("rubbish", True), (None, True),
])
def test_cooldown_boundary(spark, lost, eligible):
    t, i = registry_of(spark, [("A", "active")], [interval("A", "1d", "not_found", lost=lost)])
    assert (registry.work_list(t, i, ["1d"], AS_OF).count() == 1) is eligible


def test_work_list_asks_for_unknown_intervals_of_active_tickers(spark):
    t, i = registry_of(spark, [("A", "active"), ("B", "not_found")], [interval("A", "1d", "active", data="2025-06-01")])
    got = {(r["ticker"], r["interval"], r["last_data_date"]) for r in registry.work_list(t, i, ["1d", "1h"], AS_OF).collect()}
    assert got == {("A", "1d", "2025-06-01"), ("A", "1h", None)}


def outcomes(spark, *rows):
    schema = "ticker string, interval string, found boolean, last_date string"
    return spark.createDataFrame(rows, schema).withColumn("storage", F.lit(None).cast(schemas.STORAGE))


@pytest.mark.parametrize("rows, statuses", [
    ([("A", "1d", False, None)], {"A": "active"}),                                   # another interval still lives
    ([("A", "1d", False, None), ("A", "1h", False, None)], {"A": "not_found"}),
    ([("A", "1d", False, None), ("A", "1h", True, "2025-06-27")], {"A": "active"}),
    ([("N", "1d", False, None)], {"A": "active", "N": "not_found"}),                 # unknown ticker is created
    ([("N", "1d", True, None)], {"A": "active", "N": "active"}),
])
def test_outcomes(spark, rows, statuses):
    t, i = registry_of(spark, [("A", "active")], [interval("A", "1d", "active"), interval("A", "1h", "active", data="2025-06-01")])
    tickers, intervals = registry.apply_fetch_outcomes(t, i, outcomes(spark, *rows), AS_OF)
    assert {r["ticker"]: r["status"] for r in tickers.collect()} == statuses
    hour = {r["interval"]: r for r in intervals.filter("ticker = 'A'").collect()}["1h"]
    assert hour["last_data_date"] == ("2025-06-27" if ("A", "1h", True, "2025-06-27") in rows else "2025-06-01")


@pytest.mark.parametrize("found, status", [("2025-04-01", "active"), ("2025-03-31", "not_found"), ("bad", "not_found"), (None, "not_found")])
def test_reactivation_within_ninety_days(spark, found, status):
    t, i = registry_of(spark, [("A", "not_found")], [interval("A", "1d", "active", found=found)])
    assert registry.reactivate(t, i, AS_OF).first()["status"] == status


def test_layout_precedence(spark):
    requests = spark.createDataFrame([("us", "yahoo", None), ("us", "other", None), ("de", "x", None), ("us", "yahoo", "legacy")],
                                     "market string, source string, storage_mode string")
    rules = spark.createDataFrame([("us", "yahoo", True), ("us", None, False)], "market string, source string, enabled boolean")
    got = {(r["market"], r["source"], r["storage_mode"]): r["partitioned"] for r in registry.resolve_layout(requests, rules, True).collect()}
    assert got == {("us", "yahoo", None): True, ("us", "other", None): False, ("de", "x", None): True, ("us", "yahoo", "legacy"): False}


def test_unparsed_names_are_fetched_and_other_venues_match(spark):
    manifest = spark.createDataFrame([("DFRA", "DFRA-posttrade-2025-11-03T08_30.json.gz"), ("DFRA", "DFRA-posttrade-2025-11-03T08_31.json.gz"), ("DFRA", "notes.txt")], "venue string, file_name string")
    log = spark.createDataFrame([("DFRA", "2025-11-03", "2025-11-03T08_30", False, 0, None)], schemas.DOWNLOAD_LOG)
    assert {r["file_name"] for r in ingest.missing_files(manifest, log).collect()} == {"DFRA-posttrade-2025-11-03T08_31.json.gz", "notes.txt"}
    status = ingest.download_completeness(manifest, log).first()
    assert (status["status"], status["listed_files"], status["logged_files"]) == ("partial", 2, 1)


def test_mapping_merge_reactivates_and_reports_changes(spark):
    old = spark.createDataFrame([
        ("A" * 12, "aaa", "A", "EUR", "1", "inactive", dt.date(2020, 1, 1), dt.date(2024, 1, 1), "csv"),
        ("B" * 12, "bbb", "B", "EUR", "2", "active", dt.date(2020, 1, 1), dt.date(2025, 6, 20), "csv"),
    ], schemas.MAPPING)
    new = old.filter("ticker = 'aaa'").withColumn("ticker", F.lit("axx")).drop("first_seen")
    got = {r["isin"][0]: r for r in mapping.mapping_merge(old, new, AS_OF).collect()}
    assert (got["A"]["status"], got["A"]["ticker"], got["A"]["previous_ticker"]) == ("active", "axx", "aaa")
    assert got["A"]["first_seen"] == dt.date(2020, 1, 1) and got["B"]["status"] == "inactive"
    late = {r["isin"][0]: r["status"] for r in mapping.mapping_merge(old, new, AS_OF, stale_days=30).collect()}
    assert late["B"] == "active"


def test_contract_needs_its_location(spark):
    rows = bar_rows(spark, [("A", "2024-01-01", 1.0, 1), (None, "2024-01-01", 1.0, 1)])
    with pytest.raises(ValueError):
        write_contract_violations(rows, market="us", source="", dataset="stocks", interval="1d")
    found = write_contract_violations(rows, F.lit("A"), market="us", source="yahoo", dataset="stocks", interval="1d")
    assert [r["rule"] for r in found.collect()] == ["blank_ticker"]


def test_checksum_tells_swapped_nulls_apart(spark):
    a, b = (spark.createDataFrame([("k", *v)], "stock string, x int, y int") for v in ((None, 1), (1, None)))
    assert audit.frame_checksum(a).first()["checksum"] != audit.frame_checksum(b).first()["checksum"]
