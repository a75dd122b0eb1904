"""Ledgers of checksums and bitmaps of days: what is known is not read again, and results are those of a full read."""

from pyspark.sql import functions as F

from barlake.operators import audit, distinct, ledger
from barlake.operators.lake import upsert_bars, write_bars_monthly, write_partitioned
from barlake.sources.bars import scan_partitions
from tests.test_fixtures import bar_rows
from tests.test_plans import plan_of

ROWS = [(s, f"2024-{m:02d}-0{d}", float(m + d), m) for s in ("A", "B") for m in range(1, 7) for d in (1, 2)]


def test_a_second_check_reads_changed_files_only(spark, folder):
    stored, known = f"{folder}/stored", f"{folder}/ledger"
    flat = bar_rows(spark, ROWS)
    write_bars_monthly(flat, stored)
    first = ledger.refresh_ledger(spark, stored, known)
    assert first.agg(F.sum("rows")).first()[0] == len(ROWS)
    assert ledger.unread_files(spark, stored, known).count() == 0
    before = {r["file"] for r in first.collect()}
    upsert_bars(spark, stored, bar_rows(spark, [("A", "2024-03-01", 99.0, 50)]))
    unread = [r["file"] for r in ledger.unread_files(spark, stored, known).collect()]
    assert unread and all("month=03" in f for f in unread) and not before & set(unread)
    bars = spark.read.schema(flat.schema).option("recursiveFileLookup", "true").parquet(stored)
    assert scanned_rows(bars.filter(F.col("_metadata.file_path").isin(unread))) == 4
    after = ledger.refresh_ledger(spark, stored, known)
    assert after.agg(F.sum("rows")).first()[0] == len(ROWS)
    kept = {r["file"] for r in after.collect()}
    assert kept == {f for f in before if "month=03" not in f} | set(unread)
    whole = ledger.file_checksums(bars)
    assert audit.multiset_difference(after, whole.select(*after.columns)).count() == 0


def test_verdicts_are_those_of_a_full_read_and_months_are_named(spark, folder):
    flat = bar_rows(spark, ROWS + [("A", None, 1.0, 1)])
    flat.write.parquet(f"{folder}/flat")
    changed = [r if r[:2] != ("B", "2024-04-02") else ("B", "2024-04-02", 77.0, 4) for r in ROWS if r[:2] != ("A", "2024-02-01")]
    write_bars_monthly(bar_rows(spark, changed + [("C", "2024-01-01", 5.0, 1)]), f"{folder}/stored")
    sides = [ledger.refresh_ledger(spark, f"{folder}/{s}", f"{folder}/ledger_{s}") for s in ("flat", "stored")]
    full = audit.verify_copies(flat, scan_partitions(spark, f"{folder}/stored"))
    assert sorted(ledger.verify_ledgers(*sides).collect()) == sorted(full.collect())
    got = {(r["stock"], str(r["month"]), r["verdict"]) for r in ledger.differing_months(*sides).collect()}
    assert got == {("A", "2024-02-01", "row_count_mismatch"), ("A", "None", "row_count_mismatch"),
                   ("B", "2024-04-01", "checksum_mismatch"), ("C", "2024-01-01", "row_count_mismatch")}


def test_absent_and_removed_files(spark, folder):
    assert ledger.refresh_ledger(spark, f"{folder}/none", f"{folder}/l0").count() == 0
    write_bars_monthly(bar_rows(spark, ROWS), f"{folder}/s")
    ledger.refresh_ledger(spark, f"{folder}/s", f"{folder}/l")
    left = ledger.refresh_ledger(spark, f"{folder}/s/year=2024/month=05", f"{folder}/l")
    assert {str(r["month"]) for r in left.collect()} == {"2024-05-01"}


def test_numbers_stay_and_bitmaps_cross_buckets(spark, folder):
    values = spark.range(70_000).select(F.concat(F.lit("v"), "id").alias("v"))
    first = {r["value"]: r["number"] for r in distinct.number_values(spark, values.limit(40_000), folder).collect()}
    both = distinct.number_values(spark, values.unionByName(spark.createDataFrame([(None,)], "v string")), folder)
    numbers = {r["value"]: r["number"] for r in both.collect()}
    assert sorted(numbers.values()) == list(range(1, 70_001)) and first.items() <= numbers.items()
    days = both.withColumn("d", F.col("number") % 3).unionByName(both.limit(500).withColumn("d", F.lit(0)))
    maps = distinct.bitmaps(days, ["d"], F.col("number"))
    want = {r["d"]: r["n"] for r in days.groupBy("d").agg(F.count_distinct("number").alias("n")).collect()}
    assert {r["d"]: r["n"] for r in distinct.count_bitmaps(maps, ["d"], "n").collect()} == want
    merged = distinct.merge_bitmaps(maps.withColumn("all", F.lit(1)), ["all"])
    assert merged.count() == 3 and distinct.count_bitmaps(merged, ["all"], "n").first()["n"] == 70_000


def test_periods_come_from_stored_days_alone(spark, folder):
    trades = spark.createDataFrame(
        [("2024-01-31 09:00:10", "A"), ("2024-01-31 09:00:50", "B"), ("2024-02-01 09:00:00", "A"), ("2024-02-05 10:00:00", "C"),
         ("2024-02-07 23:59:59", "A"), ("2024-02-07 00:00:00", None)], "trade_time string, isin string",
    ).withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))
    numbers = distinct.number_values(spark, trades.select("isin"), f"{folder}/numbers")
    distinct.trade_day_bitmaps(trades, numbers).write.parquet(f"{folder}/days")
    days = spark.read.parquet(f"{folder}/days")
    got = {str(r["period"]): tuple(r)[1:] for r in distinct.period_counts(days, "month").collect()}
    assert got == {"2024-01-01": (1, 2, 1), "2024-02-01": (3, 2, 4)}
    assert f"{folder}/numbers" not in plan_of(distinct.period_counts(days, "month"))
    trailing = {str(r["trade_date"]): r["trailing_isins"] for r in distinct.trailing_isins(days).collect()}
    assert trailing == {"2024-01-31": 2, "2024-02-01": 2, "2024-02-05": 3, "2024-02-07": 2}


def scanned_rows(df):
    """Rows that the file scan of a collected frame has put out."""
    df.collect()

    def leaves(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return leaves(node.executedPlan())
        children = node.children()
        return [node] if children.isEmpty() else [x for i in range(children.size()) for x in leaves(children.apply(i))]

    return sum(n.metrics().get("numOutputRows").get().value() for n in leaves(df._jdf.queryExecution().executedPlan()))


def test_a_lookup_skips_row_groups_without_the_value(spark, folder):
    rows = spark.range(0, 40_000, 1, 1).select(
        F.lit("2024").alias("year"), F.col("id").alias("trade_time"), F.sha2(F.col("id").cast("string"), 256).alias("isin"))
    wanted = rows.filter("trade_time = 31234").first()["isin"]
    read = {}
    for name, columns in (("plain", []), ("skipped", ["isin"])):
        write_partitioned(rows, f"{folder}/{name}", ["year"], ["trade_time"], block_bytes=1 << 17, bloom=columns)
        found = spark.read.parquet(f"{folder}/{name}").filter(F.col("isin") == wanted)
        read[name] = scanned_rows(found)
        assert [r["trade_time"] for r in found.collect()] == [31234]
    assert read["skipped"] * 5 < read["plain"]


def test_a_ticker_scan_of_a_month_skips_row_groups(spark, folder):
    bars = bar_rows(spark, [(f"T{i:04d}", f"2024-03-{d:02d}", float(i), d) for i in range(400) for d in range(1, 29)])
    write_bars_monthly(bars, folder, block_bytes=1 << 15)
    found = scan_partitions(spark, folder).filter(F.col("stock") == "T0123")
    assert scanned_rows(found) * 5 < bars.count() and found.count() == 28
