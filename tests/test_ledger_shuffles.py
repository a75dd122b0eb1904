"""What the check of copies by ledgers puts on disk."""

from pyspark.sql import functions as F

from barlake.operators import lake, ledger
from barlake.plans import quality
from barlake.schemas import BARS
from tests.test_fixtures import bar_rows
from tests.test_plans import plan_of


def test_a_present_file_is_looked_up_without_a_shuffle_of_the_ledger(spark, folder):
    """The ledger was grouped, joined by file and grouped again, with a shuffle for each."""
    rows = [(s, f"2024-{m:02d}-0{d}", 1.0, d) for s in "AB" for m in (1, 2, 3) for d in (1, 2)]
    lake.write_bars_monthly(bar_rows(spark, rows), f"{folder}/bars")
    found = ledger.refresh_ledger(spark, f"{folder}/bars", f"{folder}/known")
    plan = plan_of(found.groupBy("stock", "month").agg(F.sum("rows").alias("rows")))
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert sorted((r["stock"], r["rows"]) for r in found.collect()) == sorted((s, 2) for s in "AB" for _ in range(3))
    # a row that two runs wrote counts once, and a file that is gone does not count
    again = spark.read.parquet(f"{folder}/known").withColumn("file", F.lit("file:/gone"))
    again.unionByName(spark.read.parquet(f"{folder}/known")).write.parquet(f"{folder}/more")
    spark.read.parquet(f"{folder}/more").write.mode("append").parquet(f"{folder}/known")
    assert ledger.refresh_ledger(spark, f"{folder}/bars", f"{folder}/known").agg(F.sum("rows")).first()[0] == len(rows)


def test_the_copy_is_taken_from_stored_bars_and_groups_few_of_them(spark, folder):
    """All bars were made three times, and all of them shuffled by ticker for the first date of a tenth."""
    rows = [(s, f"2024-01-0{d}", 1.0, d) for s in ("P3", "P4") for d in (2, 3)]
    bar_rows(spark, rows).select(*BARS.names).write.parquet(f"{folder}/flat")
    copy = quality._perturbed(spark.read.schema(BARS).parquet(f"{folder}/flat"))
    plan = plan_of(copy)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 2
    assert sorted((r["stock"], r["date"].day) for r in copy.collect()) == [("P3", 1), ("P3", 3), ("P4", 2), ("P4", 3)]
