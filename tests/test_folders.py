"""Many small folders on a local disk: written and read without a process or a step of the driver for each."""

import os

from pyspark.sql import functions as F

from barlake.operators import folders, lake
from barlake.sources.bars import discover_partitions

NAMES = ["x#1", "a b", "50%", "p+q", "k=v", "ü/ö", "%41", "", None, "plain"]


def processes():
    with open("/proc/stat") as stat:
        return next(int(line.split()[1]) for line in stat if line.startswith("processes"))


def test_folders_are_made_without_a_process_for_each(spark, folder):
    """The local file system of Hadoop started several for each folder before."""
    rows = spark.range(300).select(F.format_string("XX%03d", "id").alias("isin"), F.col("id").alias("tick_id"),
                                   F.lit("2024-01-02 10:00:00").cast("timestamp_ntz").alias("trade_time"))
    lake.trades_by_isin_archive(rows.limit(1), f"{folder}/warm")
    before = processes()
    lake.trades_by_isin_archive(rows, f"{folder}/isins")
    assert processes() - before < 900
    stored = lake.read_staged(spark, f"{folder}/isins", ["isin", "year", "month"], many_folders=True)
    assert sorted((r["isin"], r["month"], r["tick_id"]) for r in stored.collect()) == [(f"XX{i:03d}", "01", i) for i in range(300)]


def test_partition_values_are_named_and_read_as_spark_does(spark, folder):
    rows = spark.createDataFrame([(n, m, i) for i, n in enumerate(NAMES) for m in (1, 2)], "name string, m int, v int")
    lake.write_partitioned(rows, f"{folder}/ours", ["name", "m"], ["v"], many_folders=True)
    rows.write.partitionBy("name", "m").parquet(f"{folder}/sparks")
    expected = sorted(((n or None, str(m), i) for i, n in enumerate(NAMES) for m in (1, 2)), key=repr)
    for place in ("ours", "sparks"):
        for many in (True, False):
            stored = lake.read_staged(spark, f"{folder}/{place}", ["name", "m"], many_folders=many)
            assert sorted(map(tuple, stored.select("name", "m", "v").collect()), key=repr) == expected, (place, many)
    assert {f for f in os.listdir(f"{folder}/ours") if "=" in f} == {f for f in os.listdir(f"{folder}/sparks") if "=" in f}
    one = lake.read_staged(spark, f"{folder}/ours", ["name", "m"], many_folders=True).filter(F.col("name") == "x#1")
    assert sorted(r["v"] for r in one.collect()) == [0, 0]


def test_attempts_are_merged_and_what_failed_is_left_out(folder):
    for place, names in (("one", ["v=a/t=1/f1", "v=a/t=2/f1"]), ("two", ["v=a/t=2/f2", "v=b/t=1/f2"])):
        for name in names:
            os.makedirs(os.path.dirname(f"{folder}/{place}/{name}"), exist_ok=True)
            open(f"{folder}/{place}/{name}", "w").close()
        folders._merge(f"{folder}/{place}", f"{folder}/into" if os.path.exists(f"{folder}/into") else _made(f"{folder}/into"))
    found = sorted(os.path.relpath(os.path.join(d, f), f"{folder}/into") for d, _, fs in os.walk(f"{folder}/into") for f in fs)
    assert found == ["v=a/t=1/f1", "v=a/t=2/f1", "v=a/t=2/f2", "v=b/t=1/f2"]


def test_a_folder_of_more_rows_than_a_task_holds(spark, folder, monkeypatch):
    monkeypatch.setattr(folders, "HELD_BYTES", 1)
    sorted_rows = spark.range(30).select((F.col("id") % 3).cast("string").alias("k"), "id").repartition(1).sortWithinPartitions("k", "id")
    folders.write_folders(sorted_rows, f"{folder}/table", ["k"], "snappy")
    stored = spark.read.parquet(f"{folder}/table")
    assert sorted((r["k"], r["id"]) for r in stored.collect()) == sorted((str(i % 3), i) for i in range(30))


def test_tickers_are_the_names_of_folders(spark, folder):
    for name in ("ticker=BRK.B", "ticker=x%231", "ticker=a b", "_attempts"):
        os.makedirs(f"{folder}/root/{name}")
    assert {r["ticker"] for r in discover_partitions(spark, f"{folder}/root").collect()} == {"BRK.B", "x#1", "a b"}
    assert discover_partitions(spark, f"{folder}/none").count() == 0


def test_moved_folders_are_deleted_in_tasks(spark, folder):
    """Each was a call of the driver before."""
    names = ["x%231", "a b", "50%25", "plain"]
    for name in names:
        os.makedirs(f"{folder}/table/isin_part={name}/year=2024")
    uris = [spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/table/isin_part={n}").toUri().toString() for n in names[:3]]
    gone = spark.createDataFrame([(f"file://{u}",) for u in [*uris, f"{folder}/table/isin_part=none"]], "folder string").coalesce(1)
    folders.delete_folders(gone, "folder")
    assert os.listdir(f"{folder}/table") == ["isin_part=plain"]


def _made(path):
    os.makedirs(path)
    return path
