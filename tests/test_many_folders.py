"""Tables of a folder per instrument: the work is files, and must not end in one task."""

from pyspark.sql import functions as F

from barlake.operators import lake


def test_small_folders_are_written_by_many_tasks(spark, folder):
    """Adaptive execution put the few bytes of all folders in one task before."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = spark.range(64).select(F.format_string("XX%02d", "id").alias("isin"), F.col("id").alias("tick_id"),
                                      F.lit("2024-01-02 10:00:00").cast("timestamp_ntz").alias("trade_time"))
        lake.trades_by_isin_archive(rows, f"{folder}/isins")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    stored = lake.read_staged(spark, f"{folder}/isins", ["isin", "year", "month"])
    writer = F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1)
    assert stored.select(writer.alias("task")).distinct().count() > 4
    assert sorted(r["tick_id"] for r in stored.collect()) == list(range(64))


def test_publish_moves_new_branches_and_replaces_stored_folders(spark, folder):
    def write(place, rows):
        lake.write_partitioned(spark.createDataFrame(rows, "a string, b string, v int"), place, ["a", "b"], ["v"], many_folders=True)

    write(f"{folder}/active", [("x#1", "1", 1), ("x#1", "2", 2)])
    write(f"{folder}/stage", [("x#1", "2", 20), ("x#1", "3", 30), ("y", "1", 40), ("y", "2", 50)])
    lake.publish(spark, f"{folder}/stage", f"{folder}/active", ["a", "b"])
    found = sorted(map(tuple, lake.read_staged(spark, f"{folder}/active", ["a", "b"]).select("a", "b", "v").collect()))
    assert found == [("x#1", "1", 1), ("x#1", "2", 20), ("x#1", "3", 30), ("y", "1", 40), ("y", "2", 50)]
