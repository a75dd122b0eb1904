"""Keys of more digits than the names of the views are padded to."""

import duckdb
from pyspark.sql import functions as F

from barlake.plans import views
from barlake.plans.catalog import all_queries


def test_padded_equals_printf(spark):
    keys = [None, 0, 7, 999_999, 1_000_000, 12_345_678, -3]
    found = spark.createDataFrame([(k,) for k in keys], "k long").select(views.padded("P", "k", 6).alias("stock"))
    expected = [duckdb.execute("SELECT printf('P%06d', ?::BIGINT)", [k]).fetchone()[0] for k in keys]
    assert [r["stock"] for r in found.collect()] == expected


def test_parts_of_seven_digits_are_instruments_of_their_own(spark, folder):
    """1000000 and 100000 were one stock when names were cut at six digits."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").filter("l_partkey < 20")
    wide = lines.withColumn("l_partkey", F.when(F.col("l_partkey") < 10, F.col("l_partkey") + 100_000).otherwise(
        (F.col("l_partkey") - 10) * 10 + 1_000_000))
    wide.write.parquet(f"{folder}/lineitem.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    for name in ("normalize_bars", "merge_bars", "hma"):
        query = all_queries()[name]
        result = query.run(spark, folder)
        cursor = connection.execute(query.oracle)
        order = [c[0] for c in cursor.description]
        assert sorted(map(tuple, result.select(*order).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_queries_of_bars_equal_their_sql_on_parts_of_seven_digits(spark, folder):
    names = ("anomaly_filter", "ewma_baseline", "foreach_batch_upsert", "frame_checksum", "hma_baseline", "migrate_interval",
             "migrated_bars", "migration_totals", "movers", "multiset_difference", "market_volatility")
    small = "/root/testdata/sf0.001"
    wide = F.when(F.col("key") % 2 == 0, F.col("key") + 100_000).otherwise((F.col("key") - 1) * 10 + 1_000_000)
    keys = {"lineitem": "l_partkey", "part": "p_partkey"}
    connection = duckdb.connect()
    for name, key in keys.items():
        rows = spark.read.parquet(f"{small}/{name}.parquet").filter(F.col(key) < 20).withColumn("key", F.col(key))
        rows.withColumn(key, wide).drop("key").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    for name in names:
        query = all_queries()[name]
        data = folder
        if name == "foreach_batch_upsert":  # a stream reads files and not folders of them
            data = f"{folder}/files"
            spark.read.parquet(f"{folder}/lineitem.parquet").toPandas().astype({"l_shipdate": "datetime64[us]"}).to_parquet(
                _made(data) + "/lineitem.parquet", coerce_timestamps="us")
        result = query.run(spark, data)
        cursor = connection.execute(query.oracle)
        order = [c[0] for c in cursor.description]
        assert sorted(map(tuple, result.select(*order).collect()), key=repr) == sorted(cursor.fetchall(), key=repr), name


def _made(folder):
    from pathlib import Path

    Path(folder).mkdir(exist_ok=True)
    return folder
