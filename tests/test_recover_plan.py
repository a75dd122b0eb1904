"""Rows of one large file stay spread over tasks when its sequence is recovered."""

from barlake.operators.normalize import recover_sequence


def test_rows_are_not_shuffled_by_file(spark):
    rows = spark.createDataFrame([("f", 1.0, "a"), ("f", 2.0, "b"), ("g", 1.5, "c")], "file_path string, index double, stock string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = recover_sequence(rows)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, found.select("stock", "sequence", "sequence_recovered").collect())) == [
            ("a", 1, True), ("b", 2, True), ("c", None, False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
