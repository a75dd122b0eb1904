"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS the
runs of each query, of which the median counts. Each query runs to a sink that
takes every row and stores none. Bars are timed on the events repeated
``REPEATS`` times over several row groups as well, and ``fixed`` is what a query
over one row takes, so the cost of a job can be told from that of its rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barlake import build_session  # noqa: E402
from barlake.plans.catalog import all_queries  # noqa: E402

# query: the input rows it reads
HEADLINE = {
    "ohlcv_1m": "events",
    "ohlcv_1h": "events",
    "ohlcv_1d_berlin": "events",
    "ohlcv_rollup_1d_from_1h": "events",
    "ingest_trades_ndjson": "events",
    "dedupe_trades": "events",
    "trade_day_stats": "events",
    "map_isin_to_ticker": "events",
    "missing_files": "events",
    "seasonality_profile": "events",
    "dedupe_bars": "lineitem",
    "upsert_bars": "lineitem",
    "verify_copies": "lineitem",
    "log_returns": "lineitem",
    "ewma_baseline": "lineitem",
    "volume_zscore": "lineitem",
    "hma": "lineitem",
    "split_adjust": "lineitem",
    "apply_fetch_outcomes": "orders",
    "stream_ohlcv": "events",
}


# Read by the event queries only, ten times as many trades: they are shifted by whole days.
REPEATS = 10
REPEATED = ("ohlcv_1m", "ohlcv_1h", "ohlcv_1d_berlin")


LONG = 20.0


def timed(run, runs: int) -> float:
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
        if sum(seconds) > LONG:  # a long query varies less between runs
            break
    return round(median(seconds), 3)


def repeated_events(spark, folder: str) -> str:
    """A data folder whose events are those of ``folder`` again and again, in files for every core."""
    from pyspark.sql import functions as F

    target = tempfile.mkdtemp(prefix="spark-bench-", dir="/tmp")
    events = spark.read.parquet(f"{folder}/events.parquet")
    days = F.make_dt_interval(F.col("_n").cast("int") * 31)
    (events.crossJoin(F.broadcast(spark.range(REPEATS).withColumnRenamed("id", "_n"))).withColumn("ts", F.col("ts") + days)
     .drop("_n").repartition(spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(f"{target}/events.parquet"))
    return target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-bench-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = all_queries()
    wanted = sys.argv[1:] or list(HEADLINE)
    rows = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("events", "lineitem", "orders")}
    catalog["ohlcv_1h"].run(spark, folder).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {name: timed(lambda name=name: catalog[name].run(spark, folder), runs) for name in wanted}
    large = repeated_events(spark, folder)
    more = {n: timed(lambda n=n: catalog[n].run(spark, large), runs) for n in REPEATED if n in wanted}
    fixed = timed(lambda: spark.range(1).groupBy("id").count(), runs)
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": {
            n: round(rows[HEADLINE[n]] / s) for n, s in seconds.items() if n in HEADLINE
        },
        "repeated_events": {"rows": rows["events"] * REPEATS, "queries": more},
        "fixed": fixed,
        "runs": runs,
        "sf": folder.rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
