"""A delivery of late data is one batch, in however many files it lands."""

from barlake.plans import streams as plans
from barlake.plans.views import table
from barlake.streaming import trades as streams


def test_batches_do_not_grow_with_files(spark, tmp_path, monkeypatch):
    table(spark, "/root/testdata/sf0.001", "events").repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(plans.views, "trades", lambda spark, sf, made=plans.views.trades: made(spark, sf).repartition(3, "tick_id"))
    batches, made = [], streams.store_with_late

    def counted(*args, **options):
        sink = made(*args, **options)
        return lambda batch, batch_id: (batches.append(batch_id), sink(batch, batch_id))[1]

    monkeypatch.setattr(streams, "store_with_late", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bars = plans.late_data(spark, str(tmp_path))
        assert batches == [0, 1] and bars.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
