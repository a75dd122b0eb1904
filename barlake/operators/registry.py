"""Ticker lifecycle on two flat tables: ``tickers`` and ``intervals``.

Dates are YYYY-MM-DD text as in the state files; malformed text is allowed and
means "unknown". "Today" is always an argument.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.calendar import (
    business_days_between,
    clamp_fetch_window,
    full_history_period,
    try_date,
)
from barlake.schemas import INTERVALS, TICKERS

COOLDOWN_DAYS, RECENT_DAYS = 30, 90
STATUSES = ["active", "not_found"]


def last_data_date(column: str = "last_data_date") -> Column:
    return try_date(column)


def is_eligible(ticker_status: Column, interval_known: Column, interval_status: Column,
                last_not_found: Column, as_of: str) -> Column:
    """May this (ticker, interval) be asked for again?"""
    since = F.datediff(F.lit(as_of).cast("date"), try_date(last_not_found))
    return (
        F.when(F.coalesce(ticker_status == "not_found", F.lit(False)), F.lit(False))
        .when(~interval_known, F.lit(True))
        .when(~F.coalesce(interval_status == "not_found", F.lit(False)), F.lit(True))
        .otherwise(F.coalesce(since >= COOLDOWN_DAYS, F.lit(True)))
    )


def _interval_state(intervals: DataFrame) -> DataFrame:
    return intervals.select(
        "ticker", "interval",
        F.struct("status", "last_found_date", "last_data_date", "last_not_found_date",
                 "last_checked", "storage").alias("state"),
    )


def work_list(tickers: DataFrame, intervals: DataFrame, wanted: Sequence[str], as_of: str) -> DataFrame:
    """Active tickers by wanted interval, without those still cooling down.

    The wanted intervals are a short list, exploded per ticker.
    """
    active = tickers.filter(F.coalesce("status", F.lit("active")) == "active")
    asked = active.select(
        "ticker", F.col("status").alias("ticker_status"),
        F.explode(F.array(*[F.lit(i) for i in wanted])).alias("interval"),
    )
    joined = asked.join(_interval_state(intervals), ["ticker", "interval"], "left")
    keep = is_eligible(
        F.col("ticker_status"), F.col("state").isNotNull(), F.col("state.status"),
        F.col("state.last_not_found_date"), as_of,
    )
    return joined.filter(keep).select(
        "ticker", "interval", F.col("state.last_data_date").alias("last_data_date")
    )


def fetch_plan(work: DataFrame, as_of_ts: str, start: str | None = None) -> DataFrame:
    """Request window per work item: from the last data day, or the full history.

    ``should_fetch`` is false when no business day has passed since.
    """
    end = F.lit(as_of_ts).cast("timestamp_ntz")
    last = try_date("last_data_date").cast("timestamp_ntz")
    begin = F.lit(start).cast("timestamp_ntz") if start else F.when(last.isNotNull(), F.least(last, end))
    planned = work.withColumn("full_history", begin.isNull()).withColumn("_start", F.coalesce(begin, end))
    window = clamp_fetch_window(F.col("_start"), end, F.col("interval"), end)
    return planned.withColumn("window", window).select(
        "ticker", "interval", "full_history",
        F.when(F.col("full_history"), full_history_period(F.col("interval"))).alias("period"),
        F.when(~F.col("full_history"), F.col("window.start")).alias("start"),
        F.when(~F.col("full_history"), F.col("window.end")).alias("end"),
        (F.col("full_history") | (business_days_between(F.col("_start"), end) > 0)).alias("should_fetch"),
    )


def merge_symbol_list(tickers: DataFrame, fresh: DataFrame) -> DataFrame:
    """New symbols are added, known not-found ones become active, nothing is deleted."""
    new = fresh.select("ticker", F.struct(*TICKERS.names).alias("new"))
    joined = tickers.join(new, "ticker", "full_outer").withColumn(
        "_known", F.col("status").isNotNull() | F.col("added_date").isNotNull() | F.col("last_checked").isNotNull()
    )
    revived = F.col("new").isNotNull() & (F.col("status") == "not_found")
    return joined.select(
        "ticker",
        F.when(F.col("_known"), F.col("added_date")).otherwise(F.col("new.added_date")).alias("added_date"),
        F.when(~F.col("_known"), F.col("new.status")).when(revived, "active").otherwise(F.col("status")).alias("status"),
        F.when(F.col("_known"), F.col("last_checked")).otherwise(F.col("new.last_checked")).alias("last_checked"),
    )


def apply_fetch_outcomes(tickers: DataFrame, intervals: DataFrame, outcomes: DataFrame, as_of: str
                         ) -> tuple[DataFrame, DataFrame]:
    """Fold one batch of outcomes, one per (ticker, interval), into both tables.

    ``outcomes`` has ticker, interval, found, last_date (text) and storage.
    Any found interval makes the ticker active; otherwise it turns not_found
    when all of its intervals are.
    """
    result = outcomes.select(
        "ticker", "interval", F.struct("found", "last_date", "storage").alias("out")
    )
    joined = _interval_state(intervals).join(result, ["ticker", "interval"], "full_outer")
    touched, found = F.col("out").isNotNull(), F.coalesce(F.col("out.found"), F.lit(False))
    missed = touched & ~found
    new_intervals = joined.select(
        "ticker", "interval",
        F.when(found, "active").when(missed, "not_found").otherwise(F.col("state.status")).alias("status"),
        F.when(found, as_of).otherwise(F.col("state.last_found_date")).alias("last_found_date"),
        F.coalesce(F.when(found, F.col("out.last_date")), F.col("state.last_data_date")).alias("last_data_date"),
        F.when(missed, as_of).otherwise(F.col("state.last_not_found_date")).alias("last_not_found_date"),
        F.when(touched, as_of).otherwise(F.col("state.last_checked")).alias("last_checked"),
        F.coalesce(F.when(found, F.col("out.storage")), F.col("state.storage")).alias("storage"),
    ).select(*INTERVALS.names)
    verdicts = (
        joined.groupBy("ticker")
        .agg(
            F.bool_or(touched).alias("touched"),
            F.bool_or(found).alias("any_found"),
            F.bool_and(
                F.coalesce(
                    F.when(found, F.lit(False)).when(missed, F.lit(True)).otherwise(F.col("state.status") == "not_found"),
                    F.lit(False),
                )
            ).alias("all_missing"),
        )
        .filter("touched")
    )
    merged = tickers.join(verdicts, "ticker", "full_outer")
    is_touched = F.coalesce("touched", F.lit(False))
    status = (
        F.when(is_touched & F.col("any_found"), "active")
        .when(is_touched & F.col("all_missing"), "not_found")
        .otherwise(F.coalesce("status", F.lit("active")))
    )
    # a ticker first met here is created active today, before its outcome applies
    is_new = is_touched & F.col("status").isNull() & F.col("added_date").isNull() & F.col("last_checked").isNull()
    new_tickers = merged.select(
        "ticker",
        F.when(is_new, as_of).otherwise(F.col("added_date")).alias("added_date"),
        status.alias("status"),
        F.when(is_touched, as_of).otherwise(F.col("last_checked")).alias("last_checked"),
    )
    return new_tickers, new_intervals


def reactivate(tickers: DataFrame, intervals: DataFrame, as_of: str) -> DataFrame:
    """Not-found tickers with an active interval found within 90 days become active."""
    day = F.lit(as_of).cast("date")
    recent = (
        intervals.filter(
            (F.col("status") == "active") & (F.datediff(day, try_date("last_found_date")) <= RECENT_DAYS)
        )
        .select("ticker", F.lit(True).alias("_recent"))
        .distinct()
    )
    revive = (F.col("status") == "not_found") & F.coalesce("_recent", F.lit(False))
    return tickers.join(recent, "ticker", "left").select(
        "ticker",
        F.when(revive, F.coalesce("added_date", F.lit(as_of))).otherwise(F.col("added_date")).alias("added_date"),
        F.when(revive, "active").otherwise(F.col("status")).alias("status"),
        F.when(revive, as_of).otherwise(F.col("last_checked")).alias("last_checked"),
    )


def recheck_not_found(tickers: DataFrame, intervals: DataFrame, probes: DataFrame, as_of: str
                      ) -> tuple[DataFrame, DataFrame]:
    """Apply daily probes (ticker, found, last_date) of not-found tickers, then reactivate.

    A probe without data changes nothing but the ticker's last_checked.
    """
    lost = tickers.filter(F.col("status") == "not_found").select("ticker")
    asked = probes.join(lost, "ticker", "left_semi")
    hits = asked.filter("found").select(
        "ticker", F.lit("1d").alias("interval"), "found", "last_date",
        F.lit(None).cast(INTERVALS["storage"].dataType).alias("storage"),
    )
    seen = asked.select("ticker", F.lit(True).alias("_seen")).distinct()
    new_tickers, new_intervals = apply_fetch_outcomes(tickers, intervals, hits, as_of)
    checked = new_tickers.join(seen, "ticker", "left").select(
        "ticker", "added_date", "status",
        F.when(F.col("_seen"), as_of).otherwise(F.col("last_checked")).alias("last_checked"),
    )
    return reactivate(checked, new_intervals, as_of), new_intervals


def global_not_found(intervals: DataFrame) -> DataFrame:
    """Per ticker: are all of its intervals not_found?"""
    lost = F.coalesce(F.col("status") == "not_found", F.lit(False))
    return intervals.groupBy("ticker").agg(F.bool_and(lost).alias("not_found"))


def registry_counts(tickers: DataFrame, intervals: DataFrame) -> DataFrame:
    daily = intervals.filter((F.col("interval") == "1d") & (F.col("status") == "active")).select("ticker").distinct()
    marked = tickers.join(daily.withColumn("_daily", F.lit(True)), "ticker", "left")
    return marked.agg(
        F.count(F.lit(1)).alias("tickers"),
        F.count_if(F.coalesce("status", F.lit("active")) == "active").alias("active"),
        F.count_if(F.col("status") == "not_found").alias("not_found"),
        F.count_if(F.col("_daily")).alias("active_1d"),
    )


def registry_repair(tickers: DataFrame, intervals: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Fill a missing last_checked and add the 1d record a ticker lacks."""
    fixed = tickers.withColumn("last_checked", F.coalesce("last_checked", "added_date", F.lit(as_of)))
    daily = intervals.filter(F.col("interval") == "1d").select("ticker")
    lost = F.col("status") == "not_found"
    blank = F.lit(None).cast("string")
    added = fixed.join(daily, "ticker", "left_anti").select(
        "ticker", F.lit("1d").alias("interval"),
        F.when(lost, "not_found").otherwise("active").alias("status"),
        F.when(lost, blank).otherwise(as_of).alias("last_found_date"),
        F.when(lost, blank).otherwise(F.coalesce("added_date", F.lit(as_of))).alias("last_data_date"),
        F.when(lost, F.col("last_checked")).alias("last_not_found_date"),
        F.when(lost, F.col("last_checked")).otherwise(as_of).alias("last_checked"),
        F.lit(None).cast(INTERVALS["storage"].dataType).alias("storage"),
    )
    return fixed, intervals.unionByName(added)


def registry_unify(current: DataFrame, not_found: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """One registry from a current list and a not-found list; the latter wins.

    Current rows: ticker, added_date, last_checked. Not-found rows also carry
    last_date_found; with one, the seeded daily interval stays active.
    """
    def rows(df: DataFrame, rank: int, status: str, found: Column) -> DataFrame:
        return df.select(
            "ticker", F.lit(rank).alias("rank"), F.coalesce("added_date", F.lit(as_of)).alias("added_date"),
            F.lit(status).alias("status"), F.coalesce("last_checked", F.lit(as_of)).alias("last_checked"),
            found.alias("found"),
        )

    both = rows(current, 0, "active", F.lit(as_of)).unionByName(
        rows(not_found, 1, "not_found", F.nullif(F.col("last_date_found"), F.lit("")))
    )
    chosen = both.groupBy("ticker").agg(
        F.max_by(F.struct("added_date", "status", "last_checked", "found", "rank"),
                 F.struct("rank", "added_date", "last_checked", "found")).alias("r")
    ).select("ticker", "r.*")
    has, is_current = F.col("found").isNotNull(), F.col("rank") == 0
    daily = chosen.select(
        "ticker", F.lit("1d").alias("interval"),
        F.when(has, "active").otherwise("not_found").alias("status"),
        F.col("found").alias("last_found_date"),
        F.when(is_current, F.col("added_date")).otherwise(F.col("found")).alias("last_data_date"),
        F.when(~has, F.col("last_checked")).alias("last_not_found_date"),
        F.when(is_current, as_of).otherwise(F.col("last_checked")).alias("last_checked"),
        F.lit(None).cast(INTERVALS["storage"].dataType).alias("storage"),
    )
    return chosen.select(*TICKERS.names), daily


def latest_by_added_date(rows: DataFrame, latest: bool = False) -> DataFrame:
    """One row per ticker. The published tool keeps the oldest row; ``latest`` keeps the newest."""
    rest = F.struct(*[c for c in rows.columns if c != "ticker"])
    order = F.struct("added_date", rest)
    pick = F.max_by(rest, order) if latest else F.min_by(rest, order)
    return rows.groupBy("ticker").agg(pick.alias("r")).select("ticker", "r.*").select(*rows.columns)


def validate_registry(tickers: DataFrame, intervals: DataFrame) -> DataFrame:
    """(ticker, interval, rule), one row per broken rule."""
    def broken(df: DataFrame, interval: Column, rules: dict[str, Column]) -> DataFrame:
        names = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in rules.items()]))
        return df.select("ticker", interval.alias("interval"), F.explode(names).alias("rule"))

    known = F.col("status").isin(STATUSES)
    of_tickers = broken(tickers, F.lit(None).cast("string"), {
        "missing_ticker": F.col("ticker").isNull() | (F.col("ticker") == ""),
        "missing_added_date": F.col("added_date").isNull(),
        "missing_last_checked": F.col("last_checked").isNull(),
        "bad_status": F.col("status").isNull() | ~known,
    })
    active, lost = F.col("status") == "active", F.col("status") == "not_found"
    of_intervals = broken(intervals, F.col("interval"), {
        "bad_interval_status": F.col("status").isNull() | ~known,
        "missing_last_found_date": active & F.col("last_found_date").isNull(),
        "missing_last_not_found_date": lost & F.col("last_not_found_date").isNull(),
        "missing_interval_last_checked": (active | lost) & F.col("last_checked").isNull(),
    })
    return of_tickers.unionByName(of_intervals)


def registry_map_view(tickers: DataFrame, intervals: DataFrame) -> DataFrame:
    """The nested form of the registry: one row per ticker with a map of its intervals."""
    state = F.struct(*[c for c in INTERVALS.names if c not in ("ticker", "interval")])
    maps = intervals.groupBy("ticker").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("interval", state)))).alias("intervals")
    )
    return tickers.join(maps, "ticker", "left")


def resolve_layout(requests: DataFrame, overrides: DataFrame, default: bool) -> DataFrame:
    """Add ``partitioned``: the ticker's stored mode, else source, market and global setting.

    ``overrides`` has market, source (null for a market rule) and enabled.
    """
    by_source = overrides.filter(F.col("source").isNotNull()).select(
        F.col("market").alias("_m"), F.col("source").alias("_s"), F.col("enabled").alias("_by_source")
    )
    by_market = overrides.filter(F.col("source").isNull()).select(
        F.col("market").alias("_mm"), F.col("enabled").alias("_by_market")
    )
    joined = requests.join(
        by_source, (F.col("market") == F.col("_m")) & (F.col("source") == F.col("_s")), "left"
    ).join(by_market, F.col("market") == F.col("_mm"), "left")
    own = F.when(F.col("storage_mode").isNotNull(), F.col("storage_mode") == "partitioned")
    return joined.select(
        *requests.columns, F.coalesce(own, "_by_source", "_by_market", F.lit(default)).alias("partitioned")
    )


def backfill_storage_metadata(intervals: DataFrame, tickers: DataFrame, discovered: DataFrame, storage: Column
                              ) -> DataFrame:
    """Set the storage of (ticker, interval) pairs found on disk; ``changed`` tells which moved.

    Only tickers the registry knows are touched; an interval record is added
    when the ticker lacks it.
    """
    known = discovered.select("ticker", "interval").distinct().join(
        tickers.select("ticker"), "ticker", "left_semi"
    ).withColumn("_found", F.lit(True))
    joined = intervals.join(known, ["ticker", "interval"], "full_outer")
    target = F.when(F.col("_found"), storage).otherwise(F.col("storage"))
    return joined.withColumn("_new", target).select(
        *[c for c in INTERVALS.names if c != "storage"], F.col("_new").alias("storage"),
        (~F.col("_new").eqNullSafe(F.col("storage"))).alias("changed"),
    )
