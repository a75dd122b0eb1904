"""Keep-last de-duplication by aggregation.

``max`` of one struct, order first, combines on the map side, so a key with very
many copies never has to sit in one task as it would under ``row_number``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schemas import BAR_KEY


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the greatest order struct (nulls sort lowest)."""
    keys = list(keys)
    named = {f"o{i}": c for i, c in enumerate(order)}
    plain = {repr(F.col(c)): c for c in df.columns}
    # a column that is itself part of the order is not carried twice
    carried = {plain[repr(c)]: o for o, c in named.items() if repr(c) in plain}
    rest = [c for c in df.columns if c not in keys and c not in carried]
    row = F.max(F.struct(*[c.alias(o) for o, c in named.items()], *rest)).alias("_row")
    values = {c: F.col("_row")[carried.get(c, c)] for c in df.columns if c not in keys}
    return df.groupBy(*keys).agg(row).select(*[values.get(c, F.col(c)).alias(c) for c in df.columns])


def dedupe_bars(df: DataFrame, arrival: Sequence[str] = ()) -> DataFrame:
    """Latest version of each (stock, date).

    A row without a sequence replaces any numbered one, then the higher
    sequence wins, then the later arrival (``batch_rank`` when present, then the
    ``arrival`` columns). Remaining columns settle exact ties, so the result
    does not depend on how rows are spread over tasks.
    """
    order = [F.col("sequence").isNull(), F.col("sequence")]
    if "batch_rank" in df.columns:
        order.append(F.col("batch_rank"))
    order += [F.col(c) for c in arrival]
    settled = {"sequence", "batch_rank", *BAR_KEY, *arrival}
    order += [F.col(c) for c in df.columns if c not in settled]
    return keep_last(df, BAR_KEY, order)


def dedupe_log(df: DataFrame) -> DataFrame:
    """Latest log row per (venue, date, timestamp)."""
    return keep_last(
        df,
        ["venue", "date", "timestamp"],
        [F.col("downloaded_at"), F.col("trade_count"), F.col("has_data")],
    )


def trade_key() -> Column:
    """Transaction id, else a digest of time, price, volume and instrument."""
    fallback = F.sha2(
        F.to_json(F.struct("trade_time", "price", "volume", "isin")), 256
    )
    return F.coalesce(F.concat(F.lit("t:"), F.col("trans_id")), F.concat(F.lit("h:"), fallback))


def dedupe_trades(df: DataFrame) -> DataFrame:
    """One row per trade. The first delivery stays; later copies are dropped."""
    keyed = df.withColumn("_key", trade_key())
    rank = -F.col("batch_rank") if "batch_rank" in df.columns else F.lit(0)
    others = [F.col(c) for c in df.columns if c != "batch_rank"]
    return keep_last(keyed, ["_key"], [rank, *others]).drop("_key")
