"""Exact per-key ordered computation without one task per key.

A window over ``partitionBy(key).orderBy(time)`` puts a whole key in one task,
and one key may hold a third of the table. Here the work is cut two ways:

* by month chunk (``with_chunk``): a month of one-minute bars is at most 44,640
  rows. Running values are computed inside a chunk and completed with one
  carried value per chunk, scanned over the small chunk table (``with_carry``);
* by row block (``in_blocks``): rows get their position in the key from chunk
  row counts, positions cut the key into blocks of fixed length, and the rows
  before a block, its halo, are sent to it as well. Frames of n rows and means
  with fading memory are then complete inside the block, any number of them
  after one shuffle.

Each carry or numbering reads its input twice, the second time few columns. Give
it a stored table; a long derivation is better written out first.

Keys and the order column must be non-null and unique together, as bars are
once de-duplicated and checked against the write contract.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 50_000


def with_chunk(df: DataFrame, order: str, unit: str = "month") -> DataFrame:
    return df.withColumn("chunk", F.trunc(F.to_date(F.col(order)), unit))


def chunk_window(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys, "chunk").orderBy(order)


def earlier_chunks(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)


def later_chunks(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)


def _attach(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join; the table's key columns are renamed, so nothing is ambiguous."""
    renamed = table
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_k_{k}")
    condition = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    return df.join(renamed, condition, how).drop(*[f"_k_{k}" for k in keys])


def with_carry(
    df: DataFrame,
    keys: Sequence[str],
    summary: dict[str, Column],
    carried: dict[str, Column],
) -> DataFrame:
    """Attach per-chunk values that come from the other chunks of the key.

    ``summary`` aggregates one chunk; ``carried`` are window expressions over
    the chunk table (see ``earlier_chunks`` and ``later_chunks``).
    """
    keys = list(keys)
    table = (
        df.groupBy(*keys, "chunk")
        .agg(*[c.alias(n) for n, c in summary.items()])
        .select(*keys, "chunk", *[c.alias(n) for n, c in carried.items()])
    )
    return _attach(df, table, keys + ["chunk"])


def number_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add ``chunk`` and ``rn``, the zero-based position of the row in its key."""
    keys = list(keys)
    carried = with_carry(
        with_chunk(df, order), keys, {"_n": F.count(F.lit(1))},
        {"_before": F.coalesce(F.sum("_n").over(earlier_chunks(keys)), F.lit(0))},
    )
    return carried.withColumn(
        "rn", F.col("_before") + F.row_number().over(chunk_window(keys, order)) - 1
    ).drop("_before")


def _chunk_blocks(df: DataFrame, keys: Sequence[str], halo: int, block_rows: int, value: str) -> DataFrame:
    """A row per chunk: its block, the rows and values before it, and how far its block is looked back at.

    ``_end`` and ``_held`` count rows and values up to the end of the block;
    ``_far`` and ``_far_held`` are the last blocks before which fewer than
    ``halo`` rows, or values, have come since then.
    """
    key = Window.partitionBy(*keys)
    upto = key.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    later = key.orderBy("block").rangeBetween(1, Window.unboundedFollowing)
    inside = Window.partitionBy(*keys, "block")
    table = df.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("_n"), F.count(value).alias("_v"))
    table = table.withColumns({"_before": F.sum("_n").over(upto) - F.col("_n"), "_values": F.sum("_v").over(upto) - F.col("_v")})
    table = table.withColumn("block", F.floor(F.col("_before") / block_rows)).withColumns({
        "_end": F.max(F.col("_before") + F.col("_n")).over(inside),
        "_held": F.max(F.col("_values") + F.col("_v")).over(inside),
        "_next": F.min("block").over(later),
    })
    reach = {f: F.max("_next").over(key.orderBy(end).rangeBetween(Window.unboundedPreceding, halo - 1))
             for f, end in (("_far", "_end"), ("_far_held", "_held"))}
    return table.withColumns(reach).drop("_n", "_v", "_next")


def _in_value_blocks(df: DataFrame, keys: Sequence[str], order: str, halo: int, block_rows: int, value: str) -> DataFrame:
    keys = list(keys)
    chunked = with_chunk(df, order)
    window = chunk_window(keys, order)
    placed = _attach(chunked, _chunk_blocks(chunked, keys, halo, block_rows, value), keys + ["chunk"]).withColumns({
        "rn": F.col("_before") + F.row_number().over(window) - 1,
        "_place": F.col("_values") + F.count(value).over(window.rowsBetween(Window.unboundedPreceding, 0)) - 1,
    })
    last = F.greatest(
        "block",
        F.when(F.col("rn") >= F.col("_end") - halo, F.col("_far")),
        F.when(F.col(value).isNotNull() & (F.col("_place") >= F.col("_held") - halo), F.col("_far_held")),
    )
    return (
        placed.withColumn("_own", F.col("block"))
        .withColumn("block", F.explode(F.sequence("_own", last)))
        .withColumn("is_halo", F.col("block") > F.col("_own"))
        .drop("_own", "chunk", "_before", "_values", "_end", "_held", "_far", "_far_held", "_place")
    )


def in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    halo: int,
    block_rows: int = BLOCK_ROWS,
    value: str | None = None,
) -> DataFrame:
    """Add ``rn``, ``block`` and ``is_halo``; see ``block_window`` and ``without_blocks``.

    With a ``value``, a block is one or more whole chunks, and its halo is both the
    ``halo`` rows and the ``halo`` rows that have a value before it, from however
    many blocks back. A run of nulls of any length is then cut like any other
    rows, and a mean that looks at values only finds them behind it. Rows between
    those values may be absent from the block: distances are differences of ``rn``.
    """
    if halo > block_rows:
        raise ValueError("the halo has to fit in one block")
    if value is not None:
        return _in_value_blocks(df, keys, order, halo, block_rows, value)
    own = F.floor(F.col("rn") / block_rows)
    feeds_next = F.col("rn") % block_rows >= block_rows - halo
    targets = F.when(feeds_next, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        number_rows(df, keys, order)
        .withColumn("_own", own)
        .withColumn("block", F.explode(targets))
        .withColumn("is_halo", F.col("block") > F.col("_own"))
        .drop("_own", "chunk")
    )


def block_window(keys: Sequence[str]):
    return Window.partitionBy(*keys, "block").orderBy("rn")


def row_steps(keys: Sequence[str]) -> Column:
    """Rows from the row before it in the block to each row; 1 for the first."""
    return F.coalesce(F.col("rn") - F.lag("rn").over(block_window(keys)), F.lit(1))


def last_rows(keys: Sequence[str], n: int):
    """Frame of the current row and the n-1 before it."""
    return block_window(keys).rowsBetween(-(n - 1), 0)


def without_blocks(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_halo")).drop("rn", "block", "is_halo")


def memory_rows(decay: float) -> int:
    """Rows after which a value's weight is below e^-50 of the newest, far beyond double precision."""
    return math.ceil(-50 / math.log(decay))


def decayed_sums(
    b: DataFrame,
    keys: Sequence[str],
    terms: dict[str, tuple[float, Column]],
    step: Column | None = None,
    stretch: int | None = None,
) -> DataFrame:
    """Add y_t = a * y_(t-1) + x_t for each named (a, x), 0 < a < 1, to rows in blocks.

    The halo has to cover ``memory_rows(a)``. In a stretch of rows, y is a^i
    times the running sum of x_j / a^j, an ordinary window sum. A stretch ends
    before 1 / a^i leaves the range of a double and continues from the value the
    one before it ends with. ``step``, 1 if not given, is by how many powers of a
    a row decays what was before it; a row of step 0 must not add. ``x`` must not
    be null.
    """
    keys = list(keys)
    columns = b.columns
    so_far = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    out = b.withColumn("_p", F.sum(F.lit(1) if step is None else step).over(so_far))
    by_decay: dict[float, list[str]] = {}
    for name, (a, _) in terms.items():
        by_decay.setdefault(a, []).append(name)
    for n, (a, names) in enumerate(by_decay.items()):
        length = stretch or int(250 / -math.log10(a))
        part, i, decay = f"_part{n}", F.col(f"_i{n}"), F.lit(a)
        out = out.withColumn(part, F.greatest(F.floor((F.col("_p") - 1) / length), F.lit(0)))
        out = out.withColumn(f"_i{n}", F.col("_p") - F.col(part) * length)
        inside = Window.partitionBy(*keys, "block", part).orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
        before = Window.partitionBy(*keys, "block").orderBy(part).rangeBetween(-1, -1)
        out = out.withColumns({
            f"_s_{name}": F.pow(decay, i) * F.sum(F.pow(decay, -i) * terms[name][1]).over(inside) for name in names
        })
        # Steps above 1 may leave the end of a stretch without a row: its last value decays up to there.
        at_end = {name: F.col(f"_s_{name}") * F.pow(decay, F.lit(length) - i) for name in names}
        out = out.withColumns({
            name: F.col(f"_s_{name}")
            + F.pow(decay, i) * F.coalesce(F.max_by(at_end[name], "rn").over(before), F.lit(0.0))
            for name in names
        })
    return out.select(*columns, *terms)


STRETCH = 256


def recurrence(b: DataFrame, keys: Sequence[str], gain: Column, x: Column, start: Column, name: str) -> DataFrame:
    """Add y_t = y_(t-1) + gain_t * (x_t - y_(t-1)) to rows in blocks, one row after the other.

    ``start``, where it is not null, is y itself; the first row of a block needs
    one. The steps are those of a recursion over rows, so doubles come out bit by
    bit as it gives them. A scan of composed maps would end in other last bits,
    and rounding shows them where a value lies on a half. A block is
    folded as one array, in stretches, since a step copies what the fold holds. A null makes y null up to the next start.
    """
    keys = [*keys, "block"]
    rest = [c for c in b.columns if c not in (*keys, "rn")]
    steps = b.select(*keys, F.struct("rn", gain.cast("double").alias("_gain"), x.cast("double").alias("_x"),
                                     start.cast("double").alias("_start"), *rest).alias("_row"))
    blocks = steps.groupBy(*keys).agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    none = F.array().cast("array<double>")

    def step(kept: Column, row: Column) -> Column:
        y = F.coalesce(row["_start"], kept["y"] + row["_gain"] * (row["_x"] - kept["y"]))
        return F.struct(y.alias("y"), F.concat(kept["found"], F.array(y)).alias("found"))

    def stretch(kept: Column, i: Column) -> Column:
        last = kept["last"]
        begin = F.struct(last["y"].alias("y"), none.alias("found"))
        rows = F.slice("_rows", i * STRETCH + 1, F.lit(STRETCH))
        return F.struct(F.aggregate(rows, begin, step).alias("last"), F.concat(kept["before"], F.array(last["found"])).alias("before"))

    nothing = F.struct(F.struct(F.lit(None).cast("double").alias("y"), none.alias("found")).alias("last"),
                       F.array().cast("array<array<double>>").alias("before"))
    stretches = F.sequence(F.lit(0), F.floor((F.size("_rows") - 1) / STRETCH).cast("int"))
    found = F.aggregate(stretches, nothing, stretch, lambda kept: F.flatten(F.concat(kept["before"], F.array(kept["last"]["found"]))))
    rows = blocks.select(*keys, F.explode(F.arrays_zip("_rows", found.alias("_y"))).alias("_at"))
    return rows.select(*[F.col(c) if c in keys else F.col(f"_at._rows.{c}") for c in b.columns], F.col("_at._y").alias(name))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Interpolated median per key, exact for keys of any size.

    The built-in percentile holds every distinct value of a key in one task.
    Here values are first counted (combined on the map side), then ranked inside
    narrow value bands; band totals, a small table, give each band its offset.
    Values must not be negative.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    # ln is monotone, so bands are ordered like their values; zero comes first.
    band = F.when(F.col("_v") > 0, F.floor(F.ln("_v") * 64)).otherwise(-(1 << 20)).cast("int")
    counts = (
        df.filter(v.isNotNull())
        .groupBy(*keys, v.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_band", band)
    )
    by_band = counts.groupBy(*keys, "_band").agg(F.sum("_n").alias("_bn"))
    over_key = Window.partitionBy(*keys)
    bands = by_band.select(
        *keys, "_band",
        (F.sum("_bn").over(over_key.orderBy("_band")) - F.col("_bn")).alias("_before"),
        F.sum("_bn").over(over_key).alias("_total"),
        F.sum("_bn").over(over_key.orderBy("_band")).alias("_after"),
    ).filter(
        # only bands that hold a middle position are ranked
        (F.col("_before") < F.floor((F.col("_total") + 2) / 2))
        & (F.col("_after") >= F.floor((F.col("_total") + 1) / 2))
    )
    in_band = Window.partitionBy(*keys, "_band").orderBy("_v")
    ranked = _attach(counts, bands, keys + ["_band"], "inner").withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(in_band)
    )
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor((F.col("_total") + 2) / 2)
    start = F.col("_upto") - F.col("_n")
    picked = ranked.groupBy(*keys).agg(
        F.max(F.when((start < low) & (low <= F.col("_upto")), F.col("_v"))).alias("_lo"),
        F.max(F.when((start < high) & (high <= F.col("_upto")), F.col("_v"))).alias("_hi"),
    )
    return picked.select(*keys, ((F.col("_lo") + F.col("_hi")) / 2).alias(name))

