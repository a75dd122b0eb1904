"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

The words of all sources times ``share`` are dealt to the sources by weight. A
source is held at ``most`` times its own size, and what it cannot take is dealt
again to the others by weight until none is above. A source whose target is a
multiple of its size gives that many complete epochs first. The rest is drawn
without replacement: each document gets the key -ln(u) / quality, with u from a
digest of the seed and its id, keys are sorted within the source, and documents
are taken while the running sum of their sizes, with at least half of the
document, stays in the budget.

The running sum does not put a source in one task: a document belongs to the
chunk of its source that its key falls in (chunks of about ``CHUNK`` documents),
sums run inside chunks, and one more sum runs over the chunks of each source. The
draw moves ids and sizes only; texts move once, when documents are taken up.

Null or empty text has size 0 and is never short of budget: it is taken as often
as its source has begun epochs. The null source is a source, the last. Null,
not-positive or missing quality counts as 1. Rows with one id have one key; rows
equal in id and text are interchangeable, and of their qualities the largest
counts. Reruns give the same mix. An
empty table gives an empty mix. All columns of the documents are kept; those
named as result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.session import scratch_dir

CHUNK = 10_000
SMALL = 50_000  # sources whose targets are broadcast; with more, a source is small and the join is shuffled
RESULTS = ("size", "source_size", "target", "taken", "copies")


def text_size(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, tie: Column, seed: str) -> Column:
    """A number above 0 and below 1 from the digest of the seed and the id, or what a row without one has instead."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), tie.cast("string")))
    hexed = F.substring(F.md5(F.concat(F.lit(seed), name).cast("binary")), 1, 12)
    return (F.conv(hexed, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, n_docs, target) from one row per source with its size.

    Sources sorted by size over weight reach their limit in that order, so the
    first ones that a level would lift above it are held, and the level follows
    from what the others share: three sums over the sources, no loop.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*(F.lit(float(w)) for w in weights))
    ranked = (sizes.withColumn("_place", F.row_number().over(by_name))
              .withColumn("_weight", F.element_at(pattern, (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))))
    limit = F.col("source_size") * F.lit(float(most))
    by_ratio = Window.orderBy(limit / F.col("_weight"), "_place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / (
        F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    # The level that a source meets if all before it are held; the first that stays below its limit sets it for the rest.
    held = ranked.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("_weight") <= limit)
    final = F.min(F.when(F.col("_free"), F.struct(limit / F.col("_weight"), F.col("_place"), F.col("_level")))).over(whole)
    return held.withColumn("_final", final["_level"]).select(
        "source", "source_size", "n_docs",
        F.when(F.col("_final").isNull(), limit).otherwise(F.least(limit, F.col("_final") * F.col("_weight"))).alias("target"))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, tie, place, size): all that the draw needs of each row; texts stay where they are.

    ``tie`` is a hash of the text and ``place`` numbers the rows equal in id and text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64(F.col("text").cast("string")).alias("tie"),
                       text_size(F.col("text").cast("string")).alias("size"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "tie").orderBy("source")))


def draw(rows: DataFrame, quality: str | None = None, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
         most: float = 2.0, seed: str = "mix", chunk: int = CHUNK) -> DataFrame:
    """``rows`` (as from ``measured``, more columns may follow) with source_size, target, taken words and copies.

    ``quality`` names a column of positive weights.
    """
    weight = F.coalesce(F.when(F.col(quality) > 0, F.col(quality)), F.lit(1.0)).cast("double") if quality else F.lit(1.0)
    staged = scratch_dir(rows.sparkSession, "sizes")
    rows.withColumn("_key", -F.log(uniform(F.col("doc_id"), F.col("tie"), seed)) / weight).write.parquet(staged)
    sized = rows.sparkSession.read.parquet(staged)
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    stored = scratch_dir(rows.sparkSession, "sources")
    sums.write.parquet(stored)
    sums = rows.sparkSession.read.schema(sums.schema).parquet(stored)
    few = sums.limit(SMALL + 1).count() <= SMALL
    goals = (targets(sums, list(weights), share, most)
             .withColumn("_epochs", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)))
             .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
             .withColumn("_chunks", F.ceil(F.col("n_docs") / F.lit(chunk)))
             .select(F.col("source").alias("_source"), "source_size", "target", "_epochs", "_rest", "_chunks"))
    # exp(-key) falls as the key grows and is uniform for quality 1, so its complement deals even chunks.
    placed = (sized.join(F.broadcast(goals) if few else goals, sized["source"].eqNullSafe(goals["_source"]))
              .withColumn("_chunk", F.floor((1 - F.exp(-F.col("_key"))) * F.col("_chunks"))))
    inside = (Window.partitionBy("_source", "_chunk").orderBy("_key", "doc_id", "size", "tie", "place")
              .rowsBetween(Window.unboundedPreceding, -1))
    over = Window.partitionBy("_source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (placed.groupBy("_source", "_chunk").agg(F.sum("size").alias("_n"))
              .select(F.col("_source").alias("_s"), F.col("_chunk").alias("_c"),
                      F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_base")))
    summed = placed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    found = summed.join(chunks, summed["_source"].eqNullSafe(chunks["_s"]) & (summed["_chunk"] == chunks["_c"]))
    extra = (F.col("_base") + F.col("_inside") + F.col("size") / 2 <= F.col("_rest")) & (F.col("_rest") > 0)
    copies = F.col("_epochs") + F.when(extra, 1).otherwise(0)
    return (found.withColumn("copies", copies.cast("int")).withColumn("taken", (F.col("size") * copies).cast("long"))
            .select(*rows.columns, "source_size", "target", "taken", "copies"))


def taken_up(docs: DataFrame, drawn: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with what ``draw`` decided on each row: size, source_size, target, taken and copies, their names prefixed."""
    named = [prefix + c for c in RESULTS]
    kept = [c for c in docs.columns if c not in named]
    keyed = (docs.select(*(F.col(f"`{c}`") for c in kept), F.col("doc_id").cast("long").alias("_mix_doc"),
                         F.xxhash64(F.col("text").cast("string")).alias("_mix_tie"))
             .withColumn("_mix_place", F.row_number().over(Window.partitionBy("_mix_doc", "_mix_tie").orderBy("source"))))
    found = drawn.select(F.col("doc_id").alias("_mix_d"), F.col("tie").alias("_mix_t"), F.col("place").alias("_mix_p"),
                        *(F.col(c).alias(n) for c, n in zip(RESULTS, named)))
    same = F.col("_mix_doc").eqNullSafe(F.col("_mix_d")) & (F.col("_mix_tie") == F.col("_mix_t")) & (F.col("_mix_place") == F.col("_mix_p"))
    return keyed.join(found, same).select(*(F.col(f"`{c}`") for c in kept), *(f"`{n}`" for n in named))


def mix(docs: DataFrame, quality: str | None = None, **options) -> DataFrame:
    """``docs`` with size, source_size, target of the source, taken words and copies (0 or more); options as of ``draw``."""
    rows = measured(docs)
    if quality:
        known = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(F.col("text").cast("string")).alias("_tie"),
                            F.col(quality).alias("_quality")).groupBy("_doc", "_tie").agg(F.max("_quality").alias("_quality"))
        rows = rows.join(known, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tie") == F.col("_tie")), "left").drop("_doc", "_tie")
    return taken_up(docs, draw(rows, "_quality" if quality else None, **options))


def materialise(mixed: DataFrame, prefix: str = "") -> DataFrame:
    """Each document as often as the mix takes it, without the columns of the mix."""
    copies = F.col(f"`{prefix}copies`")
    return (mixed.filter(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .drop("_copy", *(prefix + c for c in RESULTS)))
