"""Similarity join on word n-grams: prefix filter with rarest n-grams first, then length, positional and suffix filters.

A document's set holds the hashes of its distinct runs of ``SHINGLE`` words,
A-Z folded; a shorter text is one run, a text without words has an empty set
and is linked with nothing. Two sets link at a Jaccard similarity of
``percent`` / 100. Documents with equal sets are one entry from the start.

Order. A sketch of 2**SKETCH_BITS counters is filled with the sets of all
documents and never counts too little; sets are sorted by counter, then hash.
Any total order is right for a prefix filter, and this one puts the rare first.

Candidates. Sets that link share a member of their prefixes, n - ceil(t n) + 1
long. Entries go by prefix member once, members with one entry fall away, and
what is left is stored. First each entry is paired with the ``LEADERS`` foremost
entries of each of its members (those with the fewest own members before it, so
near the middle of a group of copies). Those pairs are verified, the links
joined to components, and then all pairs of one member whose components still
differ are verified too. So a group of near copies costs about one pair per
document, while no link between components can be missed: every pair that
shares a prefix member was either verified or is joined already. Each pair is
verified once, by sizes in stretches of the hash range (suffix filter) and then
by the exact intersection.

Members with very many entries are dealt in salted groups of about ``GROUP``;
their leaders are found again over all groups. Which they are is told by the
counter less what a counter holds on average, so a sketch that fills up with the
corpus still salts the frequent only; an unsalted member has at most twice
``GROUP`` entries more than a counter's share of all members. The second pairing
meets entries of near sizes only, by bands of size as part of the key. Where joins meet keys with many
rows, those keys are broadcast (a thousand at most). Sets are made again from
the text for entries with a candidate only, which a bitmap of fixed size picks
out before the shuffle; an exact join follows it.

Null text is empty. Rows equal in document id and text are one document. Null
ids are kept; a component's id is its smallest id that is not null. An empty
table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.skew import join_with_heavy_keys
from barlake.llm.text import SPACED, distinct_sorted, release_memory, row_words, shingle_hashes
from barlake.session import scratch_dir

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 20
BITMAP_BITS = 24
LEADERS = 2
GROUP = 20_000
_SKETCH_BLOCK = 1 << 14


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again."""
    spark, folder = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for _, words in row_words(column, SPACED):
        yield distinct_sorted(shingle_hashes(words, size))


def name_of(members: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def counter_of(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


ENTRY = "doc_id long, tie long, ent long, n long, block int, counts binary"


def _described(size: int):
    """A row per document with the name and size of its set, and per task its share of the sketch in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int32)
        for batch in batches:
            names, sizes = [], []
            for members in text_sets(batch.column("text"), size):
                names.append(name_of(members))
                sizes.append(len(members))
                np.add.at(sketch, counter_of(members), 1)
            n = len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["doc_id", "tie", "ent", "n", "block", "counts"])
        parts = [p.tobytes() for p in sketch.reshape(-1, _SKETCH_BLOCK)]
        n = len(parts)
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(n, pa.int64()) for _ in range(4)), pa.array(np.arange(n), pa.int32()), pa.array(parts, pa.binary())],
            names=["doc_id", "tie", "ent", "n", "block", "counts"])
        release_memory()

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
            part = np.frombuffer(counts.as_buffer(), np.int32)
            total[block] = total[block] + part if block in total else part.astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
        names=["block", "counts"])


def needed_overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection of sets of these sizes that reaches the similarity."""
    return -(-percent * (a + b) // (100 + percent))


def size_band(n, percent: int):
    """Bands of set sizes such that sizes that may link are in the same band or in neighbours."""
    width = max(math.log(100 / percent), 1e-6) * (1 + 1e-9)
    return F.floor(F.ln(n) / F.lit(width))


def _prefixes(size: int, percent: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sketch.value
        share = int(weights.mean())
        for batch in batches:
            names, sizes, prefixes, salts = [], [], [], []
            for members in text_sets(batch.column("text"), size):
                n = len(members)
                if not n:
                    continue
                weight = weights[counter_of(members)]
                first = np.argsort(weight, kind="stable")[: n + (-percent * n // 100) + 1]
                name = name_of(members)
                names.append(name)
                sizes.append(n)
                prefixes.append(members[first].view(np.int64))
                groups = np.maximum(weight[first] - share, 0) // GROUP
                salts.append(np.where(groups > 1, 1 + (name & 0x7FFFFFFF) % np.maximum(1, groups), 0).astype(np.int32))
            bounds = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))), pa.int32())
            flat = [np.concatenate(x) if x else np.empty(0, k) for x, k in ((prefixes, np.int64), (salts, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                 *(pa.ListArray.from_arrays(bounds, pa.array(x)) for x in flat)], names=["ent", "n", "prefix", "salts"])
        release_memory()

    return run


def _picked_sets(size: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            names, sets = [], []
            for members in text_sets(batch.column("text"), size):
                name = name_of(members)
                place = name & ((1 << BITMAP_BITS) - 1)
                if bits[place >> 6] >> np.uint64(place & 63) & np.uint64(1):
                    names.append(name)
                    sets.append(members.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["ent", "members"])
        release_memory()

    return run


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity.

    The suffix filter first: between the same bounds of the hash range the
    smaller count of members limits what both can share.
    """
    need = needed_overlap(len(x), len(y), percent)
    if min(len(x), len(y)) < need:
        return False
    cuts = x[:: max(1, len(x) // 16)]
    a = np.diff(np.concatenate(([0], np.searchsorted(x, cuts), [len(x)])))
    b = np.diff(np.concatenate(([0], np.searchsorted(y, cuts), [len(y)])))
    if np.minimum(a, b).sum() < need:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: the graph is contracted to smallest neighbours until no link is left."""
    edges, roots = stored(links.select("a", "b"), "edges"), None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                        .select("node", F.least("node", "low").alias("up")), "parents")
        up = parent.select(F.col("node").alias("root"), "up")
        roots = stored(parent.select("node", F.col("up").alias("root")) if roots is None else
                       roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        one = parent.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        two = parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = stored(edges.join(one, "a").join(two, "b").filter("ua <> ub")
                       .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)


class _Join:
    """The steps of one join, each over stored tables."""

    def __init__(self, rows: DataFrame, size: int, percent: int):
        self.spark: SparkSession = rows.sparkSession
        self.rows, self.size, self.percent = rows, size, percent

    def describe(self) -> tuple[DataFrame, np.ndarray]:
        all_rows = stored(self.rows.mapInArrow(_described(self.size), ENTRY), "sets")
        blocks = all_rows.filter("block is not null").select("block", "counts")
        summed = blocks.repartition("block").mapInArrow(_summed, "block int, counts binary").collect()
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for r in summed:
            at = r["block"] * _SKETCH_BLOCK
            sketch[at : at + _SKETCH_BLOCK] += np.frombuffer(r["counts"], np.int64)
        return all_rows.filter("block is null").select("doc_id", "tie", "ent", "n"), np.minimum(sketch, 2**31 - 1).astype(np.int32)

    def shared_members(self, sketch: np.ndarray) -> DataFrame:
        """(h, salt, ent, n, pos, place, group_size): entries of prefix members that more than one entry may have."""
        held = self.spark.sparkContext.broadcast(sketch)
        kind = "ent long, n long, prefix array<long>, salts array<int>"
        entries = self.rows.mapInArrow(_prefixes(self.size, self.percent, held), kind).dropDuplicates(["ent"])
        flat = entries.select("ent", "n", F.posexplode(F.arrays_zip("prefix", "salts")).alias("pos", "z")).select(
            "ent", "n", "pos", F.col("z.prefix").alias("h"), F.col("z.salts").alias("salt"))
        group = Window.partitionBy("h", "salt")
        placed = (flat.withColumn("place", F.row_number().over(group.orderBy("pos", "ent")))
                  .withColumn("group_size", F.count("*").over(group.orderBy("pos", "ent").rowsBetween(
                      Window.unboundedPreceding, Window.unboundedFollowing))))
        return stored(placed.filter("group_size > 1 or salt > 0"), "shared")

    def apart(self, a: str, b: str):
        """The length and positional filters on two entries of one member."""
        low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
        need = F.ceil(F.lit(self.percent) * (low + high) / F.lit(100 + self.percent))
        most = 1 + F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos")) - 1
        return (F.col(f"{a}.ent") != F.col(f"{b}.ent")) & (100 * low >= self.percent * high) & (most >= need)

    def pair(self, a: str, b: str):
        return [F.least(f"{a}.ent", f"{b}.ent").alias("a"), F.greatest(f"{a}.ent", f"{b}.ent").alias("b")]

    def leader_pairs(self, shared: DataFrame) -> DataFrame:
        first = Window.partitionBy("h").orderBy("pos", "ent")
        entry = F.struct("ent", "n", "pos")
        leaders = (shared.filter(F.col("place") <= LEADERS).withColumn("_r", F.row_number().over(first))
                   .filter(F.col("_r") <= LEADERS).groupBy("h").agg(F.collect_list(entry).alias("leaders")))
        counts = shared.groupBy("h").agg(F.count("*").alias("members")).filter("members > 1")
        keyed = stored(leaders.join(counts, "h"), "leaders")
        joined = join_with_heavy_keys(shared.select("h", entry.alias("y")), keyed, ["h"], "members", shared.count())
        return (joined.select("y", F.explode("leaders").alias("x")).filter(self.apart("x", "y"))
                .select(*self.pair("x", "y")).distinct())

    def remaining_pairs(self, shared: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs of one member whose components differ; members inside one component are dropped first."""
        known = shared.join(roots.withColumnRenamed("node", "ent"), "ent", "left").withColumn(
            "root", F.coalesce("root", "ent"))
        known = stored(known.select("h", "ent", "n", "pos", "root"), "rooted")
        mixed = known.groupBy("h").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"),
            F.min_by("root", F.struct("pos", "ent")).alias("lead"))
        mixed = stored(mixed.filter("low <> high").select("h", "members", "lead"), "mixed")
        rows = join_with_heavy_keys(known, mixed, ["h"], "members", known.count())
        # A large component is mostly that of the foremost entry: only rows outside it look for partners.
        band = size_band(F.col("n"), self.percent)
        x = rows.filter("root <> lead").withColumn("band", F.explode(F.array(band - 1, band, band + 1))).alias("x")
        y = rows.withColumn("band", band).alias("y")
        return (x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.band") == F.col("y.band")) & (F.col("x.root") != F.col("y.root"))
                       & ((F.col("y.root") == F.col("y.lead")) | (F.col("x.ent") < F.col("y.ent"))))
                .filter(self.apart("x", "y")).select(*self.pair("x", "y")).distinct())

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        names = pairs.select(F.col("a").alias("ent")).union(pairs.select("b")).distinct()
        place = F.col("ent").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
        words = names.groupBy(F.shiftright(place, 6).alias("at")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, int(ent & 63))")).alias("bits")).toPandas()
        bitmap = np.zeros(1 << BITMAP_BITS - 6, np.uint64)
        bitmap[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
        held = self.spark.sparkContext.broadcast(bitmap)
        made = self.rows.mapInArrow(_picked_sets(self.size, held), "ent long, members binary").dropDuplicates(["ent"])
        return stored(made.join(names, "ent", "left_semi"), "members")

    def verify(self, pairs: DataFrame) -> DataFrame:
        sets = self.sets_of(pairs)
        joined = (pairs.join(sets.select(F.col("ent").alias("a"), F.col("members").alias("x")), "a")
                  .join(sets.select(F.col("ent").alias("b"), F.col("members").alias("y")), "b"))
        return stored(joined.select("a", "b", "x", "y").mapInArrow(_verified(self.percent), "a long, b long"), "links")


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, keeper) of every document.

    ``tie`` is a hash of the text, ``keeper`` marks the first row of each component
    (smallest id, null last, then smallest tie); a document with an empty set is its own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("tie"))
    join = _Join(rows, size, percent)
    described, sketch = join.describe()
    shared = join.shared_members(sketch)
    pairs = stored(join.leader_pairs(shared), "pairs")
    links = join.verify(pairs)
    rest = stored(join.remaining_pairs(shared, components(links)).join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        links = links.unionByName(join.verify(rest))
    roots = components(links)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie")).alias("first")
    classes = described.filter("n > 0").groupBy("ent").agg(first, F.count("*").alias("copies"))
    rooted = stored(classes.join(roots.withColumnRenamed("node", "ent"), "ent", "left")
                    .withColumn("root", F.coalesce("root", "ent")), "classes")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    keyed = stored(rooted.join(firsts, "root").select("ent", "copies", "component"), "components")
    named = join_with_heavy_keys(described.filter("n > 0"), keyed, ["ent"], "copies", described.count())
    keeper = F.col("doc_id").eqNullSafe(F.col("component.doc_id")) & (F.col("tie") == F.col("component.tie"))
    return named.select("doc_id", "tie", F.col("n").alias("n_shingles"), F.col("component.doc_id").alias("component_id"),
                        keeper.alias("keeper")).unionByName(
        described.filter("n = 0").select("doc_id", "tie", F.col("n").alias("n_shingles"),
                                         F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper")))
