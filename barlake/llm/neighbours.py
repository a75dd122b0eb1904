"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact reranking.

A table hashes a unit vector by ``hashes`` Gaussian projections, shifted and cut
into windows of ``width``; the windows it falls in name its bucket. A query looks
into its own bucket of every table and then into perturbed ones, in the order of
estimated success: a perturbation moves some projections across their nearer
window edges, and its estimate is the expected sum of the squared distances to
those edges. The candidates of all tables are reranked by their exact cosine in
double precision, and of one vector found in several tables one is kept.

Buckets are capped, so a query far from all others may find fewer than ``k``
although the table has them. Each such query is then compared with every entry of
the index, exactly: blocks of ``QUERY_ROWS`` queries meet parts of ``PART_ROWS``
entries, and the best of each pair of them are merged. This costs the number of
such queries times that of the entries, and nothing when there are none.

Equal vectors are one entry of the index that keeps the ``k`` + 1 smallest of its
ids: no other copy can be among the ``k`` nearest of any query, so this loses
nothing however many copies there are.

Work is dealt by bucket to as many parts as the index has rows over
``PART_ROWS``; a query goes once to every part that holds a bucket it visits,
with all its probes there. A bucket of more than ``PART_ROWS`` entries is dealt
to several parts. A part holds its queries and streams its entries, and keeps
only the best of each query. ``hashes`` grows with the logarithm of the number of
vectors, so buckets stay small.

Vectors that are null, zero, of another length than most, or hold a null or not
finite component take no part, nor do rows without an id. Rows with equal id and
vector are one; an id with two vectors is a candidate by the nearer one. Ties go
to the smaller id. A query never finds its own id. An empty table gives no row.
Only the two named columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.session import scratch_dir

TABLES = 16
PROBES = 140
WIDTH = 2.0
PART_ROWS = 50_000
QUERY_ROWS = 10_000


def perturbations(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of places in the sorted list of edge distances, cheapest expected set first; the empty set leads.

    Place j and place 2 * hashes - 1 - j are the two edges of one window, so a set never has both.
    """
    m = hashes
    places = range(1, 2 * m + 1)
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else
            1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in places]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < probes:
        total, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - j not in chosen for j in chosen):
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return found


@dataclass(frozen=True)
class Tables:
    """Projections of all tables, and the probes of a query in their order."""

    size: int
    tables: int
    hashes: int
    width: float
    probes: tuple[tuple[int, ...], ...]
    seed: int = 11

    def drawn(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        n = self.tables * self.hashes
        return (rng.normal(size=(self.size, n)), rng.uniform(0, self.width, n),
                rng.integers(1, 2**62, (self.tables, self.hashes), dtype=np.int64) * 2 + 1)

    def windows(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lines, shifts, odd = self.drawn()
        at = ((unit @ lines + shifts) / self.width).reshape(len(unit), self.tables, self.hashes)
        cell = np.floor(at)
        return at - cell, cell.astype(np.int64), odd

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit name of each vector's bucket in each table."""
        _, cell, odd = self.windows(unit)
        return (cell * odd).sum(axis=2)

    def probe_keys(self, unit: np.ndarray) -> np.ndarray:
        """vector x table x probe, in the order of estimated success."""
        inside, cell, odd = self.windows(unit)
        edges = np.concatenate([inside, 1 - inside], axis=2)
        order = np.argsort(edges, axis=2, kind="stable")
        step = np.where(order < self.hashes, -1, 1) * np.take_along_axis(
            np.broadcast_to(odd, cell.shape), order % self.hashes, axis=2)
        own = (cell * odd).sum(axis=2)
        return np.stack([own + step[:, :, list(p)].sum(axis=2) for p in self.probes], axis=2)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _hashed(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = tables.keys(unit_rows(matrix(batch.column("vector"), tables.size)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), batch.column("vector"), pa.array(list(keys), pa.list_(pa.int64()))],
                names=["ids", "vector", "keys"])

    return run


def _part(keys: np.ndarray, salt: np.ndarray | int, parts: int) -> np.ndarray:
    mixed = (keys.astype(np.uint64) ^ (keys.astype(np.uint64) >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (((mixed >> np.uint64(20)) + np.asarray(salt, np.uint64)) % np.uint64(parts)).astype(np.int64)


ROUTED = "part long, kind int, query long, ids array<long>, vector array<double>, keys array<long>"


def _routed_entries(size: int, parts: int, large: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys").flatten().to_numpy()
            tables = len(keys) // max(batch.num_rows, 1)
            rows = np.repeat(np.arange(batch.num_rows), tables)
            salts = np.zeros(len(keys), np.int64)
            if large:
                spread = np.array([large.get(k, 1) for k in keys.tolist()])
                salts = np.array([ids[0].as_py() for ids in batch.column("ids")])[rows] % spread
            at = _part(keys, salts, parts)
            # a row per part with all buckets the vector has there
            order = np.lexsort((at, rows))
            rows, at, keys = rows[order], at[order], keys[order]
            first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (at[1:] != at[:-1]))))
            take = pa.array(rows[first])
            bounds = pa.array(np.append(first, len(keys)), pa.int32())
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[first]), pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()),
                 batch.column("ids").take(take), batch.column("vector").take(take).cast(pa.list_(pa.float64())),
                 pa.ListArray.from_arrays(bounds, pa.array(keys))],
                names=["part", "kind", "query", "ids", "vector", "keys"])

    return run


def _routed_queries(tables: Tables, parts: int, large: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                n = piece.num_rows
                found = tables.probe_keys(unit_rows(matrix(piece.column("vector"), tables.size))).reshape(n, -1)
                rows = np.repeat(np.arange(n), found.shape[1])
                keys = found.ravel()
                salts = np.zeros(len(keys), np.int64)
                if large:
                    spread = np.array([large.get(k, 1) for k in keys.tolist()])
                    rows, keys = np.repeat(rows, spread), np.repeat(keys, spread)
                    salts = np.concatenate([np.arange(s) for s in spread])
                at = _part(keys, salts, parts)
                order = np.lexsort((keys, at, rows))
                rows, at, keys = rows[order], at[order], keys[order]
                new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (at[1:] != at[:-1])))
                fresh = new | np.concatenate(([True], keys[1:] != keys[:-1]))
                rows, at, keys, new = rows[fresh], at[fresh], keys[fresh], new[fresh]
                first = np.flatnonzero(new)
                take = pa.array(rows[first])
                m = len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[first]), pa.array(np.zeros(m, np.int32)), piece.column("query").take(take),
                     pa.nulls(m, pa.list_(pa.int64())), piece.column("vector").take(take).cast(pa.list_(pa.float64())),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(keys)), pa.int32()), pa.array(keys))],
                    names=["part", "kind", "query", "ids", "vector", "keys"])

    return run


class Best:
    """The ``k`` best candidates of each query so far, pruned whenever many have gathered."""

    def __init__(self, queries: np.ndarray, k: int, most: int = 500_000):
        self.queries, self.k, self.most = queries, k, most
        self.floor = np.full(len(queries), -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.floor[rows]) & (self.queries[rows] != ids)
        if good.any():
            self.held.append((rows[good], ids[good], scores[good]))
            self.size += int(good.sum())
            if self.size > self.most:
                self.prune()

    def prune(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        rows, ids, scores = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((-scores, ids, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        one = np.concatenate(([True], (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])))
        rows, ids, scores = rows[one], ids[one], scores[one]
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[rows[last]] = scores[last]
        rows, ids, scores = rows[keep], ids[keep], scores[keep]
        self.held, self.size = [(rows, ids, scores)], len(rows)
        return rows, ids, scores


def _spread(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy()


FOUND = "query_id long, vec_id long, score double"


def _add_scored(best: Best, q: np.ndarray, scores: np.ndarray, ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
    """Offer ``best`` all ids of the entries, each entry's from ``first`` to ``last``, by their scores with the queries ``q``."""
    i, j = np.nonzero(scores >= best.floor[q][:, None])
    if not len(i):
        return
    copies = last[j] - first[j]
    qi, values = np.repeat(q[i], copies), np.repeat(scores[i, j], copies)
    where = np.repeat(first[j], copies) + np.arange(len(qi)) - np.repeat(np.cumsum(copies) - copies, copies)
    best.add(qi, ids[where], values)


def _searched(size: int, k: int):
    """Within each part: queries come first and are held, entries stream past them."""

    def search(part: list[pa.RecordBatch], entries: Iterator[pa.RecordBatch]):
        held = pa.Table.from_batches(part).combine_chunks()
        names = held["query"].combine_chunks().to_numpy()
        vectors = matrix(held["vector"].combine_chunks(), size)
        lengths = np.linalg.norm(vectors, axis=1)
        owner, keys = _spread(held["keys"].combine_chunks())
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        best = Best(names, k)
        for batch in entries:
            rows = matrix(batch.column("vector"), size)
            norms = np.linalg.norm(rows, axis=1)
            member, mine = _spread(batch.column("keys"))
            by = np.argsort(mine, kind="stable")
            member, mine = member[by], mine[by]
            id_owner, ids = _spread(batch.column("ids"))
            id_first = np.searchsorted(id_owner, np.arange(len(rows) + 1))
            bucket, first = np.unique(mine, return_index=True)
            last = np.append(first[1:], len(mine))
            a, b = np.searchsorted(keys, bucket), np.searchsorted(keys, bucket, "right")
            for at in np.flatnonzero(b > a):
                q, m = owner[a[at] : b[at]], member[first[at] : last[at]]
                scores = (vectors[q] @ rows[m].T) / np.outer(lengths[q], norms[m])
                _add_scored(best, q, scores, ids, id_first[m], id_first[m + 1])
        found, ids, scores = best.prune()
        return pa.RecordBatch.from_arrays([pa.array(names[found]), pa.array(ids), pa.array(scores)],
                                          names=["query_id", "vec_id", "score"])

    return _by_parts_with(search)


def _scanned(size: int, k: int):
    """Within each part: every entry is compared with every query, in steps of a few of both."""

    def scan(part: list[pa.RecordBatch], entries: Iterator[pa.RecordBatch]):
        held = pa.Table.from_batches(part).combine_chunks()
        names = held["query"].combine_chunks().to_numpy()
        vectors = matrix(held["vector"].combine_chunks(), size)
        lengths = np.linalg.norm(vectors, axis=1)
        starts = range(0, len(names), 64)
        bests = [Best(names[a : a + 64], k, most=50_000) for a in starts]
        for batch in entries:
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                rows = matrix(piece.column("vector"), size)
                norms = np.linalg.norm(rows, axis=1)
                id_owner, ids = _spread(piece.column("ids"))
                id_first = np.searchsorted(id_owner, np.arange(len(rows) + 1))
                for a, best in zip(starts, bests):
                    scores = (vectors[a : a + 64] @ rows.T) / np.outer(lengths[a : a + 64], norms)
                    _add_scored(best, np.arange(len(scores)), scores, ids, id_first[:-1], id_first[1:])
        found = [(names[a + rows], ids, scores) for a, best in zip(starts, bests) for rows, ids, scores in [best.prune()]]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)],
                                          names=["query_id", "vec_id", "score"])

    return _by_parts_with(scan)


def _by_parts_with(search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _by_part(batches)
        queries: list[pa.RecordBatch] = []
        current, entries, held = None, [], 0
        for part, kind, piece in pieces:
            if part != current:
                if queries and entries:
                    yield search(queries, entries)
                current, queries, entries, held = part, [], [], 0
            (queries if kind == 0 else entries).append(piece)
            held += piece.num_rows if kind else 0
            if kind and held >= PART_ROWS and queries:
                yield search(queries, entries)
                entries, held = [], 0
        if queries and entries:
            yield search(queries, entries)

    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of rows of one part and kind, from rows sorted by both."""
    for batch in batches:
        part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip(np.concatenate(([0], cuts)), np.append(cuts, batch.num_rows)):
            if b > a:
                yield int(part[a]), int(kind[a]), batch.slice(int(a), int(b - a))


def _exact(short: DataFrame, entries: DataFrame, size: int, k: int, n_short: int, n: int) -> DataFrame:
    """The ``k`` best of all ``entries`` for each of the ``short`` queries, by parts: to be merged."""
    blocks = -(-n_short // QUERY_ROWS)
    parts = max(int(short.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PART_ROWS))
    block, part = F.pmod(F.xxhash64("query", "vector"), F.lit(blocks)), F.pmod(F.xxhash64("vector"), F.lit(parts))
    met = short.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"), "*").select(
        (block * parts + F.col("_part")).cast("long").alias("part"), F.lit(0).alias("kind"), "query",
        F.lit(None).cast("array<long>").alias("ids"), "vector")
    rows = entries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), "*").select(
        (F.col("_block") * parts + part).cast("long").alias("part"), F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("query"), "ids", "vector")
    return (met.unionByName(rows).repartition(blocks * parts, "part").sortWithinPartitions("part", "kind")
            .mapInArrow(_scanned(size, k), FOUND))


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def default_hashes(n: int) -> int:
    return max(4, round(6 + math.log2(max(n, 2)) / 4))


def nearest(vectors: DataFrame, queries: Column, k: int = 5, tables: int = TABLES, probes: int = PROBES,
            width: float = WIDTH, hashes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for the rows that ``queries`` selects, all others if fewer."""
    spark = vectors.sparkSession
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").head(1)
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, n = sizes[0]["size"], sizes[0]["count"]
    rows = rows.filter(F.size("vector") == size)
    hashes = hashes or default_hashes(n)
    plan = Tables(size, tables, hashes, width, tuple(perturbations(hashes, probes)))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    entries = (rows.distinct().withColumn("_n", F.dense_rank().over(copies)).filter(F.col("_n") <= k + 1)
               .groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select("ids", "vector"))
    staged = scratch_dir(spark, "entries")
    kind = "ids array<long>, vector array<double>, keys array<long>"
    entries.mapInArrow(_hashed(plan), kind).write.parquet(staged)
    entries = spark.read.schema(kind).parquet(staged)
    counts = entries.select(F.explode("keys").alias("key")).groupBy("key").count().filter(F.col("count") > PART_ROWS)
    large = {r["key"]: -(-r["count"] // PART_ROWS) for r in counts.collect()}  # at most rows * tables / PART_ROWS
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * tables // PART_ROWS))
    asked = rows.filter(queries).select(F.col("vec_id").alias("query"), "vector").distinct()
    routed = entries.mapInArrow(_routed_entries(size, parts, large), ROUTED).unionByName(
        asked.mapInArrow(_routed_queries(plan, parts, large), ROUTED))
    found = (routed.repartition(parts, "part").sortWithinPartitions("part", "kind")
             .mapInArrow(_searched(size, k), FOUND))

    def merged(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

    def stage(frame: DataFrame, label: str) -> DataFrame:
        folder = scratch_dir(spark, label)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    best = stage(merged(found), "neighbours")
    due = entries.select(F.explode("ids").alias("id")).distinct().limit(k + 1).count() - 1
    if due < 1:
        return best
    whole = best.groupBy("query_id").count().filter(F.col("count") >= due).select(F.col("query_id").alias("query"))
    short = stage(asked.join(whole, "query", "left_anti"), "short-queries")
    n_short = short.count()
    if not n_short:
        return best
    exact = merged(_exact(short, entries.select("ids", "vector"), size, k, n_short, n))
    return best.join(short.select(F.col("query").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(exact)
