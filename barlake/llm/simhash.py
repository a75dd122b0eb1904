"""Near-duplicates by SimHash, found through an inverted index of the bytes of fingerprints with a count filter.

A fingerprint has 64 bits: bit b is set if it is set in more than half of the
XXH64 hashes of a text's runs of ``SHINGLE`` words (repeats included). Two
documents link if their fingerprints differ in at most ``BITS`` = 2 bits. Two
such bits touch at most two of the eight bytes, so linked fingerprints share at
least ``LEAST`` = 6 bytes at their positions.

Index. A list for one byte would hold a 256th of everything, so lists are kept
by four positions at once: the eight bytes make four neighbouring couples, and
two couples of four are a list key (six keys a fingerprint). At most two couples
differ, so every link is in a list. Lists with one entry fall away.

Count filter. In a list of up to ``LIST`` entries the shared bytes of each pair
are tallied, pairs below ``LEAST`` dropped, and the bits of the others counted.
Longer lists are dealt on by every two of the other four positions. What a list
then shares reaches ``LEAST``, and as only two bytes are free, no such list
holds more than 65,536 fingerprints; each is looked up under the 136 changes of
one or two bits in them. Either way a list gives each entry once, with the smallest it is joined to,
and not all of its pairs. No pair is lost, and results do not depend on ``LIST``.

Equal fingerprints are one entry from the start. Null and empty texts have the
fingerprint zero and link like any other. Rows are documents, repeated ones too;
an id may be null, and ``component_id`` is the smallest id that is not null. Only
doc_id and text are read. An empty table gives an empty result. A text is
hashed in stretches, so its length does not count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.jaccard import components, stored
from barlake.llm.skew import join_with_heavy_keys
from barlake.llm.text import FOLD, release_memory

SHINGLE = 3
SEED = 42
BITS = 2
LEAST = 8 - BITS
LIST = 512
STRETCH = 1 << 17
COUPLES = list(combinations(range(4), 2))
_FOLD = FOLD.tobytes()
_SPACE = re.compile(rb"[ \t-\r]")


# ------------------------------------------------------------ fingerprints


def word_stretches(text: bytes) -> Iterator[list[bytes]]:
    """All words of a text, folded, some at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + STRETCH) if at + STRETCH < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(_FOLD).split()
        at = end


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    from xxhash import xxh64_intdigest

    held: list[bytes] = []
    whole = True  # nothing was hashed yet
    for words in word_stretches(text):
        held += words
        if len(held) < SHINGLE:
            continue
        joined = b" ".join(held)
        ends = np.cumsum([len(w) + 1 for w in held]) - 1
        starts = [0, *(ends[: -SHINGLE] + 1).tolist()]
        runs = zip(starts, ends[SHINGLE - 1 :].tolist())
        yield np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in runs], np.uint64)
        held, whole = held[1 - SHINGLE :], False
    if whole and held:
        yield np.array([xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fp"])
    release_memory()


# ------------------------------------------------------------------ lists


def couple(fp: Column, k: int) -> Column:
    """Two neighbouring bytes of a fingerprint."""
    return F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))


def list_keys(fp: Column) -> Column:
    """The six lists of a fingerprint: which two couples, and their 32 bits."""
    return F.array(*(F.lit(k << 32).bitwiseOR(F.shiftleft(couple(fp, a), 16)).bitwiseOR(couple(fp, b))
                     for k, (a, b) in enumerate(COUPLES)))


#: For each of the six lists, its bytes with each two of the others: six of the eight positions.
SIXES = [[tuple(sorted({2 * a, 2 * a + 1, 2 * b, 2 * b + 1, *more}))
          for more in combinations([p for p in range(8) if p // 2 not in (a, b)], 2)] for a, b in COUPLES]


def long_list_keys(fp: Column, key: Column) -> Column:
    """The lists of six positions that an entry of a long list goes on to: the two positions left out, and the bits kept."""
    def kept(six: tuple[int, ...]) -> Column:
        mask = sum(0xFF << 8 * p for p in six)
        left = [p for p in range(8) if p not in six]
        return F.struct(F.lit(left[0] * 8 + left[1]).alias("free"),
                        fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("kept"))

    which, out = F.shiftright(key, 32), F.lit(None)
    for k, sixes in enumerate(SIXES):
        out = F.when(which == k, F.array(*(kept(s) for s in sixes))) if not k else out.when(which == k, F.array(*(kept(s) for s in sixes)))
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) for each entry that the links a-b join to a smaller one: no more than ``n`` for any number of links."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    members = np.flatnonzero(root != np.arange(n))
    return root[members], members


def short_list_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the entries of a list: shared bytes are tallied, and bits counted where they reach the least."""
    octets = fps.view(np.uint8).reshape(-1, 8)
    tally = np.zeros((len(fps), len(fps)), np.int8)
    for position in range(8):
        tally += octets[:, None, position] == octets[None, :, position]
    a, b = np.nonzero(np.triu(tally >= LEAST, 1))
    near = np.bitwise_count(fps[a] ^ fps[b]) <= BITS
    return forest(len(fps), a[near], b[near])


def long_list_links(fps: np.ndarray, free: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct sorted fingerprints that differ in two bytes only, by their changes of one or two bits."""
    places = [8 * p + bit for p in free for bit in range(8)]
    changes = [1 << i for i in places] + [1 << i | 1 << j for i, j in combinations(places, 2)]
    a, b = [], []
    for change in changes:
        other = fps ^ np.uint64(change)
        at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
        found = np.flatnonzero((fps[at] == other) & (fps < other))
        a.append(found)
        b.append(at[found])
    return forest(len(fps), np.concatenate(a), np.concatenate(b))


LINKS = "a long, b long"


def _links(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sides = [np.concatenate(s) if pairs else np.empty(0, np.uint64) for s in (zip(*pairs) if pairs else ((), ()))]
    return pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)) for s in sides], names=["a", "b"])


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for fps in batch.column("fps"):
            fps = fps.values.to_numpy().view(np.uint64)
            a, b = short_list_links(fps)
            if len(a):
                found.append((fps[a], fps[b]))
        yield _links(found)


def _long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come list by list, fingerprints in order; a list has at most 65,536 distinct ones."""
    current, parts = None, []

    def linked() -> pa.RecordBatch:
        fps = np.unique(np.concatenate(parts).view(np.uint64))
        a, b = long_list_links(fps, divmod(current[0], 8))
        return _links([(fps[a], fps[b])])

    for batch in batches:
        free, kept, fps = (batch.column(c).to_numpy() for c in ("free", "kept", "fp"))
        starts = np.flatnonzero(np.concatenate(([True], (free[1:] != free[:-1]) | (kept[1:] != kept[:-1])))) if len(fps) else []
        for first, last in zip(starts, [*starts[1:], len(fps)]):
            key = (int(free[first]), int(kept[first]))
            if parts and key != current:
                yield linked()
                parts = []
            current = key
            parts.append(fps[first:last])
    if parts:
        yield linked()


def links(fps: DataFrame, longest: int = LIST) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp``: joins exactly those that steps of at most ``BITS`` bits join."""
    entries = fps.select("fp", F.explode(list_keys(F.col("fp"))).alias("key"))
    sizes = stored(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "lists")
    total = 6 * fps.count()
    kept = stored(join_with_heavy_keys(entries, sizes, ["key"], "n", total), "entries")
    short = (kept.filter(F.col("n") <= longest).groupBy("key").agg(F.collect_list("fp").alias("fps"))
             .select("fps").mapInArrow(_short, LINKS))
    dealt = (kept.filter(F.col("n") > longest).select("fp", F.explode(long_list_keys(F.col("fp"), F.col("key"))).alias("six"))
             .select("fp", "six.free", "six.kept").distinct())
    long = dealt.repartition("free", "kept").sortWithinPartitions("free", "kept", "fp").mapInArrow(_long, LINKS)
    return stored(short.unionByName(long).distinct(), "links")


def simhash_components(docs: DataFrame, longest: int = LIST) -> DataFrame:
    """(doc_id, fingerprint as a long, component_id) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(rows.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "classes")
    roots = components(links(classes.select("fp"), longest))
    rooted = stored(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    firsts = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")), "firsts")
    keyed = stored(join_with_heavy_keys(rooted, firsts, ["root"], "members", rooted.count())
                   .select("fp", "copies", "component_id"), "components")
    named = join_with_heavy_keys(rows, keyed, ["fp"], "copies", rows.count())
    return named.select("doc_id", F.col("fp").alias("fingerprint"), "component_id")
