"""Language identification by nearest centroid over TF-IDF vectors of byte n-grams.

A text is lower-cased, its ASCII characters other than letters become blanks,
and its n-grams of 1 to ``MAX_N`` bytes are hashed into ``DIMENSIONS`` places. A
vector holds log(1 + count) times the inverse document frequency, scaled to
length 1. Document frequencies are counted over all learning rows. The centroids
(``CLUSTERS`` per language, spherical k-means) are fitted on a sample of at most
``SAMPLE`` learning rows, shared evenly among the languages and drawn by a hash
of the document id. A text gets the language of the centroid with the largest
cosine, which is also its score. It is rejected if it has no letter or its
cosine is below ``REJECT`` times the 0.1 % quantile of the sample's own cosines.
Short texts have few n-grams and so small cosines in any language: their floors
are fitted likewise on the first characters of the sample, by number of n-grams,
and are never above that of long texts.

Null and empty text, or text without a letter, is ``und`` with score 0. With no
learning rows every text is ``und``. Equal texts get equal answers; equal
cosines go to the language that sorts first. All columns of the documents are
kept; those named as result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.text import column_bytes, release_memory, slices

DIMENSIONS = 1 << 12
MAX_N = 3
CLUSTERS = 4
SAMPLE = 2_000
REJECT = 0.5
# Characters of the sample's beginnings, and the n-grams, by powers of two, that texts below them have.
CUTS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
BANDS = 8
UNKNOWN = "und"
SLICES = 64
RESULTS = ("lang_pred", "score", "rejected")

_LETTERS = np.full(256, 32, np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_MIX = np.uint32(0x9E3779B1)


def counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts of hashed n-grams by row) for stretches of a text column."""
    data, bounds = column_bytes(pc.utf8_lower(column))
    shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
    for first, last in slices(bounds):
        part = _LETTERS[data[bounds[first] : bounds[last]]]
        limits = bounds[first : last + 1] - bounds[first]
        out = np.zeros((last - first, DIMENSIONS), np.float32)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, MAX_N + 1):
            if len(part) < n:
                break
            code = code[: len(part) - n + 1] * np.uint32(257) + part[n - 1 :]
            place = (code + np.uint32(n)) * _MIX >> shift
            for row in range(last - first):
                end = limits[row + 1] - n + 1
                if end > limits[row]:
                    out[row] += np.bincount(place[limits[row] : end], minlength=DIMENSIONS)
        yield first, out


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighed = np.log1p(found) * idf
    length = np.linalg.norm(weighed, axis=1, keepdims=True)
    return weighed / np.where(length > 0, length, 1)


def band(found: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(found.sum(axis=1), 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: tuple[str, ...]
    floor: float
    short_floors: np.ndarray

    def floors(self, found: np.ndarray) -> np.ndarray:
        """The least cosine that is not rejected, by row."""
        at = band(found)
        return np.where(at < BANDS, self.short_floors[np.minimum(at, BANDS - 1)], self.floor)

    def nearest(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosines = vectors(found, self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, np.clip(cosines[np.arange(len(best)), best], 0, 1)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(DIMENSIONS + 1, np.int64)
    for batch in batches:
        for _, found in counts(batch.column("text")):
            seen[:DIMENSIONS] += np.count_nonzero(found, axis=0)
            seen[DIMENSIONS] += len(found)
    places = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(seen[places])], names=["place", "n"])


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, found in counts(batch.column("text")):
            packed = [row.astype(np.float32).tobytes() for row in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(first, len(found)), pa.array(packed, pa.binary()),
                 pc.utf8_slice_codeunits(batch.column("text").slice(first, len(found)), 0, max(CUTS))],
                names=["lang", "counts", "head"])


def short_floors(heads: list[tuple[str, str]], centres: np.ndarray, owners: list[str], idf: np.ndarray, floor: float) -> np.ndarray:
    """Floors by band of n-grams, from cuts of the (language, beginning) pairs; a band without a cut takes the next longer one's."""
    seen: list[list[np.ndarray]] = [[] for _ in range(BANDS)]
    for lang in sorted(set(owners)):
        mine = centres[np.array(owners) == lang]
        said = [h for name, h in heads if name == lang]
        for size in CUTS:
            cuts = pa.array(sorted({h[:size] for h in said}), pa.string())
            for first, found in counts(cuts.filter(pc.match_substring_regex(cuts, r"\p{L}"))):
                own, at = (vectors(found, idf) @ mine.T).max(axis=1), band(found)
                for b in range(BANDS):
                    seen[b].append(own[at == b])
    out = np.full(BANDS, floor)
    for b in reversed(range(BANDS)):
        own = np.concatenate(seen[b])
        out[b] = min(REJECT * float(np.quantile(own, 0.001)), floor) if len(own) else out[min(b + 1, BANDS - 1)]
    return out


def spherical_centroids(rows: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; the first is the row nearest the mean, each next the row farthest from those."""
    mean = rows.mean(axis=0)
    chosen = [int((rows @ mean).argmax())]
    while len(chosen) < min(clusters, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centres = rows[chosen]
    for _ in range(rounds):
        owner = (rows @ centres.T).argmax(axis=1)
        sums = np.array([rows[owner == k].sum(axis=0) if (owner == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows with a language whose hash class is not the held-out one."""
    return docs.filter(F.col("lang").isNotNull() & (hash_class(F.col("doc_id")) != 2))


def hash_class(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fit(learning: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model | None:
    """Learn from ``learning`` (doc_id, text, lang).

    The driver gets the n-gram counts of at most ``sample`` rows, or of eight a language if those are more;
    repeated rows count once.
    """
    learning = learning.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    totals = (learning.select("text").mapInArrow(_document_frequencies, "place long, n long")
              .groupBy("place").agg(F.sum("n").alias("n")).collect())
    seen = np.zeros(DIMENSIONS + 1, np.int64)
    for r in totals:
        seen[r["place"]] = r["n"]
    if not seen[DIMENSIONS]:
        return None
    idf = np.log((1 + seen[DIMENSIONS]) / (1 + seen[:DIMENSIONS])).astype(np.float32) + np.float32(1)
    # Ranked by a digest: first within slices of a language, then among what those leave, so no task orders a whole language.
    tie, draw = F.xxhash64("text").alias("tie"), F.xxhash64("doc_id", "tie")
    names = learning.filter("doc_id is not null").select("doc_id", tie, "lang")
    languages = names.agg(F.count_distinct("lang")).first()[0]
    each = max(8, sample // max(1, languages))
    first = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(draw, "doc_id", "tie"))
    sliced = (names.distinct().withColumn("_slice", F.pmod(draw, F.lit(SLICES))).withColumn("_n", first("lang", "_slice"))
              .filter(F.col("_n") <= each))
    chosen = sliced.withColumn("_n", first("lang")).filter(F.col("_n") <= each).select("doc_id", "tie", "lang")
    drawn = (learning.withColumn("tie", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "tie", "lang"])
             .dropDuplicates(["doc_id", "tie", "lang"]).select("text", "lang")
             .mapInArrow(_sample_counts, "lang string, counts binary, head string").collect())
    by_language: dict[str, list[np.ndarray]] = {}
    for r in sorted(drawn, key=lambda r: (r["lang"], r["counts"])):
        found = np.frombuffer(r["counts"], np.float32)
        if found.any():
            by_language.setdefault(r["lang"], []).append(found)
    if not by_language:
        return None
    centres, owners, own = [], [], []
    for lang in sorted(by_language):
        rows = vectors(np.array(by_language[lang]), idf)
        found = spherical_centroids(rows, clusters)
        centres.append(found)
        owners += [lang] * len(found)
        own.append((rows @ found.T).max(axis=1))
    floor = REJECT * float(np.quantile(np.concatenate(own), 0.001))
    centres = np.concatenate(centres).astype(np.float32)
    heads = [(r["lang"], r["head"]) for r in drawn if r["head"]]
    return Model(idf, centres, tuple(owners), floor, short_floors(heads, centres, owners, idf, floor))


def _predict(model: Model | None, results: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.string()).fill_null("")
            letters = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
            names = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            rejected = np.ones(batch.num_rows, bool)
            if model is not None:
                languages = np.array(model.languages, object)
                for first, found in counts(text):
                    best, cosine = model.nearest(found)
                    at = slice(first, first + len(found))
                    names[at] = np.where(letters[at], languages[best], UNKNOWN)
                    score[at] = np.where(letters[at], cosine, 0)
                    rejected[at] = ~letters[at] | (cosine < model.floors(found))
            kept = [c for c in batch.schema.names if c not in results]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*kept, *results])
        release_memory()

    return run


def identify(docs: DataFrame, model: Model | None, prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score (cosine of the nearest centroid) and rejected, their names prefixed. Only the text is looked at."""
    results = [prefix + c for c in RESULTS]
    kept = [f for f in docs.schema.fields if f.name not in results]
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in zip(results, (T.StringType(), T.DoubleType(), T.BooleanType())))])
    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(_predict(model, results), schema)
