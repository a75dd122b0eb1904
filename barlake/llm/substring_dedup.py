"""Substring de-duplication by hashes of lines, paragraphs or clauses.

A text is split into units; a unit's words, folded from A-Z to a-z and joined by
single blanks, are digested to 128 bits. Of each digest the earliest occurrence
stays (smallest document id, null last, then a hash of the text, then position)
and the others are repeated, in whichever document they are. Lines and paragraphs
of fewer than ``min_words`` words are left alone.

Clauses end at a line end or after one of . ! ? , ; : before white space, once
they have ``min_words`` words; shorter ones go on, so units are cut alike wherever
a passage begins. With ``passage``, repeated units go only where consecutive ones
have that many words together: a passage that begins and ends inside of clauses
loses what lies between, and common short units stay where they are.

The result has the text that remains and, for each removed stretch, its offsets
in the original text; ``n_removed`` counts units. Null text stays null; an empty
text has no unit. Rows equal in document id and text are one document and each
get the same answer. An empty table gives an empty result. All other columns are
kept; those named as result columns are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.skew import join_with_heavy_keys
from barlake.llm.text import FOLD
from barlake.session import scratch_dir

MIN_WORDS = 5
CLAUSE_WORDS = 8
PASSAGE_WORDS = 25
BREAKS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*")}
CLAUSE = re.compile(r"[^.!?,;:\n]*(?:[.!?,;:]+[^.!?,;: \t-\r][^.!?,;:\n]*)*(?:[.!?,;:]+[ \t-\r]*|\n[ \t-\r]*|\Z)")
_FOLD = FOLD.tobytes()
SPANS = "array<struct<start:long,end:long>>"
RESULTS = ("text", "n_units", "n_removed", "removed")


def units(text: str, unit: str, min_words: int) -> list[tuple[int, int]]:
    """Offsets of the units of a text; what parts lines and paragraphs belongs to none, clauses cover the text."""
    found, at = [], 0
    if unit == "clause":
        words = 0
        for m in CLAUSE.finditer(text):
            words += n_words(m[0])
            if words >= min_words or m.end() == len(text) > at:
                found.append((at, m.end()))
                at, words = m.end(), 0
        return found
    for m in BREAKS[unit].finditer(text):
        found.append((at, m.start()))
        at = m.end()
    found.append((at, len(text)))
    return found


def n_words(text: str) -> int:
    return len(text.encode().split())


def digest(text: str, min_words: int) -> bytes | None:
    words = text.encode().translate(_FOLD).split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if len(words) >= min_words else None


def passages(gone: list[int], words: list[int], least: int) -> list[int]:
    """The places of those runs of consecutive repeated units that have enough words together."""
    kept, run, total = [], [], 0
    for place, n in zip([*gone, None], [*words, 0]):
        if run and place != run[-1] + 1:
            kept += run if total >= least else []
            run, total = [], 0
        run.append(place)
        total += n
    return kept


def _digests(unit: str, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, found = [], [], []
            for row, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                for place, (a, b) in enumerate(units(text, unit, min_words)):
                    if d := digest(text[a:b], 1 if unit == "clause" else min_words):
                        rows.append(row)
                        places.append(place)
                        found.append(d)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("tie").take(at), pa.array(places, pa.int32()),
                 pa.array(found, pa.binary())], names=["doc_id", "tie", "place", "digest"])

    return run


def _cut(unit: str, min_words: int, passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, removed, spans = [], [], [], []
            for text, places in zip(batch.column("text"), batch.column("_places")):
                text, gone = text.as_py(), sorted(places.as_py() or ())
                all_units = units(text, unit, min_words) if text else []
                gone = passages(gone, [n_words(text[slice(*all_units[p])]) for p in gone], passage)
                out = stretches([all_units[p] for p in gone])
                removed.append(len(gone))
                gone = set(gone)
                if gone:  # each kept unit takes along what parts it from the next
                    kept = [text[a : all_units[p + 1][0] if p + 1 < len(all_units) else b]
                            for p, (a, b) in enumerate(all_units) if p not in gone]
                    if len(all_units) - 1 in gone and kept:
                        last = max(p for p in range(len(all_units)) if p not in gone)
                        kept[-1] = text[all_units[last][0] : all_units[last][1]]
                    text = "".join(kept)
                texts.append(text)
                totals.append(len(all_units))
                spans.append([{"start": a, "end": b} for a, b in out])
            others = [c for c in batch.schema.names if c not in (*RESULTS, "_places")]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(texts, pa.string()), pa.array(totals, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, kind)], names=[*others, *RESULTS])

    return run


def stretches(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def dedup_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, passage: int = 0) -> DataFrame:
    """``docs`` with the text that remains, n_units, n_removed and the removed spans.

    One row per unit goes through an aggregation by digest, combined before its
    shuffle. Only repeated digests are joined back, the heavy ones by broadcast.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("_tie", F.xxhash64("text"))
    staged = scratch_dir(spark, "units")
    (keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_tie").alias("tie"))
     .mapInArrow(_digests(unit, min_words), "doc_id long, tie long, place int, digest binary").write.parquet(staged))
    rows = spark.read.schema("doc_id long, tie long, place int, digest binary").parquet(staged)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie", "place")
    repeated = (rows.groupBy("digest").agg(F.min(order).alias("kept"), F.count("*").alias("n")).filter("n > 1"))
    stored = scratch_dir(spark, "repeated")
    repeated.write.parquet(stored)
    repeated = spark.read.schema(repeated.schema).parquet(stored)
    gone = (join_with_heavy_keys(rows, repeated, ["digest"], "n", rows.count()).filter(order != F.col("kept"))
            .groupBy("doc_id", "tie").agg(F.array_sort(F.collect_set("place")).alias("_places"))
            .select(F.col("doc_id").alias("_doc"), F.col("tie").alias("_gone"), "_places"))
    joined = keyed.join(gone, keyed["doc_id"].cast("long").eqNullSafe(gone["_doc"]) & (keyed["_tie"] == gone["_gone"]), "left")
    kept = [f for f in docs.schema.fields if f.name not in RESULTS]
    schema = T.StructType([*kept, *T._parse_datatype_string(
        f"text string, n_units long, n_removed long, removed {SPANS}").fields])
    return joined.select(*(keyed[f"`{f.name}`"] for f in kept), keyed["text"], "_places").mapInArrow(_cut(unit, min_words, passage), schema)
