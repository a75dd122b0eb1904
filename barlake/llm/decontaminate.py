"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts.

Texts are folded (A-Z to a-z) and split into words of ASCII letters, digits and
all other than ASCII characters. A window is ``size`` consecutive words of a
benchmark item; an item of fewer words, but not none, is one window. The
automaton holds all windows, words joined by single blanks with a blank at both
ends, so a match is a run of whole words. Each text is scanned once, and matches
are mapped to words and from them to offsets in the original text.

The benchmark goes to the tasks in parts of at most ``part_bytes`` of windows: a
benchmark beyond that is split by hash and the texts are scanned once per part,
so no task ever holds more.

Null or empty text has no words and no hit. Items without words are never found;
an item without an id marks words as hit but is not listed; rows that share an
item id are one item. Repeated documents get the same answer each. A column of
the documents named as the result column is replaced; all others are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlake.llm.jaccard import stored
from barlake.llm.text import release_memory

WINDOW = 10
PART_BYTES = 64 << 20

#: Bytes of words, folded; every other byte is a blank. Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after folding.
BLANKED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(BLANKED).split()


def _joined(words: list[bytes]) -> str:
    """Each byte as one character, so that the automaton runs over bytes."""
    return f" {b' '.join(words).decode('latin-1')} "


@dataclass(frozen=True)
class Windows:
    """Windows of some items: the number of words and the items of each."""

    items: dict[str, tuple[int, frozenset[str]]]

    @classmethod
    def of(cls, rows: list[tuple[str | None, str | None]], size: int) -> Windows:
        found: dict[str, tuple[int, set[str]]] = {}
        for item, text in rows:
            words = words_of(text)
            width = min(size, len(words))
            for at in range(len(words) - width + 1 if width else 0):
                named = found.setdefault(_joined(words[at : at + width]), (width, set()))[1]
                if item is not None:
                    named.add(item)
        return cls({k: (n, frozenset(s)) for k, (n, s) in found.items()})

    def automaton(self):
        import ahocorasick

        built = ahocorasick.Automaton()
        for key, value in self.items.items():
            built.add_word(key, value)
        built.make_automaton()
        return built


def find_windows(automaton, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
    """Runs [first, past the last] of hit words, and the items found."""
    runs: list[list[int]] = []
    items: set[str] = set()
    if not words or not len(automaton):
        return runs, items
    text = _joined(words)
    blanks, counted = 0, 0
    for end, (width, named) in automaton.iter(text):
        blanks += text.count(" ", counted, end)
        counted = end
        first = max(blanks - width, 0)
        if runs and first <= runs[-1][1]:
            while len(runs) > 1 and first <= runs[-2][1]:
                runs.pop()
            runs[-1] = [min(first, runs[-1][0]), blanks]
        else:
            runs.append([first, blanks])
        items |= named
    return runs, items


def merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def original_spans(text: str, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Character offsets of runs of words in the text as it was."""
    raw = text.encode()
    bounds = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(BLANKED))]
    spans, at, chars = [], 0, 0
    for first, end in runs:
        start, stop = bounds[first][0], bounds[end - 1][1]
        chars += len(raw[at:start].decode())
        width = len(raw[start:stop].decode())
        spans.append((chars, chars + width))
        chars, at = chars + width, stop
    return spans


def _scan(windows: Windows, column: str, schema: pa.Schema, earlier: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = windows.automaton()
        for batch in batches:
            values = []
            before = batch.column(column).to_pylist() if earlier else [None] * batch.num_rows
            for text, known in zip(batch.column("text"), before):
                text = text.as_py()
                words = words_of(text)
                runs, items = find_windows(automaton, words)
                if known:
                    runs += [[s["start"], s["end"]] for s in known["word_runs"]]
                    items |= set(known["items"])
                runs = merged(runs)
                values.append({
                    "n_words": len(words), "n_hit": sum(b - a for a, b in runs), "items": sorted(items),
                    "spans": [dict(zip(("start", "end"), s)) for s in original_spans(text, runs)] if runs else [],
                    "word_runs": [{"start": a, "end": b} for a, b in runs],
                })
            kept = [c for c in batch.schema.names if c != column]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(values, schema.field(column).type)], names=[*kept, column])
        del automaton
        release_memory()

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, part_bytes: int = PART_BYTES,
                  column: str = "contamination") -> DataFrame:
    """``docs`` with a struct: n_words, n_hit (words inside any window found), items, spans in the original text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total * (size + 1) // part_bytes))
    kept = [c for c in docs.columns if c != column]
    result = docs.select(*(F.col(f"`{c}`") for c in kept))
    held = T.StructType([*RESULT.fields, T.StructField("word_runs", RESULT["spans"].dataType)])
    for part in range(parts):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        windows = Windows.of([(r["item_id"], r["text"]) for r in chosen.collect()], size)
        schema = T.StructType([*result.schema.fields, T.StructField(column, held)] if not part else result.schema.fields)
        result = result.mapInArrow(_scan(windows, column, to_arrow_schema(schema), part > 0), schema)
        if part + 1 < parts:  # a plan of several scans would run their workers, and hold their automata, side by side
            result = stored(result, "part")
    return result.withColumn(column, F.col(column).dropFields("word_runs"))
