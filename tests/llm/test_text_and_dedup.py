"""Word hashing, line de-duplication and the similarity join against plain Python."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barlake.llm import jaccard, skew, substring_dedup
from barlake.llm import text as words

DOCS = "doc_id long, text string, lang string, source string"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall("[^\x20\x09-\x0d]+", fold(text))


TEXTS = ["", None, "a", "A a", "É é ÉE x", "one\ttwo\x0bthree  four\n five", " lead and trail ", "x" * 300_000,
         "y " * 200_000, "\x1cx\x85y"]


def test_words_are_those_of_the_pattern():
    rows = [h for _, h in words.row_words(pa.array(TEXTS), words.SPACED)]
    known = {}
    for text, hashes in zip(TEXTS, rows):
        found = plain_words(text)
        assert len(found) == len(hashes)
        for word, h in zip(found, hashes.tolist()):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    again = [h for _, h in words.row_words(pa.array(["", *TEXTS])[1:], words.SPACED)]
    assert all((a == b).all() for a, b in zip(rows, again))


def test_shingles():
    w = np.arange(7, dtype=np.uint64)
    assert len(words.shingle_hashes(w, 5)) == 3 and len(words.shingle_hashes(w[:3], 5)) == 1
    assert len(words.shingle_hashes(w[:0], 5)) == 0
    assert words.shingle_hashes(w[:5], 5)[0] == words.shingle_hashes(w, 5)[0] != words.shingle_hashes(w[:4], 5)[0]


def test_heavy_keys_join_as_others_do(spark):
    rows = spark.range(3000).withColumn("k", F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 50))
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = skew.join_with_heavy_keys(rows, keyed, ["k"], "n", 3000)
    assert joined.count() == 3000 and joined.filter("n = 2020").count() == 2020


def brute_dedup(rows, least):
    """rows: (doc_id, text) in rank order; the kept text and removed lines of each."""
    seen, out = set(), {}
    for doc, text in rows:
        kept, gone, at = [], [], 0
        for line in text.split("\n"):
            key = plain_words(line)
            if len(key) >= least and tuple(key) in seen:
                gone.append((at, at + len(line)))
            else:
                kept.append(line)
                if len(key) >= least:
                    seen.add(tuple(key))
            at += len(line) + 1
        out[doc] = ("\n".join(kept), gone)
    return out


def plain_clauses(text, least):
    """Units of a text, found word by word."""
    out, at, words = [], 0, 0
    for m in re.finditer("[^ \t-\r]+([ \t-\r]*)", text):
        words += 1
        last = m[0][: len(m[0]) - len(m[1])][-1]
        if words >= least and (m[1] and (last in ".!?,;:" or "\n" in m[1])):
            out.append(text[at : m.end()])
            at, words = m.end(), 0
    return out + [text[at:]] * (at < len(text))


def brute_passages(rows, least, passage):
    """rows: (doc_id, text) in rank order; the kept text and the removed units of each."""
    seen, out = set(), {}
    for doc, text in rows:
        parts, flags = plain_clauses(text or "", least), []
        for part in parts:
            key = tuple(plain_words(part))
            flags.append(bool(key) and key in seen)
            seen |= {key} if key else set()
        kept, at = [], 0
        for again, run in itertools.groupby(range(len(parts)), lambda k: flags[k]):
            run = list(run)
            if not again or sum(len(plain_words(parts[k])) for k in run) < passage:
                kept += run
        out[doc] = ("".join(parts[k] for k in kept), len(parts) - len(kept))
    return out


def test_passages_inside_lines_go_and_common_short_lines_stay(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    said = lambda n: " ".join(word() + rng.choice([""] * 9 + [",", ".", "?\n", ": "]) for _ in range(n))
    shared, common = said(60), "Share this page.\n"
    rows = [(i, common + said(40) + " tail " + (shared if i % 2 else "") + " and " + said(30) + "\n" + common) for i in range(12)]
    rows += [(20, None), (21, ""), (22, " \n\t"), (23, "x" * 50_000), (24, ("y " * 40_000)), (25, "3.5 a,b c. d" * 9), (26, "\n" + shared)]
    want = brute_passages(rows, 8, 25)
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS).repartition(5)
    got = {r["doc_id"]: r for r in substring_dedup.dedup_units(df, "clause", 8, 25).collect()}
    texts = dict(rows)
    for i, (text, gone) in want.items():
        assert (got[i]["text"] or "", got[i]["n_removed"]) == (text, gone)
        rest, at = [], 0
        for s in got[i]["removed"]:
            rest.append(texts[i][at : s["start"]])
            at = s["end"]
        assert "".join([*rest, (texts[i] or "")[at:]]) == text
    assert got[20]["text"] is None and got[21]["n_units"] == 0
    odd = [i for i in range(3, 12, 2)]
    assert all(got[i]["n_removed"] > 0 for i in odd) and all(got[i]["n_removed"] == 0 for i in range(0, 12, 2))
    assert all(got[i]["text"].startswith(common) and got[i]["text"].endswith(common) for i in range(12))


def test_lines_are_kept_once(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice("ab É c d".split()) for _ in range(rng.randint(0, 7))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    want = brute_dedup(rows, 3)
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS).repartition(5)
    got = substring_dedup.dedup_units(df, min_words=3).collect()
    assert {r["doc_id"]: (r["text"], [(s["start"], s["end"]) for s in r["removed"]]) for r in got} == want


def test_dedup_edges(spark):
    rows = [(2, "the same line here now", None, None), (1, "The SAME  line\there now\nlast", "x", "s"), (None, "the same line here now", "x", "s"),
            (3, None, "x", "s"), (4, "", "x", "s"), (1, "The SAME  line\there now\nlast", "x", "s"), (5, "one two three\n\none two three", "x", "s")]
    df = spark.createDataFrame(rows, DOCS).withColumn("removed", F.lit("clash")).withColumn("_places", F.lit(1)).drop("_places")
    got = sorted(((r["doc_id"] or 99, r["text"], r["n_removed"]) for r in substring_dedup.dedup_units(df).collect()), key=str)
    same = "The SAME  line\there now\nlast"
    assert got == sorted([(1, same, 0), (1, same, 0), (2, "", 1), (99, "", 1), (3, None, 0), (4, "", 0),
                          (5, "one two three\n\none two three", 0)], key=str)
    paragraphs = spark.createDataFrame([(1, "a b c d e\nf\n\n\na b c d e\nf", "x", "s")], DOCS)
    assert substring_dedup.dedup_units(paragraphs, "paragraph").first()["text"] == "a b c d e\nf"
    assert substring_dedup.dedup_units(df.limit(0)).count() == 0


def brute_components(rows, size=5, percent=80):
    sets = {}
    for doc, text in rows:
        w = plain_words(text)
        k = min(size, len(w))
        sets[doc] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, groups=5, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(4, 90))]
        for _ in range(copies):
            words_of = list(base)
            for _ in range(rng.randint(0, 4)):
                words_of[rng.randrange(len(words_of))] = rng.choice(vocabulary)
            rows.append(" ".join(words_of))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS).repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(df).collect()}
    assert got == brute_components(rows)


def test_groups_may_be_salted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 3)
    rows = near_copies(9)
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(df).collect()}
    assert got == brute_components(rows)


def test_second_pairing_alone_finds_all_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEADERS", 0)
    rows = near_copies(5, groups=3, copies=9)
    for k, n in enumerate((1, 4, 5, 8, 20, 40, 400)):  # sets of n and of 5n/4 members, one inside the other: at the limit, or beyond it
        long = [f"b{k}x{i}" for i in range(n * 5 // 4 + 4)]
        rows += [(1000 + 3 * k + i, " ".join(long[:len(long) - cut])) for i, cut in enumerate((0, n * 5 // 4 - n, n * 5 // 4 - n + 1))]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(df).collect()}
    assert got == brute_components(rows)


def test_sizes_that_link_are_in_neighbouring_bands(spark):
    for percent in (50, 80, 90, 100):
        n = spark.range(1, 20_001).select(F.col("id").alias("n"), F.floor(F.col("id") * 100 / percent).alias("most"))
        far = jaccard.size_band(F.col("most"), percent) - jaccard.size_band(F.col("n"), percent)
        assert n.filter(far > 1).count() == 0


def test_a_full_sketch_salts_the_frequent_only(monkeypatch):
    monkeypatch.setattr(jaccard, "SKETCH_BITS", 4)
    monkeypatch.setattr(jaccard, "GROUP", 10)
    text = pa.array([" ".join(f"v{i}" for i in range(60))])
    even = jaccard._prefixes(5, 80, type("Held", (), {"value": np.full(16, 5_000, np.int32)})())
    hot = np.full(16, 5_000, np.int32)
    hot[int(jaccard.counter_of(next(jaccard.text_sets(text, 5)))[0])] += 900
    spiked = jaccard._prefixes(5, 80, type("Held", (), {"value": hot})())
    salts = [pa.concat_arrays([b.column("salts").flatten() for b in run(iter([pa.RecordBatch.from_arrays([text], names=["text"])]))])
             .to_pylist() for run in (even, spiked)]
    assert not any(salts[0])
    frequent = np.argsort(hot[jaccard.counter_of(next(jaccard.text_sets(text, 5)))], kind="stable")[: len(salts[1])]
    assert [s > 0 for s in salts[1]] == (hot[jaccard.counter_of(next(jaccard.text_sets(text, 5)))][frequent] > 5_000).tolist()


def test_similarity_edges(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(7, "a b", "x", "s"), (3, "A  b", "x", "s"), (4, "", "x", "s"), (5, None, "x", "s"), (6, "  ", "x", "s"), (8, long, "x", "s"),
            (2, long + " end", "x", "s"), (None, "a b", "x", "s"), (3, "A  b", "x", "s"), (3, "other text", "x", "s")]
    df = spark.createDataFrame(rows, DOCS).withColumn("tie", F.lit("clash")).withColumn("n", F.lit(1))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(df).collect()), key=str)
    assert got == sorted([(7, 1, 3), (3, 1, 3), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (8, 29996, 2), (2, 29997, 2), (None, 1, 3),
                          (3, 1, 3)], key=str)
    assert jaccard.similar_documents(df.limit(0)).count() == 0


def test_chain_of_links_is_one_component(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_suffix_filter_loses_nothing():
    rng = np.random.default_rng(2)
    for _ in range(300):
        base = np.unique(rng.integers(0, 400, rng.integers(1, 120)).astype(np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 400, 8).astype(np.uint64)]))
        both = len(np.intersect1d(base, other))
        assert jaccard.linked(base, other, 80) == (100 * both >= 80 * (len(base) + len(other) - both))
