"""Neighbours, mixing, chat formats and token files."""

import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barlake.llm import chat, mixing, neighbours, token_store
from barlake.llm.queries import tokenizer_path

VECTORS = "vec_id long, embedding array<float>"


def brute_nearest(ids, rows, queries, k):
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    out = {}
    for q in queries:
        at = ids.index(q)
        scores = unit @ unit[at]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))[:k]
        out[q] = [ids[i] for i in order]
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], VECTORS)
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect()
    want = brute_nearest(list(range(3000)), rows.astype(float), range(0, 3000, 50), 5)
    hits = sum(r["vec_id"] in want[r["query_id"]] for r in got)
    assert hits >= 0.9 * 5 * len(want) and {r["rank"] for r in got} <= {1, 2, 3, 4, 5}
    a = rows.astype(float)
    for r in got[:50]:
        x, y = a[r["query_id"]], a[r["vec_id"]]
        assert abs(r["score"] - x @ y / np.sqrt((x @ x) * (y @ y))) < 1e-12


@pytest.mark.parametrize("part_rows", [50_000, 7])
def test_neighbour_edges(spark, monkeypatch, part_rows):
    monkeypatch.setattr(neighbours, "PART_ROWS", part_rows)
    good = [(i, [1.0, 0.0, 0.0]) for i in range(40)] + [(50, [1.0, 0.1, 0.0]), (100, [0.9, 0.2, 0.1])]
    bad = [(60, None), (61, [0.0, 0.0, 0.0]), (62, [float("nan"), 1.0, 0.0]), (63, [float("inf"), 1.0, 0.0]), (64, [None, 1.0, 1.0]),
           (65, [1.0]), (None, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, VECTORS).withColumn("query", F.lit(1)).withColumn("keys", F.lit("x"))
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4] and got[100][0] == 50 and len(got[100]) == 5
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], VECTORS)
    assert [(r["vec_id"], round(r["score"], 9)) for r in neighbours.nearest(two, F.col("vec_id") == 0).collect()] == [(1, 0.8)]


@pytest.mark.parametrize("part_rows, query_rows", [(50_000, 10_000), (40, 3)])
def test_outlier_queries_find_all_that_are_due(spark, monkeypatch, part_rows, query_rows):
    monkeypatch.setattr(neighbours, "PART_ROWS", part_rows)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", query_rows)
    rng = np.random.default_rng(5)
    cluster = rng.normal(size=64) + 0.01 * rng.normal(size=(300, 64))
    cluster[1] = cluster[0]
    far = -cluster[:8] + 0.5 * rng.normal(size=(8, 64))
    rows = np.concatenate([cluster, far])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, (F.col("vec_id") >= 300) | (F.col("vec_id") == 7)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = brute_nearest(list(range(308)), rows, [7, *range(300, 308)], 10)
    assert set(got) == set(want) and all([n for n, _ in x] == [1, 2, 3, 4, 5] for x in got.values())
    lone = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows[:301])], "vec_id long, embedding array<double>")
    found = neighbours.nearest(lone, F.col("vec_id") == 300).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == brute_nearest(list(range(301)), rows[:301], [300], 5)[300]


@pytest.mark.parametrize("n", range(3, 9))
def test_small_tables_give_all_candidates(spark, n):
    rng = np.random.default_rng(n)
    rows = rng.normal(size=(n, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], VECTORS)
    got = {}
    for r in neighbours.nearest(df, F.lit(True), tables=1, probes=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {q: len(x) for q, x in got.items()} == {q: min(5, n - 1) for q in range(n)}
    if n <= 6:  # all others are due, so their order is known
        assert got == brute_nearest(list(range(n)), rows.astype(float), range(n), 5)


def test_probes_come_in_order_of_success():
    found = neighbours.perturbations(6, 60)
    assert found[0] == () and len(set(found)) == 60
    assert all(11 - j not in p for p in found for j in p)


def brute_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, budget, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = budget / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            budget -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed, chunk", [(1, 10_000), (2, 7)])
def test_mix_meets_its_targets(spark, seed, chunk):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), rng.choice(["b", "a", "é", None, "z"]), rng.choice([None, 0.5, 2.0, -1.0]))
            for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double").repartition(3)
    got = mixing.mix(df, "quality", chunk=chunk).collect()
    again = mixing.mix(df.repartition(7), "quality", chunk=chunk).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    sizes, taken = {}, {}
    for r in got:
        assert r["size"] == len(r["text"].split()) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    want = brute_targets(sizes)
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
    assert all(abs(taken[s] - want[s]) <= 20 for s in want)
    assert mixing.materialise(mixing.mix(df, "quality")).count() == sum(r["copies"] for r in got)


def test_mix_edges(spark):
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (None, "one two", None, "x"), (3, "one", "b", "x"), (3, "one", "b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    got = {(r["doc_id"], r["size"]): r["source_size"] for r in mixing.mix(df).collect()}
    assert got == {(1, 0): 0, (2, 0): 0, (None, 2): 2, (3, 1): 2}
    assert mixing.mix(df.limit(0)).count() == 0


def test_better_documents_come_first(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b", 8.0 if i % 4 < 2 else 0.125) for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, quality double"), "quality", weights=(1.0,), share=0.5)
    by = {r["quality"]: r["n"] for r in got.groupBy("quality").agg(F.sum("taken").alias("n")).collect()}
    assert by[8.0] > 9 * by[0.125]


CHAT = "conv_id long, turn long, role string, text string"


def test_chats_can_be_read_back(spark):
    rng = random.Random(1)
    pieces = ["</s>", "[INST]", " [/INST]", "\\", "\\l", "<s>", "]", "é", "x", "<<SYS>>", "\n", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool[x]", ""]), "".join(rng.choices(pieces, k=5)))
            for c in range(30) for t in range(rng.randint(1, 7))]
    df = spark.createDataFrame(rows, CHAT).repartition(5)
    for r in chat.format_chats(df).collect():
        mine = [(role, text) for c, t, role, text in sorted(rows) if c == r["conv_id"]]
        assert chat.read_back(r["formatted"]) == mine and r["rewritten_at"] is None
        loss = [chat.unescape(r["formatted"][s["start"]:s["end"]]) for s in r["loss_spans"]]
        assert loss == [text for role, text in mine if role == "assistant"]
        assert "".join(r["formatted"][s["start"]:s["end"]] for s in r["turn_spans"]) == r["formatted"]


def test_templates_that_rewrite_history_are_found():
    def last_only(turns):
        return "".join(f"{r}:{t}|" if k == len(turns) - 1 else f"{r}|" for k, (r, t) in enumerate(turns))

    def stripping(turns):
        return "".join(f"<{r}>{t.strip()}</>" for r, t in turns)

    assert chat.locate([("user", "a"), ("assistant", "b")], last_only)[3] == 1
    assert chat.locate([("user", "a"), ("assistant", "b")], chat.bracket_template)[3] is None
    assert chat.locate([("user", "a"), ("assistant", " b ")], stripping)[2] == [(21, 22)]


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "q"), (None, 0, "user", "lost"), (1, None, "user", "first"), (1, 1, "assistant", None)]
    df = spark.createDataFrame(rows, CHAT).withColumn("formatted", F.lit("clash"))
    got = {r["conv_id"]: chat.read_back(r["formatted"]) for r in chat.format_chats(df).collect()}
    assert got == {1: [("user", "first"), ("", "q"), ("assistant", ""), ("assistant", "")], None: [("user", "lost")]}
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


TRICKY = ["", " ", " a", "a  b", "a \n b", "x <|endoftext|> y", "don't, won't.", "É, é. é,", "tab\tx y  ", "1, 2. a1.", "\n\n a", "word " * 3000]


def test_pieces_give_the_ids_of_the_whole(monkeypatch):
    enc = token_store.PieceEncoder(tokenizer_path())
    rng = random.Random(2)
    monkeypatch.setattr(token_store, "PIECES_KEPT", 40)
    texts = TRICKY + ["".join(rng.choices(["ab", " ", "é", ".", ",", "\n", "1", "'s", " ", " the"], k=rng.randint(1, 30))) for _ in range(300)]
    for _ in range(2):
        ids, sizes = enc.encode(pa.array([*texts, None]))
        ends = np.cumsum(sizes)
        want = [e.ids for e in enc.tokenizer.encode_batch([*texts, ""], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends - sizes, ends)] == want


def test_new_pieces_are_encoded_together():
    enc = token_store.PieceEncoder(tokenizer_path())
    plain, given = enc.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    enc.tokenizer = Counted()
    words = [f"w{n:x}é{'.,x'[n % 3]}" for n in range(400)]
    text = " ".join(words) + "\n" + "\n".join(words[::7])
    ids, sizes = enc.encode(pa.array([text, text]))
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids * 2 and sizes.tolist() == [len(ids) // 2] * 2
    assert len(given) < 10  # one head a text, and the rest in one


@pytest.mark.parametrize("n", [0, 1, token_store.LANES, token_store.LANES + 1, token_store.CHECKPOINT + 77])
def test_blocks_round_trip_from_every_checkpoint(n):
    ids = (np.random.default_rng(n).zipf(1.4, n) % 700).astype(np.uint32)
    freq = token_store.scaled_frequencies(np.bincount(ids, minlength=701))
    states, positions, words = token_store.encode_block(ids, freq)
    if not n:
        return
    decoder = token_store.Decoder(freq)
    for mark in range(len(states)):
        assert (decoder.decode(states, positions, words, n, mark) == ids[mark * token_store.CHECKPOINT:]).all()
    assert (decoder.decode(states, positions, words, n, 0, n // 2) == ids[: n // 2]).all()


def test_rare_ids_keep_a_place():
    counts = np.array([10**12, 1, 0, 1])
    freq = token_store.scaled_frequencies(counts)
    assert freq.sum() == 1 << token_store.SCALE_BITS and freq[1] == freq[3] == 1 and freq[2] == 0


def test_store_equals_plain_encoding(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 50)
    rows = [(i * 7 % 23, t) for i, t in enumerate(TRICKY)] + [(None, "no id"), (5, None), (5, None), (99, "x y z. " * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(4)
    store = str(tmp_path / "store")
    token_store.write_token_store(df, store, tokenizer_path())
    tokenizer = token_store.encoder(tokenizer_path()).tokenizer
    got = token_store.read_token_store(spark, store).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    want = sorted((d is not None, d or 0, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    row = spark.read.parquet(f"{store}/blocks").first().asDict()
    with pytest.raises(ValueError, match="damaged"):
        token_store.block_arrays(row | {"words": bytes(row["words"])[:-1] + b"?"})


def test_empty_store(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_store.write_token_store(df, str(tmp_path / "s"), tokenizer_path())
    assert token_store.read_token_store(spark, str(tmp_path / "s")).count() == 0


def test_read_back_refuses_what_it_did_not_write():
    with pytest.raises(ValueError):
        chat.read_back("no mark <")
    assert re.fullmatch(r"[^<\[]*", chat.escape("</s>[INST]"))


def test_long_conversations_end():
    turns = [("user" if k % 2 == 0 else "assistant", f"some [text] {k} of <turn>") for k in range(5000)]
    start = time.process_time()
    formatted, spans, loss, broken = chat.locate(turns, chat.bracket_template)
    assert time.process_time() - start < 60 and broken is None and chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def test_common_beginnings():
    for a, b, n in (("", "", 0), ("abc", "abd", 2), ("abc", "abc", 3), ("abc", "ab", 2), ("xbc", "ybc", 0)):
        assert all(chat._common(a, b, likely) == n for likely in range(4))


def test_repeated_rows_spread_over_the_ranges_of_the_store(spark, tmp_path):
    df = spark.createDataFrame([(5, "the same text")] * 400 + [(None, "none"), (1, None)], "doc_id long, text string").repartition(8)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    token_store.write_token_store(df, str(tmp_path), tokenizer_path())
    spark.conf.set(key, before)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_store.read_token_store(spark, str(tmp_path), keep_ids=False).collect())
    assert [d for _, d, _ in got] == [None, 1] + [5] * 400
    assert all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:]))
    assert spark.read.parquet(f"{tmp_path}/blocks").select("shard").distinct().count() > 1


def test_rows_without_an_id_are_drawn_apart(spark):
    rows = [(None, f"word {i}", "a", "x") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(df, share=0.5).collect()
    assert 0 < sum(r["copies"] for r in got) < 200
