"""Whitening, fingerprint links and the prefix trie against plain Python."""

import math
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barlake.llm import prefix_trie, simhash, whitening
from barlake.llm.queries import QUERIES
from tests.llm.test_text_and_dedup import plain_words

# ---------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<double>, label int, x string"


def plain_whitening(rows, keep):
    """{row place: (deviation, whitened)}, explained shares; rows of (vec_id, vector), all usable."""
    grid = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    fit = sorted(set(map(tuple, grid)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in grid]
    own = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in grid])
    return n, deviations, own @ axes[:, :keep] / np.sqrt(values[:keep]), values[:keep] / values.sum()


@pytest.mark.parametrize("scale, count", [(1, 300), (1e5, 90), (1e13, 40)])
def test_whitening_equals_plain_integers(spark, scale, count):
    rng = random.Random(count)
    spread = [rng.uniform(0.2, 3) for _ in range(6)]
    rows = [(i, [rng.gauss(0, s) * scale for s in spread]) for i in range(count)]
    rows += [(1000 + i, v) for i, v in rows[:20]] + [(None, rows[0][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], VECTORS).repartition(7)
    got = whitening.whiten(df, 4).collect()
    n, deviations, whitened, explained = plain_whitening(rows, 4)
    assert len(got) == len(rows) and {r["n"] for r in got} == {n == count and count}
    want = sorted(zip(deviations, whitened.tolist()))
    flips = None
    for r, (deviation, values) in zip(sorted(got, key=lambda r: r["deviation"]), want):
        assert int(r["deviation"]) == deviation
        flips = flips or [math.copysign(1, a * b) for a, b in zip(r["whitened"], values)]
        assert np.allclose(r["whitened"], np.array(values) * flips, rtol=1e-8, atol=1e-9)
        assert np.allclose(r["explained"], explained, rtol=1e-8) and r["identity_error"] < 1e-8


def test_bit_slices_give_exact_products():
    rng = np.random.default_rng(5)
    for top in (1, 2, 200, 2**31, 2**62):
        values = rng.integers(0, top, (131, 5), dtype=np.uint64)
        values[:, 3] = 0
        wide = values.astype(object)
        assert (whitening.cross_products(values) == wide.T @ wide).all()
    for value in (0, 1, -1, 2**30, -(2**30), 2**200 + 7, -(2**133) + 5):
        assert sum(part << 30 * place for place, part in whitening.limbs(value)) == value


def test_whitening_leaves_out_what_it_says(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (7, []),
            (8, [1e300, 0.0]), (9, [1.0, 3.0]), (9, [1.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], VECTORS)
    got = whitening.whiten(df).collect()
    assert sorted(r["vec_id"] for r in got) == [0, 1, 9, 9]
    assert all(r["n"] == 3 and r["whitened"][1] is None and r["explained"] == [1.0, 0.0] for r in got)
    same = whitening.whiten(df.filter("vec_id = 9")).collect()
    assert [(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in same] == [([None, None], [None, None], None, 0)] * 2
    assert whitening.whiten(df.filter("vec_id in (2, 3)")).count() == 0 and whitening.whiten(df.limit(0)).columns == whitening.whiten(df).columns


# ---------------------------------------------------------------- fingerprints

DOCS = "doc_id long, text string, fp string, component_id string"


def plain_fingerprint(text):
    words = plain_words(text)
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(find(i), []).append(x)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [low[find(i)] for i in range(len(ids))]


def test_fingerprints_of_whole_texts(spark, monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "one", "One two", "A b c", "É\x1cé\x85ß Öl \U0001f600 x", "x" * 5000, " ".join(rng.choice("abc") * rng.randint(1, 9) for _ in range(900)),
             "a b c d " * 400, "w" * 300 + "\n" + "v\x0bu " * 90]
    monkeypatch.setattr(simhash, "STRETCH", 64)
    assert [simhash.fingerprint((t or "").encode()) % 2**64 for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.undo()
    assert [simhash.fingerprint((t or "").encode()) % 2**64 for t in texts] == [plain_fingerprint(t) for t in texts]
    # the engine's own XXH64 says the same of one run
    hashed = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert hashed == simhash.fingerprint(b"One Two three")


def test_links_are_those_of_all_pairs(spark):
    rng = random.Random(7)
    hot = 0x0123456789ABCDEF
    fps = [rng.getrandbits(64) for _ in range(60)] + [0, 1, 3, 7, 2**63, 2**63 + 1, 2**64 - 1]
    fps += [hot ^ (rng.getrandbits(16) << 48) for _ in range(60)]  # two free bytes: one long list
    for base in rng.sample(fps, 30):
        for _ in range(3):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            fps.append(base)
    fps = sorted(set(fps))
    want = plain_components(range(len(fps)), fps)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    place = {x: i for i, x in enumerate(signed)}
    for longest in (simhash.LIST, 3, 1):
        found = [(r["a"], r["b"]) for r in simhash.links(frame, longest).collect()]
        root = list(range(len(fps)))
        for _ in fps:
            for a, b in found:
                low = min(root[place[a]], root[place[b]])
                root[place[a]] = root[place[b]] = low
        assert root == want


def test_documents_get_their_components(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(60)) for _ in range(12)]
    texts = base + [t.upper() for t in base[:4]] + [t + " z" for t in base] + [None, "", "  ", base[0], base[0]]
    ids = [*range(len(texts) - 2), None, 3]
    rows = list(zip(ids, texts))
    df = spark.createDataFrame([(i, t, "no", "no") for i, t in rows], DOCS).repartition(4)
    got = sorted(((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in simhash.simhash_components(df).collect()), key=str)
    fps = [plain_fingerprint(t) for t in texts]
    assert got == sorted(zip(ids, fps, plain_components(ids, fps)), key=str)
    assert simhash.simhash_components(df.limit(0)).count() == 0


# ---------------------------------------------------------------- trie

TURNS = "conv_id long, turn long, role string, text string, node string, parent string"


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    name = lambda t: (t[0], t[1], sha256(f"{len(t[2])}\n{t[2]}\n{t[3]}".encode()).hexdigest())
    own = {c: [t[2:] for t in sorted(turns, key=name)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, m in members.items():
        below = [v for v in members if v[: len(node)] == node]
        kids = [v for v in below if len(v) == len(node) + 1]
        leaves = [v for v in below if not any(w[: len(v)] == v for w in below if len(w) == len(v) + 1)]
        saved = sum((len(members[v]) - 1) * len([w for w in plain_words(v[-1][1])]) for v in below if v)
        said = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids), len(leaves), saved,
                    sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def found_trie(spark, rows):
    df = spark.createDataFrame([(*r, "no", "no") for r in rows], TURNS).repartition(5)
    trie = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.conversations(df)))
    return sorted(map(tuple, trie.collect()), key=repr)


@pytest.mark.parametrize("members, turns", [(1024, 1 << 17), (3, 1 << 17), (1024, 9)])
def test_trie_equals_plain_prefixes(spark, monkeypatch, members, turns):
    # task workers read the module afresh, so limits travel as arguments of the step
    rng = random.Random(4)
    texts = ["", "yes", "no  no", "tell me\tmore", None]
    rows = [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(texts))
            for c in [*range(60), *range(-25, 0, 3), 10**12, 2**63 - 1] for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", "the same") for c in range(100, 160) for t in range(3)]
    rows += [(None, 0, "user", "nobody"), (7, 1, "user", "again"), (7, 1, "user", "again")]
    monkeypatch.setattr(prefix_trie, "_counted", lambda b, f=prefix_trie._counted: f(b, members, turns))
    monkeypatch.setattr(prefix_trie, "_summed", lambda b, f=prefix_trie._summed: f(b, members, turns))
    assert found_trie(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_trie_of_little(spark):
    assert found_trie(spark, [(None, 0, "user", "x")]) == []
    one = [(21, 0, "user", "x")]  # its first turns come from conversation 20, which is not there
    assert found_trie(spark, one) == plain_trie(plain_rebuilt(one))


def test_long_conversations_end(spark):
    rows = [(c, t, "user", f"turn {t} and {t % 7}") for c in (0, 1, 40) for t in range(5000)]
    got = found_trie(spark, rows)
    assert len(got) == 5001 + sum(5000 for c in (1,) if plain_rebuilt(rows)[c] != plain_rebuilt(rows)[0])
    top = next(r for r in got if r[1] == 0)
    assert top[3] == 3 and top[5] == 1 and top[6] == 2 * 5000 * 4


def test_queries_give_the_columns_of_their_contract(spark):
    for name, columns in (("op11_whitening", "vec_id component n deviation whitened explained identity_error"),
                          ("op12_simhash_dedup", "doc_id fingerprint component_id")):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").columns == columns.split()
