"""Decontamination, language, toxicity and page text."""

import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barlake.llm import decontaminate, html_text, langid, toxicity

DOCS = "doc_id long, text string, lang string"


def leak_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_leaks(text, items, size):
    words, hit, found = leak_words(text), set(), set()
    for item, said in items:
        w = leak_words(said)
        k = min(size, len(w))
        for window in {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else ():
            for at in range(len(words) - k + 1):
                if tuple(words[at:at + k]) == window:
                    hit |= set(range(at, at + k))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("part_bytes", [1 << 20, 40])
def test_leaks_equal_brute_force(spark, part_bytes):
    rng = random.Random(4)
    vocabulary = ["a", "B", "cé", "d1", "Ö"]
    said = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, said(n)) for i, n in enumerate((0, 1, 2, 4, 6, 3, 3))] + [(2, "d1 d1 d1")]
    docs = [(i, re.sub(" ", rng.choice([" ", ", ", "\n"]), said(rng.randint(0, 30))), "x") for i in range(40)]
    found = decontaminate.decontaminate(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), 3, part_bytes)
    for r in found.collect():
        c = r["contamination"]
        assert (c["n_words"], c["n_hit"], c["items"]) == brute_leaks(r["text"], items, 3)
        inside = " ".join(r["text"][s["start"]:s["end"]] for s in c["spans"])
        assert len(leak_words(inside)) == c["n_hit"]


def test_leak_edges(spark):
    items = spark.createDataFrame([(None, "secret words of the test"), (9, None), (10, "..."), (3, "x")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "The SECRET words, of the test!", "old"), (None, None, "old"), (2, "", "old"), (3, "a x" * 3, "old")],
                                 "doc_id long, text string, contamination string")
    got = {r["doc_id"]: (r["contamination"]["n_hit"], r["contamination"]["items"]) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: (5, []), None: (0, []), 2: (0, []), 3: (1, ["3"])}
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).filter("contamination.n_hit > 0").count() == 0


WORDS = {"en": "the and of that with house water from they have".split(),
         "de": "der und nicht über haus wasser schön zwischen ihr groß".split(),
         "es": "el los niño agua está qué señor donde también mañana".split()}


def labelled(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 40))), lang)
            for i in range(n) for lang in [rng.choice(sorted(WORDS))]]


def test_language_of_held_out_rows(spark):
    docs = spark.createDataFrame(labelled(240), DOCS)
    model = langid.fit(langid.learning_rows(docs))
    got = langid.identify(docs, model).withColumn("held", langid.hash_class(F.col("doc_id")) == 2).filter("held").collect()
    assert len(got) > 30 and all(r["lang"] == r["lang_pred"] and not r["rejected"] and 0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !!", "en"), (4, "漢字かな交じり文", "en"), (None, "the house", None)], DOCS)
    odd = odd.withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in langid.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", True) and got[4][1] and got[None] == ("en", False)
    assert langid.identify(odd, None).filter("lang_pred <> 'und' or score <> 0").count() == 0
    assert langid.fit(docs.limit(0)) is None and langid.identify(docs.limit(0), model).count() == 0


def test_short_texts_in_learned_languages_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(langid.learning_rows(docs))
    short = docs.filter(F.size(F.split(F.trim("text"), r"\s+")) <= 3).select("doc_id", "text", "lang")
    short = short.filter(F.col("text").rlike(r"\p{L}")).unionByName(
        spark.createDataFrame([(-1, "De.", "fr"), (-2, "Avec.", "fr"), (-3, "Avec", "fr")], DOCS))
    assert langid.identify(short, model).filter("rejected").select("text").collect() == []
    odd = spark.createDataFrame([(1, "漢字かな交じり文", None), (2, "漢字かな交じり文。これは日本語の文章です。" * 5, None)], DOCS)
    assert langid.identify(odd, model).filter("rejected").count() == 2


def test_every_language_has_several_centroids(spark):
    model = langid.fit(spark.createDataFrame(labelled(120), DOCS))
    assert {l: model.languages.count(l) for l in set(model.languages)} == {"en": 4, "de": 4, "es": 4}
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-4)


def toxic_rows(n, seed=5):
    rng = random.Random(seed)
    bad = ["zarg", "blim", "idiot", "scum"]
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS["en"]) for _ in range(rng.randint(5, 60))]
        label = i % 5 == 0
        if label:
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), int(label)))
    return rows


def test_toxicity_of_held_out_rows(spark):
    rows = toxic_rows(600)
    learn = spark.createDataFrame(rows[:400], "doc_id long, text string, toxic int")
    model = toxicity.fit(learn)
    held = spark.createDataFrame(rows[400:], "doc_id long, text string, toxic int")
    got = toxicity.score_toxicity(held, model).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert sum(r["predicted"] == r["toxic"] for r in got) >= 0.98 * len(got)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "the house", "x")], "doc_id long, text string, predicted string")
    scores = [r["score"] for r in toxicity.score_toxicity(odd, model).orderBy("doc_id").collect()]
    assert scores[1] == scores[2] and max(scores) < 0.3
    assert toxicity.score_toxicity(odd.limit(0), model).count() == 0
    bare = toxicity.fit(learn.limit(0))
    assert list(bare.score(pa.array(["you idiot", "a house"])) >= 0.3) == [True, False]


def test_label_model_finds_dependent_voters():
    rng = np.random.default_rng(1)
    y = rng.random(3000) < 0.2
    one = np.where(y, rng.random(3000) < 0.7, rng.random(3000) < 0.02)
    free = np.where(y, rng.random(3000) < 0.6, rng.random(3000) < 0.05)
    votes = np.column_stack([one, one, free]).astype(np.uint8)
    model = toxicity.fit_label_model(votes, y.astype(int))
    assert model.group[0] == model.group[1] != model.group[2]
    assert model.posterior(np.array([[1.0, 1, 1]]))[0] > 0.95 and model.posterior(np.array([[0.0, 0, 0]]))[0] < 0.1


@pytest.mark.parametrize("page, text", [
    (None, None), ("", ""), ("a < b &amp; c", "a < b & c"),
    ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"),
    ("<table><tr><th>Name<th>Qty<tr><td>apples<td>10</table>", "Name   | Qty\napples | 10"),
    ("<table><tr><td>a<br>b<td>c</table>x", "a | c\nb |\n\nx"),
    ("<p hidden>no</p><p style='Display: none'>no</p><script>no<p></script><style>no</style>yes", "yes"),
    ("<pre>a\n  b</pre>", "a\n  b"), ("<b>x</i>y</b> <!-- no --> z<br>w", "xy z\nw"), ("<textarea>a<b></textarea>", "a<b>"),
    ("<p>unclosed <b>bold", "unclosed bold"), ("<div><span>" * 3000 + "deep", "deep"), ("x<img alt='pic'>", "xpic"),
    ("<title>t</title><nav>menu</nav>", "menu"), ("<select><option>a<option>b</select>", "a\nb"),
])
def test_page_text(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p>so <math><semantics><mrow><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></mrow><annotation>x = 2</annotation></semantics></math> is", "so x=2 is"),
    ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr><mtr><mtd>3</mtd><mtd>4</mtd></mtr></mtable></math>", "1 2\n3 4"),
    ("a<svg><title>t</title><defs><text>d</text></defs><rect/>no<g><text x='1'>one <tspan>two</tspan></text></g>"
     "<text display='none'>h</text><foreignObject><p>three</p></foreignObject></svg>b", "a\none two\n\nthree\n\nb"),
    ("<svg><clipPath id='c'/><text>shown</text></svg>", "shown"),
    ("a<dialog open>b</dialog>c<dialog>d</dialog>", "a\nb\nc"),
    ("<map name='m'><a href='#'>left</a><area alt='x'></map>", "left"),
    ("a<xmp><b>1</b>\n  &amp;</xmp>c", "a\n\n<b>1</b>\n  &amp;\n\nc")])
def test_text_of_elements_that_browsers_show(page, text):
    assert html_text.page_text(page) == text


def test_pages_as_a_frame(spark):
    pages = spark.createDataFrame([(1, "<p>a", "clash"), (1, "<p>a", "clash"), (None, None, None)], "page_id long, html string, text string")
    got = html_text.extract_text(pages)
    assert got.columns == ["page_id", "html", "text"] and sorted(str(r["text"]) for r in got.collect()) == ["None", "a", "a"]
    assert html_text.extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_no_markup_breaks_the_page(seed):
    rng = random.Random(seed)
    tags = ["table", "tr", "td", "p", "ul", "li", "b", "div", "pre", "q", "script", "br", "select", "option"]
    for _ in range(200):
        page = "".join(rng.choice([f"<{t}>", f"</{t}>", "word ", "<", "&lt;", "<!--"]) for t in rng.choices(tags, k=25))
        assert isinstance(html_text.page_text(page), str)


@pytest.mark.parametrize("page, text", [
    ('<ol start="--1"><li>a', "1. a"), ('<ol start="\u00b2"><li>a', "1. a"), (f'<ol start="{"9" * 5000}"><li>a', "1. a"),
    ("<ol start=-3><li>a<li>b", "-3. a\n-2. b"), ('<table><tr><td colspan="\u00b2">a<td>b</table>', "a | b"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d</table>", "a | b\n  | c\nd"),
    ("<details><summary>s</summary>body</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
    ('<div style="visibility:hidden">no<b style="visibility: visible">yes</b>no</div>z', "yes\nz"),
    ('<div style="visibility:hidden">no<img alt=no><hr></div>z', "z"),
])
def test_numbers_spans_and_inherited_visibility(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<b>" * 50_000 + "<p>y" * 50_000, "<ul><li>" * 50_000 + "z", "<span>" * 50_000 + "</i>" * 50_000,
                                  "<table><tr><td>" * 3_000 + "q", "<table><tr>" + "<td>c" * 50_000])
def test_deep_and_wide_pages_end(page):
    start = time.process_time()
    html_text.page_text(page)
    assert time.process_time() - start < 20


# A page is generated with its text: what each element adds is known when it is written.
def generated(rng, depth=0):
    """(html, list of lines) of some blocks; end tags that may be left out are left out at times."""
    word = lambda: rng.choice(["one", "two &amp; <i>in</i>", "thr<b>ee</b>", "f&eacute;", "<!-- no -->x", "<span hidden>no</span>y"])
    plain = lambda said: html_text.html.unescape(re.sub(r"<!--.*?-->|<span hidden>.*?</span>|<[^>]*>", "", said))
    out, lines = [], []
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["p", "div", "ul", "ol", "table", "hr"] if depth < 2 else ["p"])
        said = " \n".join(word() for _ in range(rng.randint(1, 5)))
        text = " ".join(plain(said).split())
        if kind == "hr":
            out.append("<hr>")
            block, edge = ["---"], 2
        elif kind == "p":
            out.append(f"<p>{said}" + rng.choice(["</p>", ""]))
            block, edge = [text], 2
        elif kind == "div":
            inner, inside = generated(rng, depth + 1)
            out.append(f"<div>{said}<section>{inner}</section></div>")
            block, edge = [text, *([""] if inside and inside[0] == "" else []), *strip(inside)], 1
        elif kind == "table":
            cells = [[word() for _ in range(2)] for _ in range(rng.randint(1, 3))]
            end = rng.choice(["</td>", ""])
            out.append("<table>" + "".join("<tr>" + "".join(f"<td>{c}{end}" for c in row) for row in cells) + "</table>")
            shown = [[" ".join(plain(c).split()) for c in row] for row in cells]
            width = max(len(r[0]) for r in shown)
            block, edge = [f"{a.ljust(width)} | {b}".rstrip() for a, b in shown], 2
        else:
            items = [word() for _ in range(rng.randint(1, 3))]
            out.append(f"<{kind}>" + "".join(f"<li>{i}" for i in items) + f"</{kind}>")
            block = [(f"{k}. " if kind == "ol" else "- ") + " ".join(plain(i).split()) for k, i in enumerate(items, 1)]
            edge = 2
        lines.append((block, edge))
    flat: list[str] = []
    for k, (block, edge) in enumerate(lines):
        if flat and max(edge, lines[k - 1][1]) == 2 and flat[-1] != "":
            flat.append("")
        elif not flat and edge == 2:
            flat.append("")
        flat += block
        if k + 1 == len(lines) and edge == 2:
            flat.append("")
    return "".join(out), flat


def strip(lines):
    return lines[1:] if lines and lines[0] == "" else lines


@pytest.mark.parametrize("seed", range(60))
def test_generated_pages_have_the_text_they_were_made_from(seed):
    page, lines = generated(random.Random(seed))
    text = re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")
    assert html_text.page_text(page) == text


def plain_languages(learning, texts, clusters):
    """Predictions by a plain loop: log counts of hashed n-grams times idf, the same seeding of centroids, the best cosine."""
    grams = lambda t: next(iter(langid.counts(pa.array([t], pa.string()))))[1][0].astype(float)
    seen = [grams(t) for t, _ in learning]
    idf = [math.log((1 + len(seen)) / (1 + sum(1 for s in seen if s[k]))) + 1 for k in range(len(seen[0]))]

    def unit(found):
        v = [math.log1p(c) * w if c else 0.0 for c, w in zip(found, idf)]
        size = math.sqrt(sum(x * x for x in v)) or 1.0
        return np.array([x / size for x in v])

    cosine = lambda a, b: float(np.dot(a, b))
    centres = []
    for lang in sorted({name for _, name in learning}):
        rows = [unit(s) for s, (_, name) in zip(seen, learning) if name == lang]
        mean = sum(rows) / len(rows)
        chosen = [max(range(len(rows)), key=lambda i: cosine(rows[i], mean))]
        while len(chosen) < min(clusters, len(rows)):
            chosen.append(min(range(len(rows)), key=lambda i: max(cosine(rows[i], rows[c]) for c in chosen)))
        found = [rows[i] for i in chosen]
        for _ in range(12):
            owner = [max(range(len(found)), key=lambda k: cosine(r, found[k])) for r in rows]
            for k in range(len(found)):
                own = [r for r, o in zip(rows, owner) if o == k]
                total = sum(own) if own else found[k]
                found[k] = total / np.linalg.norm(total)
        centres += [(c, lang) for c in found]
    best = [max(((cosine(unit(grams(t)), c), lang) for c, lang in centres)) for t in texts]
    return best


def test_languages_equal_a_plain_loop(spark):
    rng = random.Random(6)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "xyzabé"}
    said = lambda a: " ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(4, 20)))
    learning = [(said(a), lang) for lang, a in alphabets.items() for _ in range(12)]
    df = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(learning)] * 2, DOCS)  # repeated rows count once in the sample
    model = langid.fit(df, clusters=3)
    texts = [said(a) for a in alphabets.values() for _ in range(6)]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS), model).collect()}
    # document frequencies are of all rows, repeated ones too; the ratio keeps the idf nearly the same
    for i, (score, lang) in enumerate(plain_languages(learning * 2, texts, 3)):
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 0.02


def test_sample_of_languages_is_bounded_in_rows(spark, monkeypatch):
    rows = [(7, f"text {i} of one id", "aa") for i in range(400)] + [(7, "text of one row", "aa")] * 400 + [(i, f"other {i}", "bb") for i in range(50)]
    seen = []
    monkeypatch.setattr(langid, "short_floors", lambda heads, *rest: seen.append(len(heads)) or np.full(langid.BANDS, 0.1))
    langid.fit(spark.createDataFrame(rows, DOCS), sample=40)
    assert 20 < seen[0] <= 40


def test_toxicity_equals_a_plain_loop():
    rng = random.Random(3)
    votes = np.array([[int(rng.random() < (0.5 if toxic else 0.05)) for _ in range(5)] for toxic in [1] * 40 + [0] * 120], np.uint8)
    labels = np.array([1] * 40 + [0] * 120)
    words = [np.array([rng.getrandbits(64) for _ in range(rng.randint(0, 6))], np.uint64) for _ in labels]
    model = toxicity.fit_label_model(votes, labels)
    target = model.posterior(votes.astype(float))
    for row, p in zip(votes, target):  # Bayes, one group after another
        on, off = model.prior, 1 - model.prior
        for g in range(len(model.on_toxic)):
            fired = min(sum(int(v) for v, own in zip(row, model.group) if own == g), toxicity.LEVELS - 1)
            on, off = on * model.on_toxic[g][fired], off * model.on_clean[g][fired]
        assert abs(on / (on + off) - p) < 1e-9
    a, b, c = toxicity.train_linear(votes, words, target, rounds=25)
    x, y, z, steps = [0.0] * 5, {}, -2.0, [[0.0] * 5, {}, 0.0]
    for _ in range(25):
        gx, gy, gz = [1e-5 * v for v in x], {k: 1e-3 * v for k, v in y.items()}, 0.0
        for row, said, p in zip(votes, words, target):
            places = [int(h) >> 50 for h in said]
            margin = z + sum(int(v) * w for v, w in zip(row, x)) + (sum(y.get(k, 0.0) for k in places) / len(places) if places else 0)
            gap = (1 / (1 + math.exp(-margin)) - p) / len(votes)
            gx = [g + gap * int(v) for g, v in zip(gx, row)]
            gz += gap
            for k in places:
                gy[k] = gy.get(k, 0.0) + gap / len(places)
        steps[0] = [0.9 * s - 2 * g for s, g in zip(steps[0], gx)]
        steps[1] = {k: 0.9 * steps[1].get(k, 0.0) - 2 * gy.get(k, 0.0) for k in {*gy, *steps[1]}}
        steps[2] = 0.9 * steps[2] - 2 * gz
        x = [v + s for v, s in zip(x, steps[0])]
        y = {k: y.get(k, 0.0) + s for k, s in steps[1].items()}
        z += steps[2]
    assert np.allclose(a, x, atol=1e-9) and abs(c - z) < 1e-9
    assert all(abs(b[k] - v) < 1e-9 for k, v in y.items())
