"""Toxicity by weak supervision: many small voters, a generative label model, a linear classifier.

Voters vote toxic or abstain. Lexicon voters fire on a word: the seed words
below, and words found in a sample of labelled learning rows (much more frequent
in toxic ones). Pattern voters fire on shapes: address followed by an insult,
shouting, piled exclamation marks, repeated words. The label model estimates by
expectation maximisation how often each voter fires on either class, finds pairs
of voters that fire together more than both classes explain, and lets each group
of such voters count as one. Its posteriors are the targets of a logistic
classifier over the votes and hashed words; the labels of learning rows choose
the words and are one more voter while the model is fitted.

The sample is at most ``SAMPLE`` labelled learning rows, drawn by a hash of the
document id. Scoring covers whole texts in batches of words as arrays.

Null and empty texts have no vote and get the score of the bare intercept, as
any text without evidence. Equal texts get equal scores. Without labelled rows
the seed words and default rates stand in. All columns of the documents are
kept; those named as result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.text import FOLD, column_bytes, shingle_hashes, slices, word_bounds, word_hashes

SAMPLE = 10_000
SAMPLE_BYTES = 1 << 26
THRESHOLD = 0.3
TRUST = 0.95
HASHED = 1 << 14
MINED_SHARE = 0.01
MINED_RATIO = 20.0
RESULTS = ("score", "predicted")

# Seed words of the lexicon voters.
SEED_WORDS = (
    "abuse", "arschloch", "awful", "bastard", "blöd", "clown", "coward", "creep", "cretin", "débile", "depp",
    "disgusting", "dreck", "dumb", "dummkopf", "estúpido", "fool", "freak", "garbage", "idiot", "idiota", "idiote",
    "ignorant", "imbecile", "imbécil", "imbécile", "inútil", "jerk", "kill", "liar", "loser", "lowlife", "maggot",
    "moron", "nasty", "parasite", "pathetic", "repulsive", "ridiculous", "scum", "scumbag", "stupid", "stupide",
    "trash", "ugly", "vermin", "worthless", "wretch",
)
# Words of address before an insult.
ADDRESS_WORDS = ("you", "your", "du", "ihr", "tu", "vous", "eres", "sois")

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
PATTERNS = ("address", "shouting", "exclaiming", "echo")


def hashes_of_bytes(words) -> np.ndarray:
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    return word_hashes(np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends)


def hashes_of(words) -> np.ndarray:
    return hashes_of_bytes([w.encode() for w in words])


def row_features(column: pa.Array, lexicon: np.ndarray, address: np.ndarray):
    """For each row: word hashes, and a vote (0 or 1) of every lexicon word and pattern."""
    order = np.argsort(lexicon)
    known = lexicon[order]
    data, bounds = column_bytes(column)
    for first, last in slices(bounds):
        part = data[bounds[first] : bounds[last]]
        limits = bounds[first : last + 1] - bounds[first]
        starts, ends = word_bounds(part, limits, _ALNUM)
        hashes = word_hashes(part, starts, ends)
        at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
        hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
        spoken = np.isin(hashes, address)
        upper = np.concatenate(([0], np.cumsum((part >= 65) & (part <= 90))))
        letters = np.concatenate(([0], np.cumsum(_ALNUM[part] & ~((part >= 48) & (part <= 57)))))
        marks = np.concatenate(([0], np.cumsum(part == 33)))
        cuts = np.searchsorted(starts, limits)
        for row in range(last - first):
            a, b = cuts[row], cuts[row + 1]
            votes = np.zeros(len(lexicon) + len(PATTERNS), np.uint8)
            here = hit[a:b]
            votes[order[at[a:b][here]]] = 1
            lo, hi = limits[row], limits[row + 1]
            n = letters[hi] - letters[lo]
            near = spoken[a:b]
            votes[len(lexicon) + 0] = bool(len(here) > 1 and (
                (near[:-1] & here[1:]).any() or (near[:-2] & here[2:]).any() or (near[:-3] & here[3:]).any()))
            votes[len(lexicon) + 1] = n >= 20 and (upper[hi] - upper[lo]) > 0.6 * n
            votes[len(lexicon) + 2] = (marks[hi] - marks[lo]) > max(3, 0.2 * (b - a))
            votes[len(lexicon) + 3] = b - a >= 4 and (hashes[a + 1 : b] == hashes[a : b - 1]).mean() > 0.2
            yield first + row, hashes[a:b], votes


# ------------------------------------------------------------------ label model


LEVELS = 4  # a group of dependent voters says 0, 1, 2 or more of its members fired


@dataclass(frozen=True)
class LabelModel:
    """Chances of what each group of voters says on a toxic and on a clean text."""

    prior: float
    group: np.ndarray  # of each voter
    on_toxic: np.ndarray  # group x LEVELS
    on_clean: np.ndarray

    def said(self, votes: np.ndarray) -> np.ndarray:
        member = np.zeros((len(self.group), len(self.on_toxic)))
        member[np.arange(len(self.group)), self.group] = 1
        return np.minimum(votes @ member, LEVELS - 1).astype(int)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.on_toxic / self.on_clean)
        odds = np.log(self.prior / (1 - self.prior)) + ratio[np.arange(len(ratio)), self.said(votes)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def dependent_groups(votes: np.ndarray, weight: np.ndarray, toxic: np.ndarray, least: float = 0.15) -> np.ndarray:
    """A number for each voter; voters that fire together more than both classes explain share one."""
    fired = weight @ votes
    rate = [(weight * p) @ votes / max((weight * p).sum(), 1e-9) for p in (toxic, 1 - toxic)]
    centred = votes - np.outer(toxic, rate[0]) - np.outer(1 - toxic, rate[1])
    cov = (centred * weight[:, None]).T @ centred / weight.sum()
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    linked = (cov / np.outer(spread, spread) > least) & (np.minimum.outer(fired, fired) >= 5)
    group = np.arange(votes.shape[1])
    while True:
        lower = np.minimum(group, np.where(linked, group[None, :], len(group)).min(axis=1))
        if (lower == group).all():
            return np.unique(group, return_inverse=True)[1]
        group = lower


def fit_label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation maximisation, first with every voter alone, then with the dependent groups found.

    The label of a learning row is one more voter, right in ``TRUST`` of all rows;
    it is there only while the model is fitted. Smoothing keeps every chance above zero.
    """
    prior = float(np.clip(labels.mean() if len(labels) else 0.05, 0.01, 0.5))
    n, m = votes.shape
    if not n:
        even = np.full((m, LEVELS), 1 / LEVELS)
        return LabelModel(prior, np.arange(m), even, even)
    patterns, times = np.unique(np.column_stack([votes, labels]), axis=0, return_counts=True)
    x, label, w = patterns[:, :-1].astype(float), patterns[:, -1], times.astype(float)
    hint = np.where(label > 0, 1.0, -1.0) * np.log(TRUST / (1 - TRUST))
    first = np.where(label > 0, TRUST, 1 - TRUST)

    def settle(group: np.ndarray) -> LabelModel:
        size = int(group.max()) + 1
        empty = np.ones((size, LEVELS))
        said = LabelModel(prior, group, empty, empty).said(x)
        kinds = [(said == v).astype(float) for v in range(LEVELS)]
        spread = np.tile([0.94, 0.03, 0.02, 0.01], (size, 1))
        p = first
        for _ in range(rounds):
            tables = []
            for mass in (w * p, w * (1 - p)):
                table = np.stack([mass @ k for k in kinds], axis=1) + spread
                tables.append(table / table.sum(axis=1, keepdims=True))
            share = float((w * p).sum() / w.sum())
            model = LabelModel(float(np.clip((prior + share) / 2, 0.005, 0.6)), group, *tables)
            p = informed(model)
        return model

    def informed(model: LabelModel) -> np.ndarray:
        p = np.clip(model.posterior(x), 1e-9, 1 - 1e-9)
        return 1 / (1 + np.exp(-(np.log(p / (1 - p)) + hint)))

    return settle(dependent_groups(x, w, informed(settle(np.arange(m)))))


# ------------------------------------------------------------------- classifier


@dataclass(frozen=True)
class Model:
    lexicon: np.ndarray
    address: np.ndarray
    vote_weights: np.ndarray
    word_weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.empty(len(column))
        for row, hashes, votes in row_features(column, self.lexicon, self.address):
            margin = self.intercept + votes @ self.vote_weights
            if len(hashes):
                places = (hashes >> np.uint64(64 - 14)).astype(np.int64)
                margin += self.word_weights[places].mean()
            out[row] = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        return out


def train_linear(votes: np.ndarray, words: list[np.ndarray], target: np.ndarray, rounds: int = 300):
    """Logistic regression on soft targets by accelerated gradient steps; the words enter by their mean."""
    v = votes.astype(float)
    a, b, c = np.zeros(v.shape[1]), np.zeros(HASHED), -2.0
    lengths = np.array([len(x) for x in words])
    rows = np.repeat(np.arange(len(words)), lengths)
    places = (np.concatenate(words) >> np.uint64(64 - 14)).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    share = 1 / np.maximum(lengths, 1)
    n = max(len(target), 1)
    rate, va, vb, vc = 2.0, 0.0, 0.0, 0.0
    for _ in range(rounds):
        margin = v @ a + np.bincount(rows, b[places], len(words)) * share + c
        gap = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target) / n
        va = 0.9 * va - rate * (v.T @ gap + 1e-5 * a)
        vb = 0.9 * vb - rate * (np.bincount(places, (gap * share)[rows], HASHED) + 1e-3 * b)
        vc = 0.9 * vc - rate * gap.sum()
        a, b, c = a + va, b + vb, c + vc
    return a, b, float(c)


def mined_words(texts: list[str], labels: np.ndarray) -> list[str]:
    """Words in several unrelated toxic texts and far rarer in the others.

    Texts that share the smallest hash of their runs of five words are taken as copies of one
    text and count once, so the other words of a copied text do not count as toxic.
    """
    from collections import defaultdict

    toxic: dict[bytes, set[int]] = defaultdict(set)
    clean: dict[bytes, int] = defaultdict(int)
    table = bytes(b if keep else 32 for b, keep in zip(FOLD, _ALNUM))
    for text, label in zip(texts, labels):
        words = set(text.lower().encode().translate(table).split())
        if label and words:
            kin = int(shingle_hashes(hashes_of_bytes(text.lower().encode().translate(table).split()), 5).min())
            for word in words:
                toxic[word].add(kin)
        else:
            for word in words:
                clean[word] += 1
    n, m = max(int(labels.sum()), 1), max(int((1 - labels).sum()), 1)
    least = max(5, MINED_SHARE * n)
    return sorted(w.decode() for w, kin in toxic.items()
                  if len(kin) >= least and len(kin) / n > MINED_RATIO * (clean.get(w, 0) + 0.5) / m)


def learning_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents for ``fit``, each with its size, which is measured before the join.

    So the count of all learning rows carries ids and sizes to the join and no text; texts of drawn rows alone go there.
    """
    text = F.col("text").cast("string")
    sized = docs.select("doc_id", text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("text_bytes"))
    return sized.join(labels.select("doc_id", "toxic"), "doc_id")


def fit(learning: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``learning`` (doc_id, text, toxic, and text_bytes if known), rows with a null label left out."""
    size = F.col("text_bytes") if "text_bytes" in learning.columns else F.octet_length(F.col("text").cast("string"))
    rows = learning.filter("toxic is not null").select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"),
        F.coalesce(size, F.lit(0)).alias("size"))
    total, size = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    rows = rows.filter(F.col("size") <= SAMPLE_BYTES // 8)
    share = min(0.9 * sample / max(total, 1), 0.9 * SAMPLE_BYTES / max(size, 1))
    keep = int(2**32 * min(1.0, share))
    drawn = (rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) < keep) if share < 0.9 else rows).limit(sample)
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["toxic"]) for r in drawn.collect())
    texts, labels = [t for _, t, _ in found], np.array([int(y > 0) for *_, y in found], int)
    words = sorted({*SEED_WORDS, *mined_words(texts, labels)})
    lexicon, address = hashes_of(words), hashes_of(ADDRESS_WORDS)
    listed = list(row_features(pa.array(texts, pa.string()), lexicon, address))
    votes = np.array([v for *_, v in listed], np.uint8).reshape(len(texts), len(words) + len(PATTERNS))
    if len(texts) < 50:  # too little to train on: the seed words alone
        return Model(lexicon, address, np.where(np.arange(votes.shape[1]) < len(words), 3.0, 0.0), np.zeros(HASHED), -2.0)
    target = fit_label_model(votes, labels).posterior(votes.astype(float))
    a, b, c = train_linear(votes, [h for _, h, _ in listed], target)
    return Model(lexicon, address, a, b, c)


def _score(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column("text"))
            kept = [c for c in batch.schema.names if c not in RESULTS]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*kept, *RESULTS])

    return run


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted. Only the text is looked at."""
    kept = [f for f in docs.schema.fields if f.name not in RESULTS]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(_score(model, threshold), schema)
