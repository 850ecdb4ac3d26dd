"""Toxicity by a counterfactual-regularised classifier.

Logistic regression on which words, and which beginnings of words, occur in a
text. Each training text that names a group also appears with the terms
swapped for those of the next group, and a text that names none appears with
a neutral mention of a group put in; the loss adds the squared change of the
score between the pair. Mentioning a group thus moves a score little, whatever
the labels say.

Features are hashed; those of too few texts, or alike in both classes, get no
weight. Fitted on at most ``bound`` labelled documents; scoring reads every word.

Edge cases: null and empty texts have no features and get the intercept's
score; without labels of both kinds every score is the share of toxic ones
(0 without any); rows with equal ids are scored each; further columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.llm.common import held_out, table
from kpimart.llm.labels import training_sample
from kpimart.llm.tokens import Words

THRESHOLD = 0.3
BUCKETS = 1 << 20
WORD = re.compile(r"[^\W_]+")
STEMS = (4, 5, 6, 7)

# Neutral names of groups, a tuple for each kind of group.
GROUPS = (
    ("women", "men"),
    ("girls", "boys"),
    ("gay", "straight"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("africans", "asians", "europeans", "americans", "arabs"),
    ("black", "white"),
    ("immigrants", "locals"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
SWAP = {t: g[(i + 1) % len(g)] for g in GROUPS for i, t in enumerate(g)}
TERMS = sorted(SWAP)


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself and its beginnings."""
    names = ["=" + word, *("^" + word[:n] for n in STEMS if len(word) >= n)]
    return tuple(xxhash.xxh64_intdigest(n) % BUCKETS for n in names)


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def counterfactual(words: set[str], draw: int) -> set[str]:
    """The words with every group term swapped, or with a neutral mention put in."""
    if not words.isdisjoint(SWAP):
        return {SWAP.get(w, w) for w in words}
    return words | {TERMS[draw % len(TERMS)]}


def features(words: set[str]) -> np.ndarray:
    return np.unique(np.fromiter((f for w in words for f in word_features(w)), np.int64))


@dataclass
class Model:
    ids: np.ndarray  # buckets with a weight, ascending
    weights: np.ndarray
    intercept: float
    constant: float | None = None

    def scorer(self):
        """A function from text to score that remembers the words it met last."""
        weight = dict(zip(self.ids.tolist(), self.weights.tolist(), strict=True))
        # White space parts words, so a text's words are those of its parts; most parts have no feature with a weight.
        known = Words(lambda part: tuple(f for w in WORD.findall(part) for f in word_features(w) if f in weight))

        def score(text: str | None) -> float:
            if self.constant is not None:
                return self.constant
            hits = {f for part in set((text or "").lower().split()) for f in known[part]}
            z = self.intercept + sum(weight[f] for f in sorted(hits))
            return 1 / (1 + float(np.exp(-max(-30.0, min(30.0, z)))))
        return score


def sparse(rows: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the features that have a column."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    if not len(ids) or not len(row):
        return np.empty(0, int), np.empty(0, int)
    flat = np.concatenate(rows)
    col = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
    hit = ids[col] == flat
    return row[hit], col[hit]


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], fair: float = 1.0, ridge: float = 2.0, least: int = 4,
        steps: int = 300, rate: float = 0.05) -> Model:
    """``samples``: features of a text, features of its counterfactual, label (1 toxic)."""
    y = np.array([s[2] for s in samples], float)
    if not len(y) or y.min() == y.max():
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, float(y.mean()) if len(y) else 0.0)
    flat = np.concatenate([s[0] for s in samples])
    toxic = np.concatenate([s[0] for s in samples if s[2]])
    ids, n = np.unique(flat, return_counts=True)
    n1 = np.bincount(np.searchsorted(ids, toxic), minlength=len(ids))
    rate1, rate0 = (n1 + 0.5) / (y.sum() + 1), (n - n1 + 0.5) / (len(y) - y.sum() + 1)
    spread = np.sqrt(rate1 * (1 - rate1) / y.sum() + rate0 * (1 - rate0) / (len(y) - y.sum()))
    swapped = np.unique(np.concatenate([features({t}) for t in TERMS]))
    keep = ((n >= least) & (np.abs(rate1 - rate0) > 2.5 * spread)) | np.isin(ids, swapped)
    ids = ids[keep]
    row, col = sparse([s[0] for s in samples], ids)
    # A pair's difference has only the swapped terms' features.
    drop = sparse([np.setdiff1d(a, b) for a, b, _ in samples], ids)
    add = sparse([np.setdiff1d(b, a) for a, b, _ in samples], ids)
    w, c = np.zeros(len(ids)), float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)
    for step in range(1, steps + 1):
        z = c + np.bincount(row, w[col], len(y))
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        moved = np.bincount(add[0], w[add[1]], len(y)) - np.bincount(drop[0], w[drop[1]], len(y))
        grad = np.bincount(col, miss[row], len(ids)) + ridge * w
        grad += 2 * fair * (np.bincount(add[1], moved[add[0]], len(ids)) - np.bincount(drop[1], moved[drop[0]], len(ids)))
        grad = np.append(grad, miss.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
        w, c = w - move[:-1], c - move[-1]
    return Model(ids, w, c)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = 8000, **options) -> Model:
    """Fit on a bounded sample; the driver gets hashed features, not texts."""
    def hashed(batches):
        for batch in batches:
            rows = []
            for doc_id, text, y in zip(batch["doc_id"], batch["text"], batch["label"], strict=True):
                words = text_words(text)
                other = counterfactual(words, xxhash.xxh64_intdigest(str(doc_id)))
                rows.append((features(words).astype("<i4").tobytes(), features(other).astype("<i4").tobytes(), y))
            yield pd.DataFrame(rows, columns=["own", "other", "y"])

    got = training_sample(docs, labels, label, bound).mapInPandas(hashed, "own binary, other binary, y int").collect()
    rows = sorted((bytes(r.own), bytes(r.other), r.y) for r in got)  # the fit does not depend on the rows' order
    return fit([(np.frombuffer(a, "<i4").astype(np.int64), np.frombuffer(b, "<i4").astype(np.int64), y)
                for a, b, y in rows], **options)


@lru_cache(maxsize=2)
def _scorer(ids: bytes, weights: bytes, intercept: float, constant: float | None):
    return Model(np.frombuffer(ids, np.int64), np.frombuffer(weights, np.float64), intercept, constant).scorer()


def toxicity_score(model: Model, text: Column) -> Column:
    """0 to 1, higher for texts likelier labelled toxic."""
    parts = (model.ids.tobytes(), model.weights.tobytes(), model.intercept, model.constant)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        one = _scorer(*parts)
        return pd.Series([one(t) for t in texts], dtype="float64")
    return score(text)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out().alias("held_out"), toxicity_score(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
