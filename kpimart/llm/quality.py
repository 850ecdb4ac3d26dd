"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe the line and the lines next to
it; a line's state depends on its features and on the states beside it. Labels
exist for documents only, so lines of good documents are good, and those of bad
ones start as bad and are then relabelled by the model, which keeps at least
the worst line bad. A document's score comes from the length-weighted mean of
its lines' forward-backward marginals, calibrated to the labels by logistic
regression.

Fitted on at most ``bound`` labelled documents of at most ``MOST_LINES`` lines
each; scoring reads every line of every text.

Edge cases: null and empty texts are one empty line; without labels of both
kinds every score is the share of good ones (0.5 without any); rows with equal
ids are scored each; further columns are kept under their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import exp, log, log1p

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.llm.common import held_out, table
from kpimart.llm.labels import training_sample

MOST_LINES = 200  # of a document that the fit learns from
THRESHOLD = 0.7

# Classes of characters, as columns of counts.
LETTER, UPPER, DIGIT, BLANK, COMMON, OTHER = range(6)


def _classes() -> np.ndarray:
    """Class of each code point below 0x3000."""
    out = np.full(0x3000, OTHER, np.int8)
    for c in range(len(out)):
        ch = chr(c)
        if ch.isalpha():
            out[c] = UPPER if ch.isupper() else LETTER
        elif ch.isdigit():
            out[c] = DIGIT
        elif ch.isspace():
            out[c] = BLANK
        elif ch in ".,;:'\"?-()":
            out[c] = COMMON
    return out


CLASSES = _classes()
OWN = 14  # features of a line itself
FEATURES = 2 * OWN + 1


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x FEATURES) and lengths of a text's lines."""
    text = text or ""
    lines = text.split("\n")
    k = len(lines)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = CLASSES[np.minimum(codes, len(CLASSES) - 1)]
    breaks = codes == 10
    line = np.cumsum(breaks) - breaks  # a line end belongs to the line before it
    count = np.bincount(line * 6 + kind, minlength=6 * k).reshape(k, 6).astype(float)
    length = np.array([len(s) for s in lines], float)
    count[:, BLANK] -= np.append(np.ones(k - 1), 0)
    word = kind != BLANK
    starts = np.flatnonzero(word & ~np.append(False, word[:-1])) if len(word) else np.empty(0, int)
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) if len(word) else np.empty(0, int)
    of = line[ends]
    words = np.bincount(of, minlength=k).astype(float)
    odd = np.bincount(of[kind[ends] == OTHER], minlength=k)
    short = np.bincount(of[ends - starts < 3], minlength=k)
    n, w = np.maximum(length, 1), np.maximum(words, 1)
    letters = np.maximum(count[:, LETTER] + count[:, UPPER], 1)
    seen = Counter(lines)
    own = np.stack([
        np.log1p(length) / 8, np.log1p(words) / 6, count[:, UPPER] / letters, count[:, DIGIT] / n, count[:, BLANK] / n,
        count[:, COMMON] / n, count[:, OTHER] / n, odd / w, short / w,
        np.array([len(set(s.split())) for s in lines]) / w, np.minimum(1.0, n / w / 20),
        np.array([float(seen[s] > 1 and s != "") for s in lines]),
        np.array([float(s.rstrip().endswith((".", "?", "!"))) for s in lines]), (length == 0).astype(float)], 1)
    beside = np.zeros_like(own)
    beside[1:] += own[:-1] / 2
    beside[:-1] += own[1:] / 2
    return np.hstack([own, beside, np.ones((k, 1))]), n


@dataclass
class Model:
    """State 1 is bad. ``calibration`` maps the logit of the bad share to the logit of good."""

    weights: np.ndarray
    transitions: np.ndarray
    calibration: tuple[float, float]
    constant: float | None = None

    def bad_lines(self, x: np.ndarray) -> np.ndarray:
        """Forward-backward marginals of state bad."""
        e = np.exp(np.clip(x @ self.weights, -30, 30)).tolist()
        (a, b), (c, d) = np.exp(self.transitions).tolist()
        forward, good, bad = [], 1.0, e[0]
        for k, v in enumerate(e):
            if k:
                good, bad = good * a + bad * c, (good * b + bad * d) * v
            good, bad = good / (good + bad), bad / (good + bad)
            forward.append((good, bad))
        out, good, bad = [], 1.0, 1.0
        for k in range(len(e) - 1, -1, -1):
            f, g = forward[k]
            out.append(g * bad / (f * good + g * bad))
            good, bad = a * good + b * e[k] * bad, c * good + d * e[k] * bad
            good, bad = good / (good + bad), bad / (good + bad)
        return np.array(out[::-1])

    def bad_share(self, x: np.ndarray, length: np.ndarray) -> float:
        return float(self.bad_lines(x) @ length / length.sum())

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        a, b = self.calibration
        return sigmoid(a + b * logit(self.bad_share(*line_features(text))))


def sigmoid(z: float) -> float:
    return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return log(p / (1 - p))


def marginals(node: np.ndarray, n: np.ndarray, trans: np.ndarray):
    """Marginals of state 1 and expected transitions for chains padded to one length.

    ``node`` (chains x lines) is the score of state 1 against 0; ``n`` the
    chains' lengths.
    """
    chains, most = node.shape
    t = np.exp(trans)
    e1 = np.exp(np.clip(node, -30, 30))
    inside = np.arange(most)[None] < n[:, None]
    fwd, bwd = np.empty((most, chains, 2)), np.ones((most, chains, 2))
    f = np.stack([np.ones(chains), e1[:, 0]], 1)
    fwd[0] = f / f.sum(1, keepdims=True)
    for k in range(1, most):
        f = fwd[k - 1] @ t
        f[:, 1] *= e1[:, k]
        fwd[k] = f / f.sum(1, keepdims=True)
    for k in range(most - 2, -1, -1):
        b = bwd[k + 1].copy()
        b[:, 1] *= e1[:, k + 1]
        b = b @ t.T
        bwd[k] = np.where(inside[:, k + 1, None], b / b.sum(1, keepdims=True), 1.0)
    both = fwd * bwd
    p = (both[:, :, 1] / both.sum(2)).T * inside
    pairs = np.zeros((2, 2))
    if most > 1:
        right = bwd[1:].copy()
        right[:, :, 1] *= e1.T[1:]
        joint = fwd[:-1, :, :, None] * t[None, None] * right[:, :, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        pairs = (joint * inside.T[1:, :, None, None]).sum((0, 1))
    return p, pairs


def fit_chain(groups, params: np.ndarray, steps: int, rate: float = 0.1, decay: float = 1e-3) -> np.ndarray:
    """Maximum likelihood by Adam. ``groups``: padded features, chain lengths and states (1 bad).

    ``params`` holds the weights and then the four transition scores.
    """
    total = sum(n.sum() for _, n, _ in groups)
    seen = np.zeros((2, 2))
    for _, n, y in groups:
        both = np.arange(1, y.shape[1])[None] < n[:, None]
        for i in (0, 1):
            for j in (0, 1):
                seen[i, j] += ((y[:, :-1] == i) & (y[:, 1:] == j) & both).sum()
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, trans = params[:-4], params[-4:].reshape(2, 2)
        at, expected = np.zeros_like(w), np.zeros((2, 2))
        for xs, n, y in groups:
            p, pairs = marginals(xs @ w, n, trans)
            at += np.tensordot((y - p) * (np.arange(y.shape[1])[None] < n[:, None]), xs, 2)
            expected += pairs
        grad = np.concatenate([at, (seen - expected).ravel()]) / total - decay * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        params = params + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return params


def fit_logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a weak ridge."""
    x, w = np.stack([np.ones_like(z), z], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 3) -> Model:
    """``samples``: line features, line lengths and label (1 good) of documents."""
    good = [s[2] for s in samples]
    if not samples or min(good) == max(good):
        return Model(np.zeros(FEATURES), np.zeros((2, 2)), (0.0, 0.0), sum(good) / len(good) if good else 0.5)
    samples = sorted(samples, key=lambda one: len(one[0]))  # chains of like length are padded together
    groups, at = [], 0
    while at < len(samples):
        most = max(4, int(1.3 * len(samples[at][0])))
        some = [one for one in samples[at:] if len(one[0]) <= most]
        n = np.array([len(x) for x, _, _ in some])
        xs = np.zeros((len(some), n.max(), FEATURES))
        for i, (x, _, _) in enumerate(some):
            xs[i, :len(x)] = x
        bad = np.array([1.0 - one[2] for one in some])
        groups.append((xs, n, np.repeat(bad[:, None], n.max(), 1)))
        at += len(some)
    bads = [y[:, :1] for _, _, y in groups]
    params = np.zeros(FEATURES + 4)
    for k in range(rounds):
        params = fit_chain(groups, params, 60 if k else 120)
        ps = [marginals(xs @ params[:-4], n, params[-4:].reshape(2, 2))[0] for xs, n, _ in groups]
        groups = [(xs, n, ((p > 0.5) | (p >= p.max(1, keepdims=True))) * bad)
                  for (xs, n, _), p, bad in zip(groups, ps, bads, strict=True)]
    model = Model(params[:-4], params[-4:].reshape(2, 2), (0.0, 0.0))
    share = [logit(model.bad_share(x, length)) for x, length, _ in samples]
    model.calibration = fit_logistic(np.array(share), np.array([float(y) for _, _, y in samples]))
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 4000) -> Model:
    """Fit on a bounded sample; the driver gets the sample's line features, not its texts.

    Of a document with more than ``MOST_LINES`` lines so many neighbouring
    lines are learnt from.
    """
    def features(batches):
        for batch in batches:
            rows = []
            for text, y in zip(batch["text"], batch["label"], strict=True):
                x, length = line_features(text)
                # of a longer one, that many neighbouring lines from a place by its hash
                first = xxhash.xxh64_intdigest(text) % (len(x) - MOST_LINES + 1) if len(x) > MOST_LINES else 0
                some = slice(first, first + MOST_LINES)
                rows.append((x[some].astype("<f4").tobytes(), length[some].astype("<f4").tobytes(), y))
            yield pd.DataFrame(rows, columns=["x", "length", "y"])

    got = training_sample(docs, labels, label, bound).select("doc_id", "text", "label").mapInPandas(
        features, "x binary, length binary, y int").collect()
    rows = sorted((bytes(r.x), bytes(r.length), r.y) for r in got)  # the fit does not depend on the rows' order
    return fit([(np.frombuffer(x, "<f4").reshape(-1, FEATURES).astype(float), np.frombuffer(n, "<f4").astype(float), y)
                for x, n, y in rows])


def quality_score(model: Model, text: Column) -> Column:
    """0 to 1, higher for texts likelier labelled good."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")
    return score(text)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out().alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
