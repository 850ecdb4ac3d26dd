import math
import random

import numpy as np
import pytest
from kpimart.llm.hard_negatives import Index, head_norms, op12_hard_negatives, window_ends

from conftest import SF0001  # noqa: I001

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows):
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        got = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v])
        held[i] = min(held.get(i, got), got)
    out = []
    for i, (label, v) in held.items():
        if i % 50:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, (_, w) in held.items() if j != i)
        for p, j in [s for s in scores if held[s[1]][0] == label][:5]:
            fit = [(n, k) for n, k in scores if held[k][0] != label and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(i, j, r, k, -p, -n) for r, (n, k) in enumerate(fit, 1)]
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = collected(op12_hard_negatives(spark, SF0001))
    assert got == brute(rows) and got


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_ties_and_lowered_thresholds(spark, folder_of, monkeypatch, seed):
    import kpimart.llm.hard_negatives as module

    monkeypatch.setattr(module, "FIRST_HITS", 4)
    monkeypatch.setattr(module, "ROW_BLOCK", 90)
    monkeypatch.setattr(module, "ANCHOR_BLOCK", 5)
    draw = random.Random(seed)
    near = [[draw.gauss(0, 0.1) for _ in range(20)] for _ in range(6)]
    rows = [(i, draw.choice(near) if i % 3 == 0 else [x + draw.gauss(0, 0.05) for x in draw.choice(near)], draw.choice([0, 0, 0, 1, 2]))
            for i in range(600)]
    got = collected(op12_hard_negatives(spark, folder_of("embeddings", rows, TABLE)))
    assert got == brute(rows) and len(got) > 100


def test_edges(spark, folder_of):
    rows = [(0, [1.0, 0.0], 6), (50, [1.0, 0.5], 1), (100, [0.0, 0.0], 1), (150, [-1.0, -1.0], 1), (200, [], 2), (250, [1.0], 2),
            (1, None, 1), (2, [1.0, None], 1), (3, [1.0, float("nan")], 1), (4, [1.0, float("inf")], 1), (5, [1.0, 0.0], None),
            (None, [1.0, 0.0], 1), (6, [0.8, 0.1], 1), (6, [0.8, 0.1], 1), (8, [0.9, 0.0], 1), (8, [0.7, 0.0], 1), (9, [0.6, 0.0], 3),
            (10, [0.6, 0.0], 3), (11, [0.75, 0.0], 2), (12, [0.1, 0.9], 0), (300, [-0.004, 0.0], 5), (13, [1.0, 0.0], 7), (350, [0.5], 6)]
    got = collected(op12_hard_negatives(spark, folder_of("embeddings", rows, TABLE)))
    padded = [(i, v if v is None else v + [0.0] * (2 - len(v)), label) for i, v, label in rows]
    assert got == brute(padded) and got
    assert op12_hard_negatives(spark, folder_of("embeddings", [], TABLE)).count() == 0
    assert op12_hard_negatives(spark, folder_of("embeddings", [(1, [1.0], 1)], TABLE)).count() == 0
    wide = [(i, [1.0, i / 9], i % 2, i, "x") for i in range(60)]
    more = op12_hard_negatives(spark, folder_of("embeddings", wide, TABLE + ", rank int, ids string"))
    assert collected(more) == brute([r[:3] for r in wide])
    with pytest.raises(Exception, match="64 bits"):
        op12_hard_negatives(spark, folder_of("embeddings", [(1, [1e9], 1)], TABLE)).count()


@pytest.mark.parametrize("scale", [100, 10**8])
def test_index_gives_every_pair_over_the_threshold_and_leaves_out_postings(scale):
    draw = np.random.default_rng(scale)
    x = (draw.normal(size=(300, 37)) * np.linspace(0.05, 2, 37) * scale).astype(np.int64)
    q = (draw.normal(size=(23, 37)) * np.linspace(0.05, 2, 37) * scale).astype(np.int64)
    scores = q @ x.T
    for share in (0.999, 0.9, 0.5, 0.0):
        low = np.quantile(scores, share, axis=1).astype(np.int64)
        high = np.maximum(low, (scores.max(axis=1) * 0.9).astype(np.int64))
        index = Index(x, int(low.min()), head_norms(q).max(axis=0))
        got = {(int(i), int(j)): int(s) for i, j, s in zip(*index.probe(q, low, high))}
        want = {(i, j): int(scores[i, j]) for i, j in zip(*np.nonzero((scores >= low[:, None]) & (scores <= high[:, None])))}
        assert got == want
        if share == 0.999:
            assert index.begin.max() > 0 or len(index.rows) < len(x)


def test_window_ends_are_exact():
    p = np.array([0, 1, 2, 3, 19, 20, 99, 100, 101, 12345, 2**60 + 7], np.int64)
    low, high = window_ends(p)
    for v, a, b in zip(p.tolist(), low.tolist(), high.tolist()):
        assert 50 * v <= 100 * a < 50 * v + 100 and 95 * v - 100 < 100 * b <= 95 * v
