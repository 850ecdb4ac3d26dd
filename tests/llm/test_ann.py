import numpy as np
from kpimart.llm.ann import cosines, hilbert, op3_neighbours

from conftest import SF0001  # noqa: I001


def brute(rows, k=5):
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], float)
    for i in np.flatnonzero(ids % 50 == 0):
        s = cosines(np.repeat(v[i:i + 1], len(v), 0), v)
        for rank, (score, at) in enumerate(sorted((-s[j], ids[j]) for j in range(len(ids)) if j != i)[:k], 1):
            yield int(ids[i]), rank, int(at), -score


def test_hilbert_steps_by_one():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    walked = cells[np.argsort(place)]
    assert (np.abs(np.diff(walked, axis=0)).sum(1) == 1).all()


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    want = list(brute(rows))
    got = [tuple(r) for r in op3_neighbours(spark, SF0001).collect()]
    true = {(q, i): s for q, _, i, s in want}
    hits = [(q, i, s) for q, _, i, s in got if (q, i) in true]
    assert len(got) == len(want) and len(hits) >= 0.9 * len(want)
    assert all(true[q, i] == s for q, i, s in hits)


def test_edges(spark, folder_of):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [1.0, float("inf")]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (150, [])]
    rows += [(k, [2.0, 0.0]) for k in range(8, 14)] + [(k, [1.0, 0.0]) for k in range(14, 24)]
    got = op3_neighbours(spark, folder_of("embeddings", rows, "vec_id long, embedding array<float>")).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 50, 100, 150)}
    assert by == {0: [1, 8, 9, 10, 11], 50: [0, 1, 8, 9, 10], 100: [], 150: []}
    few = op3_neighbours(spark, folder_of("embeddings", [(0, [1.0]), (1, [-1.0])], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in few] == [(0, 1, 1, -1.0)]
    assert op3_neighbours(spark, folder_of("embeddings", [], "vec_id long, embedding array<float>")).count() == 0


def test_an_id_under_several_near_vectors_takes_one_place(spark, folder_of):
    rows = [(0, [1.0, 0.0])] + [(1, [1.0, 0.001 * i]) for i in range(1, 9)] + [(k, [1.0, 0.1 * k]) for k in range(2, 11)]
    rows += [(50, [0.0, 1.0]), (50, [1.0, 1.05])]
    got = op3_neighbours(spark, folder_of("embeddings", rows, "vec_id long, embedding array<double>")).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 50)}
    assert by == {0: [1, 2, 3, 4, 5], 50: [10, 9, 8, 7, 6]}
    assert len(got) == 10
