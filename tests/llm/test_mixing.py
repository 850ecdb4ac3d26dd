import numpy as np
import pytest
from kpimart.llm.mixing import copies_of, flight, mix_sources, op8_mix

from conftest import DOCS, SF0001  # noqa: I001


def water(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if cap * sizes[s] <= level * weight[s]]
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = op8_mix(spark, SF0001).collect()
    sizes = {}
    for r in got:
        assert r["size"] == len(docs[r.doc_id].text.encode().split())
        assert r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        sizes[docs[r.doc_id].source] = sizes.get(docs[r.doc_id].source, 0) + r["size"]
    want = water(sizes)
    assert len(got) == len(docs)
    for source, target in want.items():
        own = [r for r in got if docs[r.doc_id].source == source]
        assert all(r.source_size == sizes[source] and r.target == pytest.approx(target) for r in own)
        # ten documents a source: as near as its smaller ones allow
        assert abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own) / 2
    again = op8_mix(spark, SF0001).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rounds_and_hot_source(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(n), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i, n in enumerate(rng.integers(1, 60, 900))]
    docs = spark.createDataFrame(rows, DOCS)
    got = mix_sources(docs, block=16).toPandas()
    off = got.assign(taken=got["size"] * got["copies"]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((off.taken - off.target).abs() <= 30).all()
    assert copies_of(docs, mix_sources(docs, block=16)).count() == got["copies"].sum()


def test_flight_keeps_the_sums():
    rng = np.random.default_rng(0)
    size, prob = rng.integers(1, 100, 200).astype(float), np.full(200, 0.37)
    out = flight(size, prob, rng, False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert size @ out == pytest.approx(size @ prob) and out.sum() == pytest.approx(prob.sum())
    landed = flight(size, prob, rng, True)
    assert set(landed) <= {0.0, 1.0} and abs(size @ (landed - prob)) <= 1


def test_edges(spark):
    rows = [(1, None, None, None, None), (2, "a b", None, None, None), (2, "a b", None, None, None), (3, "", None, "x", None),
            (None, "c", None, "x", None), (4, "d " * 20_000, None, "é", None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as size", "2 as mark", "3 as n")
    mix = mix_sources(docs)
    got = mix.collect()
    assert len(got) == 6 and all(r.copies <= 2 for r in got)
    out = copies_of(docs, mix)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    # documents without words stay as often as the mix takes them
    taken = {r.doc_id: r.copies for r in got if not r["size"]}
    assert taken.keys() == {1, 3} and {r.doc_id: r["count"] for r in out.filter("doc_id in (1, 3)").groupBy("doc_id").count().collect()} == {
        k: v for k, v in taken.items() if v}
    assert mix_sources(docs.limit(0)).count() == 0 and copies_of(docs.limit(0), mix_sources(docs.limit(0))).count() == 0
