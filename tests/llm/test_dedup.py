import random
import re
from collections import Counter

import pytest
from kpimart.llm.dedup import near_duplicates, op2_minhash
from pyspark.sql import functions as F

from conftest import SF0001  # noqa: I001

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, k, share=80):
    sets, seen, up = [], {}, list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, text) in enumerate(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
        common = Counter(j for s in sets[i] for j in seen.get(s, ()))
        for s in sets[i]:
            seen.setdefault(s, []).append(i)
        for j, n in common.items():
            if 100 * n >= share * (len(sets[i]) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(docs))


def test_query_equals_brute_force(spark, texts):
    assert sorted(tuple(r) for r in op2_minhash(spark, SF0001).collect()) == brute(list(texts.items()), 4)


@pytest.mark.parametrize("words", [4, 5])
def test_chains_of_edits(spark, words):
    rng = random.Random(words)
    docs = []
    for base in range(12):
        w = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 120]))]
        for step in range(12):  # each a further edit of the one before
            docs.append((len(docs), " ".join(w)))
            for _ in range(rng.choice([0, 1, 2])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10_000)}"
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=words)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()) == brute(docs, words)
    assert got.filter("leads").count() == got.select("component_id").distinct().count()


def test_edges(spark):
    rows = [(None, None), (1, ""), (2, " \n"), (3, "a b"), (4, "A b"), (4, "A b"), (None, "a b"), (5, "a"), (5, "c"), (7, "É b"), (8, "é b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(1)).withColumn("node", F.lit(1))
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == Counter([(None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False), (4, 1, 3, False),
                           (None, 1, 3, False), (5, 1, 5, True), (5, 1, 5, True), (7, 1, 7, True), (8, 1, 8, True)])
    assert near_duplicates(df.limit(0)).count() == 0
