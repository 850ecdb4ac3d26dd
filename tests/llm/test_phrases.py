import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from kpimart.llm.phrases import NEVER, PACK, _grouped, _Scan, _scan, code_blocks, collocations, op13_phrases, phrase_counts
from pyspark.sql import functions as F

from conftest import DOCS  # noqa: I001

SF001 = "/root/testdata/sf0.01"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_counts(docs):
    """docs: (lang, text). Counts by (lang, words) and words by language, all phrases counted."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f, n


def brute(docs, least=30, top=2000):
    f, n = brute_counts(docs)
    f = {p: c for p, c in f.items() if c >= least}
    rows = {}
    for (lang, w), a in f.items():
        if len(w) > 1:
            cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            rows[lang, w] = min(cuts)
    for (lang, w), a in f.items():
        for s in range(2, len(w)):
            for i in range(len(w) - s + 1):
                if 100 * a >= 80 * f[lang, w[i:i + s]]:
                    rows.pop((lang, w[i:i + s]), None)
    out = []
    for lang in {lang for lang, _ in rows}:
        mine = sorted((-s[0], -f[lang, w], " ".join(w).encode(), s) for (at, w), s in rows.items() if at == lang)[:top]
        out += [(lang, i, p.decode(), -a, s[2], s[3], n[lang], s[0]) for i, (_, a, p, s) in enumerate(mine, 1)]
    return sorted(out)


def collected(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query_equals_plain_counting(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = collected(op13_phrases(spark, SF001))
    assert got == brute(docs) and len(got) > 250


@pytest.mark.parametrize("shards,slots", [(1, 1 << 12), (3, 1 << 6), (4, 1 << 23)])
def test_counts_do_not_depend_on_shards_or_slots(spark, shards, slots):
    draw = random.Random(shards)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "Zz", "zZ"]
    texts = ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ":"]) for _ in range(draw.randint(0, 300)))
             for _ in range(120)]
    texts += ["the same text again and again " * 9] * 40
    docs = [("en" if i % 3 else "de", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    counts, totals = phrase_counts(df, least=4, shards=shards, slots=slots)
    f, n = brute_counts(docs)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in counts.collect()} == {p: c for p, c in f.items() if c >= 4}
    assert {r.lang: r.n for r in totals.collect()} == dict(n)
    assert collected(collocations(counts, totals, top=50)) == brute(docs, 4, 50)


def test_edges(spark, folder_of):
    rows = [(1, None, "en", "a", 0), (2, "", None, "a", 0), (None, "A b. a B\x0bA\tb" * 40, None, None, None), (4, "A b c d e! " * 30, "und", "a", 1),
            (4, "A b c d e! " * 30, "und", "a", 1), (5, "x" * 200_000 + " y" * 100_000, "fr", "a", 1), (6, ".,;:!? \t\r\n", "de", "a", 1)]
    got = collected(op13_phrases(spark, folder_of("documents", rows, DOCS)))
    assert got == brute([(r[2], r[1]) for r in rows])
    assert {r[0] for r in got} == {"und", "fr"}
    assert op13_phrases(spark, folder_of("documents", [], DOCS)).count() == 0
    clash = [(1, "p q " * 40, "en", 3, "x")]
    assert op13_phrases(spark, folder_of("documents", clash, "doc_id long, text string, lang string, rank int, phrase string")).count() > 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 6 * 10**12  # times 2000000 is over 2^63
    counts = spark.createDataFrame([("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "a b", 2, big)],
                                   "lang string, phrase string, length int, n long")
    row = collocations(counts, spark.createDataFrame([("en", 3 * big)], "lang string, n long")).collect()[0]
    assert row.score == 2000000 * big // (2 * big + 3) == 999999


def test_blocks_hold_every_word_once(spark):
    docs = spark.createDataFrame([("en", f"w{i} . " * 50) for i in range(300)], "lang string, text string")
    got = code_blocks(docs.select("lang", F.col("text").cast("binary").alias("text")), 3).collect()
    assert sum(r.n_words for r in got) == 15000 and {r.shard for r in got} == {0, 1, 2}


def unpacked(packs):
    """Counts by phrase of packs (bytes); a phrase comes once in those of one scan."""
    rows = [r for p in packs for r in pa.ipc.read_record_batch(pa.py_buffer(p), PACK).to_pylist()]
    assert len({r["key"] for r in rows}) == len(rows)
    return {r["key"].decode(): r["n"] for r in rows}


def test_a_scan_sends_a_pack_for_each_bucket_not_a_row_for_each_phrase(spark):
    docs = spark.createDataFrame([("en", " ".join(f"w{i}" for i in range(j, j + 200))) for j in range(0, 6000, 200)],
                                 "lang string, text string").coalesce(1)
    blocks = code_blocks(docs.select("lang", F.col("text").cast("binary").alias("text")), 1)
    told = spark.sparkContext.broadcast(np.zeros(1 << 12, np.uint8).tobytes())  # every phrase is counted
    got = _scan(blocks, 1, 4, 4, 64, told).collect()
    assert len(got) <= 4 * 64 and {r.bucket for r in got} == set(range(64))
    counts = unpacked(r.packed for r in got)
    assert len(counts) == 6000 + 30 * (199 + 198 + 197) and set(counts.values()) == {1}


def test_phrases_of_one_hash_are_counted_apart():
    words, codes = [b"\xff", b"a", b"b", b"c"], np.array([1, 2, 3, 1, 2, 1, 2, 3, 1, 2, 0] * 3)
    scan = _Scan(1, 4, 4, 64, np.zeros(1 << 12, np.uint8))
    scan.factors = [np.zeros_like(f) for f in scan.factors]
    got = unpacked(p.as_py() for batch in scan.counts("en", words, codes) for p in batch.column(1))
    f, _ = brute_counts([("en", "a b c a b a b c a b. " * 3)])
    assert got == {" ".join(w) + "\ten": n for (_, w), n in f.items()}
    order, first = _grouped(np.array([7, 7, 5, 7, 7], np.uint64), [np.array([1, 2, 3, 1, 2])])
    assert np.array([1, 2, 3, 1, 2])[order].tolist() == [3, 1, 1, 2, 2] and first.tolist() == [0, 1, 3]


def test_nothing_is_sent_after_its_cycle():
    scan = _Scan(9, 4, 4, 64, np.full(1 << 12, NEVER, np.uint8))
    assert not list(scan.counts("en", [b"\xff", b"a"], np.array([1, 1, 0])))
