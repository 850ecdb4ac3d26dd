import hashlib
import re
import struct

import xxhash
from kpimart.llm.fingerprints import op1_fingerprints

from conftest import SF0001  # noqa: I001


def spark_hash(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute(text):
    w = [spark_hash(x) for x in re.split("[ \t\n\x0b\f\r]+", text) if x]
    if len(w) < 10:
        a = 0
        for x in w:
            a = spark_hash(a, x)
        return [a & 0xFFFFFFFF] if w else []
    s = [spark_hash(*w[i:i + 3]) for i in range(len(w) - 2)]
    return [spark_hash(s[i], s[i + 3], s[i + 6], s[i + 7]) & 0xFFFFFFFF for i in range(len(w) - 9)
            if min(s[i:i + 8]) in (s[i], s[i + 7])]


def alike(a, b):
    return 1.0 if not set(a) | set(b) else len(set(a) & set(b)) / len(set(a) | set(b))


def expected(docs):
    docs = sorted(docs, reverse=True)
    for k, (doc, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, new = brute(text), brute(edited)
        yield (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join("%08x" % a for a in own),
               "".join("%08x" % a for a in new), alike(own, new), alike(own, brute(after)))


def test_query_equals_brute_force(spark, texts):
    got = sorted(tuple(r) for r in op1_fingerprints(spark, SF0001).collect())
    assert got == sorted(expected(texts.items()))


def test_edges(spark, folder_of):
    schema = "doc_id long, text string, range int, next string"
    rows = [(1, "a b", 1, "x"), (1, "a b", 1, "x"), (None, "c", 1, "x"), (2, None, 1, "x"), (5, "w " * 30_000, 1, "x"), (4, "", 1, "x")]
    got = op1_fingerprints(spark, folder_of("documents", rows, schema)).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[2].n_chars == 0 and by[2].fingerprint == "" and by[4].near_next == 1.0
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1 and by[None].n_chars == 1
    assert op1_fingerprints(spark, folder_of("documents", [], schema)).count() == 0
    one = op1_fingerprints(spark, folder_of("documents", [(7, "a b c d", 0, "")], schema)).collect()[0]
    assert one.near_next == 1.0


def test_short_texts_have_anchors_and_are_not_alike(spark, folder_of):
    # texts of 1 to 20 words, no two with a word in common: unrelated, each followed by another or by an empty one
    rows = [(100 * v + n, " ".join(f"w{v}x{n}y{i}" for i in range(n)), 1, "x") for v in range(1, 9) for n in range(21)]
    got = {r.doc_id: r for r in op1_fingerprints(spark, folder_of("documents", rows, "doc_id long, text string, range int, next string"))
           .collect()}
    assert len(got) == len(rows)
    for doc, text, _, _ in rows:
        w = [spark_hash(x) for x in text.split()]
        s = [spark_hash(*w[i:i + 3]) for i in range(len(w) - 2)]
        every = [spark_hash(s[i], s[i + 3], s[i + 6], s[i + 7]) & 0xFFFFFFFF for i in range(len(w) - 9)]
        own = brute(text) or ([min(every)] if every else [])
        assert got[doc].fingerprint == "".join("%08x" % a for a in own)
        assert bool(own) == bool(w) and got[doc].near_next == 0.0
    assert len({r.fingerprint for r in got.values()}) == 8 * 20 + 1
    assert sum(not brute(t) for _, t, _, _ in rows) > 8  # some have no chosen k-mer
