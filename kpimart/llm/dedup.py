"""Near-duplicate documents by min-max hashing, with exact confirmation.

A document is the set of its distinct word shingles. Each hash function of the
signature gives two values, its minimum and its maximum over the set, so half
as many functions are evaluated; bands of values are bucket keys. At a likeness
of 0.8, 60 bands of 7 values miss a pair once in a million.

Equal texts are one class first. Within a bucket every class is compared with
two others only: the one that shares most buckets with most classes (of copies
with edits that is the original, nearer to all than they are to one another)
and the first. So a large group costs two rows a member. Compared means: the
likeness of the full shingle sets, exactly. Buckets whose classes then belong
to one component are done. In the others all classes meet in blocks of bounded
size and bring their sets: pairs from different components, each in the first
bucket it shares, whose 256-byte sketches agree in as many places as
likenesses down to 4.5 standard deviations below the limit do, are compared
there, exactly, and only links leave. Components are grown by
passing the smallest label along links; labels stay in tables.

Edge cases: null, empty and word-less texts have no shingles and link with
nothing; a text of fewer words than a shingle is one shingle; rows with equal
ids and texts are one node, with equal ids only are different ones; a null id
never names a component that has another; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.llm.common import cut, table
from kpimart.llm.tokens import Words

BANDS, ROWS = 60, 7
SEED = 2024
CHUNK = 2048  # shingles hashed at once
SKETCH = 256  # bytes, one for each of the first values of a signature
BLOCK = 512  # classes of a bucket that meet at once
PART_ROWS = 20_000  # of many buckets, whose sketches are compared in one group


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, words: int, known: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``words`` words."""
    if not text:
        return np.empty(0, np.uint64)
    ids = np.array([known[w] for w in text.encode("utf-8", "surrogatepass").lower().split()], np.uint64)
    if not len(ids):
        return ids
    k = min(words, len(ids))
    scale = _odd(words, SEED)
    n = len(ids) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed(out + ids[i:i + n] * scale[i])
    return np.unique(out)


def word_hashes() -> Words:
    return Words(xxhash.xxh64_intdigest)


def band_keys(s: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, bytes]:
    """A key for each band, from the minima and maxima of the hash functions, and a byte for each of the first values."""
    least = np.full(len(scale), np.iinfo(np.uint64).max, np.uint64)
    most = np.zeros(len(scale), np.uint64)
    for at in range(0, len(s), CHUNK):
        h = s[None, at:at + CHUNK] * scale[:, None] + shift[:, None]
        least = np.minimum(least, h.min(1))
        most = np.maximum(most, h.max(1))
    values = np.stack([least, most], 1).ravel()
    sketch = (mixed(values[:SKETCH]) >> np.uint64(7)).astype(np.uint8).tobytes()
    both = values[:BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + both[:, k])
    return key.view(np.int64), sketch


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark (the text's digest), n_shingles, bucket keys and sketch, a row a document."""
    def run(batches):
        known = word_hashes()
        scale, shift = _odd((BANDS * ROWS + 1) // 2, SEED + 1), _odd((BANDS * ROWS + 1) // 2, SEED + 2)
        for batch in batches:
            sets = [shingles(t, words, known) for t in batch["text"]]
            made = [band_keys(s, scale, shift) if len(s) else ([], b"") for s in sets]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "mark": batch["mark"],
                                "n_shingles": [len(s) for s in sets], "keys": [k for k, _ in made],
                                "sketch": [b for _, b in made]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text_col)).alias("mark"),
                       F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, mark binary, n_shingles long, keys array<long>, sketch binary")


def links_within(share: int):
    """Links between classes of a bucket from different components, within two blocks."""
    least = least_alike(share)

    def linked(one: np.ndarray, other: np.ndarray) -> bool:
        if 100 * min(len(one), len(other)) < share * max(len(one), len(other)):
            return False
        common = len(np.intersect1d(one, other, assume_unique=True))
        return 100 * common >= share * (len(one) + len(other) - common)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bucket, i, j = (int(k) for k in key)
        pdf = pdf.sort_values(["block", "node"])
        node, label, block = (pdf[c].to_numpy() for c in ("node", "label", "block"))
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        keys, sets = np.stack(list(pdf["keys"])), list(pdf["set"])
        found = []
        for k in range(len(pdf)):
            other = np.arange(k + 1, len(pdf))
            other = other[(label[other] != label[k]) & ((block[other] != block[k]) | (i == j))]
            other = other[(sketch[other] == sketch[k]).sum(1) >= least]
            if len(other):
                first = np.argmax(keys[other] == keys[k], axis=1)
                other = other[keys[k][first] == bucket]
            found += [(min(node[k], node[o]), max(node[k], node[o])) for o in other if linked(sets[k], sets[o])]
        return pd.DataFrame(found, columns=["a", "b"])
    return run


def near_nodes(share: int):
    """The rows of many (bucket, i, j) that have a partner ``links_within`` would compare sets with.

    Buckets lie one after the other, and each row meets the one ``d`` places
    on, for all buckets at once. Rows leave, never pairs.
    """
    least = least_alike(share)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "i", "j", "block", "node"], ignore_index=True)
        bucket, i, j, block, label = (pdf[c].to_numpy() for c in ("bucket", "i", "j", "block", "label"))
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        keys = np.stack(list(pdf["keys"]))
        group = np.cumsum(np.r_[True, (np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)])
        near, at, d = np.zeros(len(pdf), bool), np.arange(len(pdf)), 0
        while len(at):
            d += 1
            at = at[at + d < len(pdf)]
            at = at[group[at] == group[at + d]]
            some = at[(label[at] != label[at + d]) & ((block[at] != block[at + d]) | (i[at] == j[at]))]
            for part in np.array_split(some, len(some) // 50_000 + 1):
                part = part[(sketch[part] == sketch[part + d]).sum(1) >= least]
                first = np.argmax(keys[part] == keys[part + d], axis=1)
                part = part[keys[part, first] == bucket[part]]
                near[part] = near[part + d] = True
        return pdf.loc[near, ["bucket", "i", "j", "block", "node", "label"]]
    return run


def least_alike(share: int) -> int:
    """Equal bytes of two sketches below which sets of that likeness practically never stay."""
    p = share / 100 + (1 - share / 100) / 256
    return int(SKETCH * (p - 4.5 * (p * (1 - p) / SKETCH) ** 0.5))


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """node and its whole shingle set, in the shared folder, for ``nodes`` (node, distinct)."""
    def sets(batches):
        known = word_hashes()
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"],
                                "set": [shingles(t, words, known).view(np.int64) for t in batch["text"]]})

    wanted = classes.select("node", "mark", "first_id").join(nodes, "node")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text_col)).alias("of"),
                        F.col(text_col).alias("text"))
    found = wanted.join(texts, (F.col("mark") == F.col("of")) & F.col("first_id").eqNullSafe(F.col("id")))
    return cut(found.select("node", "text").mapInPandas(sets, "node long, set array<long>"), "sets").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, share: int, id_col: str,
              text_col: str) -> DataFrame:
    """The ``pairs`` (a, b) with 100 * intersection >= share * union of their full sets."""
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    full = full_sets(needed, classes, docs, words, id_col, text_col)
    sized = pairs.join(full.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b").join(
        full.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    near = sized.filter((100 * F.least(F.size("sa"), F.size("sb")) >= share * F.greatest(F.size("sa"), F.size("sb"))))
    near = near.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return near.filter(100 * F.col("common") >= share * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for the nodes of ``links`` (a, b)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut(both, "links")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("label")), "labels")
    while True:
        told = both.join(labels.select(F.col("node").alias("a"), "label"), "a").groupBy(F.col("b").alias("node")).agg(
            F.min("label").alias("told"))
        nearer = labels.join(told, "node").select("node", F.col("label").alias("was"), F.least("label", "told").alias("label"))
        # A label is a node: its own label is nearer still.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = cut(nearer.join(jump, "label").select("node", "was", F.least("label", "beyond").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter(F.col("was") != F.col("label")).isEmpty():
            return labels


def near_duplicates(docs: DataFrame, words: int = 5, share: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, mark, n_shingles, component_id, kept and leads, a row a document.

    ``kept``: the id is its component's smallest. ``leads`` is true for one
    node of each component, also where ids repeat; equal rows share a node.
    """
    known = cut(signatures(docs, words, id_col, text_col), "signatures")
    classes = known.filter(F.col("n_shingles") > 0).groupBy("mark").agg(
        F.min("doc_id").alias("first_id"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("node", F.explode("keys").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter(F.col("n") > 1)
    members = cut(buckets.join(shared, "bucket"), "members")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    centers = members.select("bucket", "node").join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "node"))["node"].alias("center"))
    ends = F.explode(F.array(*[F.struct(F.least(c, "node").alias("a"), F.greatest(c, "node").alias("b"))
                               for c in ("center", "low")])).alias("p")
    stars = members.join(centers, "bucket").select(ends).select("p.a", "p.b").filter(F.col("a") < F.col("b"))
    stars = cut(stars.distinct(), "pairs")
    links = cut(confirmed(stars, classes, docs, words, share, id_col, text_col), "confirmed")
    labels = components(links)

    # Buckets that still hold several components: their classes meet in blocks.
    placed = members.select("bucket", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = placed.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter(F.col("l") < F.col("h"))
    open_ = cut(placed.join(several.select("bucket"), "bucket"), "open")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = open_.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.join(classes.select("node", "keys", "sketch"), "node").select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label",
        "keys", "sketch")
    # Sketches first, many buckets a group; whole sets only for classes that then have a partner.
    rows = open_.agg(F.sum(blocks)).first()[0] or 0
    part = F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(rows // PART_ROWS + 1))
    near = cut(dealt.withColumn("part", part).groupBy("part").applyInPandas(
        near_nodes(share), "bucket long, i int, j int, block int, node long, label long"), "near")
    sets = full_sets(near.select("node").distinct(), classes, docs, words, id_col, text_col)
    near = near.join(classes.select("node", "keys", "sketch").join(sets, "node"), "node")
    more = cut(near.groupBy("bucket", "i", "j").applyInPandas(links_within(share), "a long, b long"), "more")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    named = classes.select("mark", "first_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = cut(named, "named")
    first = named.groupBy("label").agg(F.min("first_id").alias("component_id"),
                                       F.min(F.struct(F.col("first_id").isNull(), "first_id", "mark")).alias("lead"))
    whole = named.join(first, "label").select("mark", "first_id", "component_id", (F.col("lead.mark") == F.col("mark")).alias("leads"))
    out = known.select("doc_id", "mark", "n_shingles").join(
        whole.withColumnRenamed("mark", "of"), (F.col("mark") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "mark", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (alone | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
                      (alone | (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("first_id")))).alias("leads"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4).select("doc_id", "n_shingles", "component_id", "kept")
