"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is projected to a few axes, in several random ways; each
projection, shifted at random, is cut into a grid whose cells a Hilbert curve
passes in order. Spark range-partitions and sorts the vectors by their place on
each curve. A query looks at the windows of neighbouring places around its own
on every curve; what they hold merges and is ranked by the exact cosine.

Grid scales are fitted on at most ``fit_rows`` vectors. The window is measured,
not guessed: for ``probes`` vectors the true neighbours are found by brute
force over all rows, and the window is the least distance in places within
which ``recall`` of them lie on some curve. All vectors are indexed.

Equal vectors are one class with its smallest ids: a list of k neighbours, ties
to smaller ids, cannot hold more than k + 1 of them. Before each cut to k + 1 the
classes are spread to ids and an id counts once, with its best score.

Edge cases: vectors that are null, empty, zero, hold null or non-finite
components, have no id or another length than most take no part; repeated ids
are one neighbour with the nearest of their vectors; with fewer candidates than
``k`` all are returned; without candidates a query has no rows; an empty table
gives none; only the two named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import cut, global_rank, table

AXES, BITS = 8, 7
BLOCK = 4096  # places in a block at most


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (rows x axes), by Skilling's transform."""
    x = cells.T.astype(np.int64)
    axes = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(axes):
            far = (x[i] & q) != 0
            swap = np.where(far, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(far, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


@dataclass
class Curves:
    projections: np.ndarray  # curves x dimensions x axes
    middle: np.ndarray  # curves x axes
    scale: np.ndarray
    shift: np.ndarray

    def places(self, v: np.ndarray) -> np.ndarray:
        """Places (rows x curves) of vectors."""
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        out = np.empty((len(v), len(self.projections)), np.int64)
        for c, axes in enumerate(self.projections):
            z = (unit @ axes - self.middle[c]) / self.scale[c]
            share = 1 / (1 + np.exp(-1.702 * np.clip(z, -8, 8)))  # near a normal's share below z
            cells = np.clip(share * ((1 << BITS) - 1) + self.shift[c], 0, (1 << BITS) - 1).astype(np.int64)
            out[:, c] = hilbert(cells, BITS)
        return out


def fit_curves(sample: np.ndarray, curves: int, seed: int) -> Curves:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    axes = min(AXES, dim)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    turns = np.stack([np.pad(np.linalg.qr(rng.normal(size=(dim, axes)))[0], ((0, 0), (0, AXES - axes))) for _ in range(curves)])
    seen = np.einsum("nd,cda->cna", unit, turns)
    return Curves(turns, seen.mean(1), seen.std(1) + 1e-12, rng.random((curves, AXES)))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b``; a pair's value does not depend on the other rows."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def nearest(q_ids, q: np.ndarray, classes, ids, c: np.ndarray, k: int, allowed=None) -> pd.DataFrame:
    """The ``k`` nearest ids of each query, and the class of each, with exact cosines; ``ids`` has those of each class."""
    rough = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T
    if allowed is not None:
        rough[~allowed] = -9
    ids = [np.asarray(i, np.int64) for i in ids]
    held, every = np.array([len(i) for i in ids]), np.concatenate(ids)
    starts = np.cumsum(held) - held
    parts, left, most = [], np.arange(len(q)), min(k, len(ids))
    while len(left):
        # the ids of as many classes; where they are too few for lack of different ones, of twice as many
        some = rough[left]
        last = np.partition(some, len(ids) - most, axis=1)[:, len(ids) - most]
        row, col = np.nonzero((some >= last[:, None] - 1e-9) & (some > -2))
        score = cosines(q[left[row]], c[col])
        n = held[col]
        at = np.repeat(starts[col] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out = pd.DataFrame({"row": np.repeat(left[row], n), "id": every[at], "class": np.repeat(np.asarray(classes)[col], n),
                            "score": np.repeat(score, n)})
        out = out.sort_values(["row", "score", "id", "class"], ascending=[True, False, True, True]).drop_duplicates(["row", "id"])
        found = np.bincount(out["row"], minlength=len(q))
        short = left[(found[left] < k) & (last > -2) & (most < len(ids))]
        parts.append(out[~out["row"].isin(short)])
        left, most = short, min(2 * most, len(ids))
    out = pd.concat(parts) if parts else pd.DataFrame({"row": [], "id": [], "class": [], "score": []}).astype("int64")
    out.insert(0, "query", np.asarray(q_ids)[out["row"].to_numpy(np.int64)])
    out = out.sort_values(["query", "score", "id"], ascending=[True, False, True]).drop_duplicates(["query", "id"])
    return out.groupby("query", sort=False).head(k)[["query", "id", "class", "score"]]


def as_matrix(values) -> np.ndarray:
    values = list(values)
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (little-endian doubles) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    rows = rows.filter(F.size("v") == (most["n"] if most else 0))

    def pack(batches):
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "v": [np.asarray(x, "<f8").tobytes() for x in batch["v"]]})

    return cut(rows.mapInPandas(pack, "id long, v binary"), "vectors")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                       vector_col: str = "embedding", curves: int = 24, recall: float = 0.97, probes: int = 64,
                       fit_rows: int = 4096, seed: int = 5) -> DataFrame:
    """query_id, rank, id and score of the neighbours found; ``is_query`` is a condition on the column ``id``."""
    rows = usable(vectors, id_col, vector_col)
    spark = rows.sparkSession
    same = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)
    classes = cut(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.get("ids", F.lit(0)).alias("of"), "ids", "v", F.monotonically_increasing_id().alias("class")), "classes")
    total = classes.count()
    asked = rows.filter(is_query).select("id", F.col("v").alias("qv")).join(
        classes.select("class", "v"), F.col("qv") == F.col("v")).select("id", "class", "v")

    # At most fit_rows vectors, then probes times k ids, come to the driver.
    sample = [r.v for r in classes.orderBy(F.xxhash64("of"), "of", "v").limit(fit_rows).select("v").collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    made = fit_curves(as_matrix(sample), curves, seed)

    def keyed(batches):
        for batch in batches:
            at = made.places(as_matrix(batch["v"]))
            yield pd.DataFrame({"of": batch["of"], "class": batch["class"], "keys": list(at)})

    on_curves = classes.select("of", "class", "v").mapInPandas(keyed, "of long, class long, keys array<long>").select(
        "of", "class", F.posexplode("keys").alias("curve", "key"))
    order = [F.col("curve"), F.col("key"), F.col("of"), F.col("class")]
    placed = cut(global_rank(on_curves, order, "place").select("curve", "place", "class"), "placed")

    window = min(total, measured_window(classes, placed, probes, k, recall, total))
    block = max(1, min(BLOCK, window))
    reach = -(-window // block)
    held = placed.withColumn("block", F.floor(F.col("place") / block)).join(classes.select("class", "ids", "v"), "class")
    near = asked.select("class").distinct().join(placed, "class").join(classes.select("class", "v"), "class").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("place") / block) - reach, F.floor(F.col("place") / block) + reach)))

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query": [], "id": [], "class": [], "score": []}).astype({"query": "int64", "id": "int64", "class": "int64"})
        allowed = q["near_curve"].to_numpy()[:, None] == c["curve"].to_numpy()[None]
        parts = []
        for at in range(0, len(q), 1024):
            some = q.iloc[at:at + 1024]
            parts.append(nearest(some["near_class"].to_numpy(), as_matrix(some["near_v"]), c["class"].to_numpy(), c["ids"],
                                 as_matrix(c["v"]), k + 1, allowed[at:at + 1024]))
        return pd.concat(parts)

    near = near.select("block", "curve", "class", "v").toDF("near_block", "near_curve", "near_class", "near_v")
    found = near.groupBy("near_block").cogroup(
        held.select("block", "curve", "class", "ids", "v").groupBy("block")).applyInPandas(
            meet, "query long, id long, class long, score double")
    hits = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    hits = hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    each = asked.select(F.col("id").alias("query_id"), F.col("class").alias("query")).join(hits, "query").filter(
        F.col("id") != F.col("query_id"))
    each = each.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return each.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def measured_window(classes: DataFrame, placed: DataFrame, probes: int, k: int, recall: float, total: int) -> int:
    """The distance in places within which ``recall`` of the probes' true neighbours lie on some curve."""
    asked = classes.orderBy(F.xxhash64(F.lit(1), "of"), "of", "v").limit(probes).select("class", "v").collect()
    q_ids, q = [r["class"] for r in asked], as_matrix([r.v for r in asked])

    def scan(batches):
        for batch in batches:
            if len(batch):
                yield nearest(q_ids, q, batch["class"].to_numpy(), batch["of"].to_numpy()[:, None], as_matrix(batch["v"]), k + 1)

    found = classes.select("of", "class", "v").mapInPandas(scan, "query long, id long, class long, score double")
    found = found.groupBy("query", "id").agg(F.max(F.struct("score", "class")).alias("best")).select("query", "id", "best.*").filter(
        F.col("query") != F.col("class"))
    top = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    true = [(r["query"], r["class"]) for r in found.withColumn("n", F.row_number().over(top)).filter(F.col("n") <= k).collect()]
    ids = sorted({i for pair in true for i in pair})
    at: dict[int, dict[int, int]] = {}
    for r in placed.filter(F.col("class").isin(ids)).collect():
        at.setdefault(r["class"], {})[r["curve"]] = r["place"]
    apart = sorted(min(abs(at[a][c] - at[b][c]) for c in at[a]) for a, b in true)
    return max(32, apart[min(len(apart) - 1, int(np.ceil(recall * len(apart))))] if apart else total)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
