"""Hard-negative mining by threshold joins over inverted indexes.

An anchor's positives are its best rows of the same label, its hard negatives
the best rows of other labels whose score lies in a window below a positive's.
Both come from one threshold join of anchors against all rows, in the manner of
L2AP. Rows and anchors meet in blocks. In a block, a row's leading dimensions
are left out of the inverted index as long as their norm, times the largest
norm of any anchor there, stays below the lowest threshold (a row that stays
below it whole is left out altogether). Anchors walk the lists from the last
dimensions to the first and accumulate partial scores; a pair is dropped as
soon as its sum and the norms of what remains cannot reach the threshold (or
must pass the window), and a pair that is left gets the dimensions outside the
index.

Thresholds start high and are lowered for the anchors whose windows are not
full yet, until they are or the threshold has reached the window's end. So the
result is exact whatever the first thresholds were.

Edge cases: rows with a null id, label, vector or any null or non-finite
component take no part. Repeated rows count once; an id with several labels or
vectors counts with the least (label, then vector). Missing components of a
shorter vector are zeros. Ties go by id. Vectors too long for scores of 64 bits
raise. Copies of a vector under one label are joined as one row that stands for
their smallest ids, as many as any window can take.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import cut, table

POSITIVES, NEGATIVES = 5, 3
SCALE = 256
ROW_BLOCK, ANCHOR_BLOCK = 8192, 2048
LEVEL = 8               # dimensions walked between two prunings
DENSE = 1 << 21         # partial scores held at once
FAR = 1 << 62
FIRST_HITS = 256        # rows that the first threshold should let through, by the scores' spread
HITS = "anchor_id long, positive_id long, vec_id long, score long"


def vectors(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, v): one row an id, components as floor(256 * x)."""
    label = F.col("label") if label is None else label
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                             "embedding").filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole)
    size = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") * SCALE, F.lit(2.0)))
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    fits = F.when(size < 2.0**61, parts).otherwise(F.raise_error(F.lit("a vector's scores do not fit 64 bits")))
    return rows.select("vec_id", F.struct("label", fits.alias("v")).alias("row")).groupBy("vec_id").agg(
        F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def classes(rows: DataFrame, most: int) -> DataFrame:
    """Rows of one label and vector as one, with their ``most`` smallest ids (the first of them is ``vec_id``)."""
    first = F.row_number().over(Window.partitionBy("label", "v").orderBy("vec_id"))
    few = rows.withColumn("at", first).filter(F.col("at") <= most)
    grouped = few.groupBy("label", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select("label", "v", "ids")


def spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of each dimension over all rows; the vectors' length bounds it."""
    got = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(
        F.avg(F.col("x").cast("double")).alias("mean"), F.var_pop(F.col("x").cast("double")).alias("var")).orderBy("at").toArrow()
    return got.column("mean").to_numpy().astype(float), got.column("var").to_numpy().astype(float)


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    values = column.combine_chunks()
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy().astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def head_norms(x: np.ndarray) -> np.ndarray:
    """Norms of the first 0, LEVEL, 2 * LEVEL, .. dimensions, and of all, by row."""
    squares = np.cumsum(x.astype(float) ** 2, axis=1)
    ends = [*range(LEVEL, x.shape[1], LEVEL), x.shape[1]] if x.shape[1] else []
    return np.sqrt(np.concatenate([np.zeros((len(x), 1)), squares[:, [e - 1 for e in ends]]], axis=1))


class Index:
    """Inverted lists of a block's rows for scores of at least ``least`` with vectors of the head norms ``reach``.

    Rows are sorted by where their indexed part begins, so the list of a
    dimension is a run from the first row on.
    """

    def __init__(self, x: np.ndarray, least: int, reach: np.ndarray):
        heads = head_norms(x)
        bound = heads * reach
        slack = 1 + 1e-9 * bound[:, -1:]
        below = bound + slack < least               # grows along a row: true for the levels left out
        begin = np.where(below[:, -1], len(reach), below.sum(axis=1) - 1).clip(0)
        self.rows = np.argsort(begin, kind="stable")
        self.rows = self.rows[: np.searchsorted(begin[self.rows], len(reach))]   # the others cannot reach it
        self.x, self.heads, self.begin = x[self.rows], heads[self.rows], begin[self.rows]
        self.ends = np.searchsorted(self.begin, np.arange(len(reach) - 1), side="right")
        self.norm = self.heads[:, -1].max(initial=0.0)

    def probe(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (place in ``q``, row, score) with low <= score <= high, by each vector's own bounds."""
        size = max(1, DENSE // max(1, len(self.rows)))
        parts = [self._probe(q[i:i + size], low[i:i + size], high[i:i + size], i) for i in range(0, len(q), size)]
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _probe(self, q, low, high, first):
        heads, levels = head_norms(q), len(self.ends)
        slack = 1 + 1e-9 * heads[:, -1] * self.norm
        exact = np.float64 if heads[:, -1].max(initial=0.0) * self.norm < 2**52 else np.int64
        x, qx = self.x.astype(exact), q.astype(exact)
        sums = np.zeros((len(q), len(x)), exact)
        # The last levels are walked for all pairs at once, until few of them are left.
        level, alive = levels, None
        while level > 0:
            level -= 1
            dims, n = slice(level * LEVEL, (level + 1) * LEVEL), self.ends[level]
            sums[:, :n] += qx[:, dims] @ x[:n, dims].T
            open_at = np.maximum(level, self.begin)        # what lies before has not been added to a row's sums
            rest = heads[:, open_at] * self.heads[np.arange(len(x)), open_at]
            keep = (sums + rest >= (low - slack)[:, None]) & (sums - rest <= (high + slack)[:, None])
            if keep.sum() * 8 <= keep.size:
                alive = np.nonzero(keep)
                break
        if alive is None:
            alive = np.nonzero(np.ones(sums.shape, bool))
        i, j = alive
        total, indexed = sums[i, j], self.begin[j]
        for step in range(level - 1, -1, -1):
            dims = slice(step * LEVEL, (step + 1) * LEVEL)
            on = np.flatnonzero(indexed <= step)
            total[on] += np.einsum("ij,ij->i", qx[i[on], dims], x[j[on], dims])
            open_at = np.maximum(step, indexed)
            rest = heads[i, open_at] * self.heads[j, open_at]
            keep = (total + rest >= low[i] - slack[i]) & (total - rest <= high[i] + slack[i])
            i, j, total, indexed = i[keep], j[keep], total[keep], indexed[keep]
        for step in range(levels):                  # what the index leaves out
            dims = slice(step * LEVEL, (step + 1) * LEVEL)
            on = np.flatnonzero(indexed > step)
            total[on] += np.einsum("ij,ij->i", qx[i[on], dims], x[j[on], dims])
        score = total.astype(np.int64)
        hit = (score >= low[i]) & (score <= high[i])
        return i[hit] + first, self.rows[j[hit]], score[hit]


def window_ends(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score with 50 * positive <= 100 * score <= 95 * positive, without passing 64 bits."""
    return -(-positive // 2), positive // 100 * 95 + positive % 100 * 95 // 100


def best(query: np.ndarray, rows: np.ndarray, score: np.ndarray, ids: list[np.ndarray], own: np.ndarray, most: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` ids of each query: (place of the query, id, score); ``own`` is not among them.

    Rows come in the order of their first ids, so the first ``most`` + 1 of
    them hold the first ``most`` ids.
    """
    order = np.lexsort((rows, -score, query))
    query, rows, score = query[order], rows[order], score[order]
    begins = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    place = np.arange(len(query)) - np.repeat(begins, np.diff(np.r_[begins, len(query)]))
    top = place <= most
    query, rows, score = query[top], rows[top], score[top]
    sizes = np.array([len(ids[r]) for r in rows], np.int64)
    each = np.concatenate([ids[r] for r in rows]) if len(rows) else np.zeros(0, np.int64)
    query, score = np.repeat(query, sizes), np.repeat(score, sizes)
    other = each != own[query]
    return query[other], each[other], score[other]


def threshold_join(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, spreads, same: bool, deep: float | None,
                   most: int) -> DataFrame:
    """The first ``most`` rows in each window of each anchor that lie over this round's threshold.

    ``anchors``: vec_id, label, v, windows (positive_id, score). With ``same``,
    an anchor's one window is open upwards and begins ``deep`` deviations over
    its mean score (None: nowhere); else windows lie below their positives and
    the threshold lies the share ``deep`` of a window under its upper end.
    Rows are ``classes``. Every anchor block meets every row block, so rows are
    shuffled once for each ``ANCHOR_BLOCK`` anchors.
    """
    mean, var = spreads
    dims, order = len(mean), np.argsort(mean**2 + var, kind="stable")   # heavy dimensions last: they are indexed
    n_row, n_anchor = max(1, math.ceil(n_rows / ROW_BLOCK)), max(1, math.ceil(n_anchors / ANCHOR_BLOCK))
    left = anchors.withColumn("ab", F.pmod(F.xxhash64("vec_id"), F.lit(n_anchor)).cast("int")).withColumn(
        "rb", F.explode(F.sequence(F.lit(0), F.lit(n_row - 1))))
    right = rows.withColumn("rb", F.pmod(F.xxhash64("v", "label"), F.lit(n_row)).cast("int")).withColumn(
        "ab", F.explode(F.sequence(F.lit(0), F.lit(n_anchor - 1))))

    def bounds(q, asked):
        """Rows (anchor, positive id, low, high), one a window."""
        flat = asked.flatten()
        of = np.repeat(np.arange(len(asked)), np.diff(asked.offsets.to_numpy()))
        positive = flat.field("positive_id").to_numpy(zero_copy_only=False)
        if same:
            if deep is None:
                low = np.full(len(of), -FAR)
            else:
                qo = q.astype(float)
                low = np.floor(qo @ mean[order] + deep * np.sqrt(qo**2 @ var[order])).clip(-FAR, FAR).astype(np.int64)[of]
            return of, positive, low, np.full(len(of), FAR)
        low, high = window_ends(flat.field("score").to_numpy())
        return of, positive, np.maximum(low, high - np.ceil((high - low) * deep).astype(np.int64)), high

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if asked.num_rows and held.num_rows:
            held = held.take(np.argsort([i[0] for i in held.column("ids").to_pylist()], kind="stable"))
            x, q = matrix(held.column("v"), dims)[:, order], matrix(asked.column("v"), dims)[:, order]
            ids = [np.asarray(i, np.int64) for i in held.column("ids").to_pylist()]
            own, labels = asked.column("vec_id").to_numpy(), asked.column("label").to_numpy()
            of, positive, low, high = bounds(q, asked.column("windows").combine_chunks())
            row_labels, found = held.column("label").to_numpy(), []
            for label in np.unique(labels):
                mine = np.flatnonzero((labels == label)[of])          # windows of anchors of this label
                here = np.flatnonzero((row_labels == label) == same)
                who = np.unique(of[mine])                             # an anchor's windows share one walk
                if not len(here) or not len(who):
                    continue
                least, greatest = np.full(len(q), FAR), np.full(len(q), -FAR)
                np.minimum.at(least, of[mine], low[mine])
                np.maximum.at(greatest, of[mine], high[mine])
                index = Index(x[here], int(least[who].min()), head_norms(q[who]).max(axis=0))
                pair, row, score = index.probe(q[who], least[who], greatest[who])
                pair = who[pair]
                # each window with the pairs of its anchor
                by = np.argsort(pair, kind="stable")
                pair, row, score = pair[by], here[row[by]], score[by]
                from_, to = np.searchsorted(pair, of[mine]), np.searchsorted(pair, of[mine], side="right")
                window = np.repeat(mine, to - from_)
                at = np.arange(len(window)) - np.repeat(np.cumsum(to - from_) - (to - from_), to - from_) + np.repeat(from_, to - from_)
                ok = (score[at] >= low[window]) & (score[at] <= high[window])
                w, i, s = best(window[ok], row[at[ok]], score[at[ok]], ids, own[of], most)
                found.append((own[of[w]], w, i, s))
            if found:
                out = [np.concatenate(c) for c in zip(*found, strict=True)]
            positives = pa.array(positive, pa.int64(), from_pandas=True).take(pa.array(out[1]))
        else:
            positives = pa.array([], pa.int64())
        return pa.table({"anchor_id": pa.array(out[0], pa.int64()), "positive_id": positives,
                         "vec_id": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.int64())})

    hits = left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(meet, HITS)
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most)


def _rounds(anchors: DataFrame, rows: DataFrame, n_rows: int, spreads, same: bool, depths: Iterator[float | None], most: int
            ) -> DataFrame:
    """Threshold joins, one threshold after the other, for the windows that are not full yet."""
    done, depths = None, list(depths)
    for deep in depths:
        n = anchors.count()
        if not n and done is not None:
            break
        got = cut(threshold_join(anchors, rows, n, n_rows, spreads, same, deep, most), "mined")
        windows = anchors.select("vec_id", F.explode("windows").alias("w")).select("vec_id", "w.*")
        full = got.filter(F.col("rank") == most).select(F.col("anchor_id").alias("a"), F.col("positive_id").alias("p"))
        is_full = (F.col("vec_id") == F.col("a")) & F.col("w_positive").eqNullSafe(F.col("p"))
        if deep == depths[-1]:
            kept = got
        else:
            kept = got.join(full, (got["anchor_id"] == full["a"]) & got["positive_id"].eqNullSafe(full["p"]), "left_semi")
            left = windows.withColumn("w_positive", F.col("positive_id")).join(full, is_full, "left_anti")
            left = left.groupBy("vec_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("windows"))
            anchors = cut(anchors.drop("windows").join(left, "vec_id"), "mined-left")
        done = kept if done is None else done.unionByName(kept)
    return done


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Hard negatives of ``anchors`` (some of ``rows``; both vec_id, label, v as by :func:`vectors`)."""
    spreads = spread(rows)
    held = cut(classes(rows, max(positives + 1, negatives)), "mining-classes")
    n_rows = held.count()
    asked = cut(anchors.select("vec_id", "label", "v"), "mining-anchors")

    open_window = F.array(F.struct(F.lit(None).cast("long").alias("positive_id"), F.lit(None).cast("long").alias("score")))
    shares = [FIRST_HITS * 16**i / n_rows for i in range(16) if FIRST_HITS * 16**i < n_rows / 2]
    depths = [*(NormalDist().inv_cdf(1 - s) for s in shares), None]
    near = _rounds(asked.withColumn("windows", open_window), held, n_rows, spreads, True, depths, positives)
    near = cut(near.select("anchor_id", F.col("vec_id").alias("positive_id"), "score"), "mined-positives")

    # A negative score has an empty window.
    windows = near.filter("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "score")).alias("windows"))
    found = _rounds(asked.join(windows, "vec_id"), held, n_rows, spreads, False, [1 / 16, 1 / 4, 1.0], negatives)
    found = found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
    return found.join(near.withColumnRenamed("score", "positive_score"), ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = cut(vectors(table(spark, sf_dir, "embeddings"), label), "mining-rows")
    return hard_negatives(rows, rows.filter(F.col("vec_id") % 50 == 0))


OP12_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
