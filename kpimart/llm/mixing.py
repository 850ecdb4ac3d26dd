"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target of words: a share by weight, at most ``cap`` times
what it has, the excess reshared. A document is taken as often as the whole
part of target / size of its source says, and once more for a balanced sample
with the fractional part as inclusion probability. The cube method moves three
undecided probabilities at a time along the null space of the two constraints
(words taken, documents taken) until one becomes 0 or 1. Blocks of bounded size
do this in parallel; the two or so undecided documents a block leaves go to the
next round, where they form new blocks, until one block a source holds them.
There the landing phase gives up the document count first, rounds the last
document, and changes single documents while that brings the words nearer.

Edge cases: a null text has size 0 and an unknown source (null) is a source,
last in order; rows with equal ids are documents of their own; equal rows are
interchangeable; an empty table gives no rows; only the named columns are read.
Random numbers depend on the rows only, so reruns agree.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import cut, fresh, global_rank, table

WORD = "[^\\x20\\x09-\\x0D]+"
TINY = 1e-9


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def flight(size: np.ndarray, prob: np.ndarray, rng, land: bool) -> np.ndarray:
    """Decide inclusion for units with probabilities strictly inside (0, 1).

    Keeps the sums of ``size * prob`` and of ``prob``. Up to two stay undecided;
    with ``land`` they too end at 0 or 1 and the words are as near as single
    changes bring them.
    """
    p, s = prob.tolist(), size.tolist()
    draws = iter(rng.random(2 * len(p) + 8).tolist())
    live: list[int] = []
    at = 0

    def move(u):
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in u if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in u if d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in u:
            p[i] += step * d
            p[i] = 0.0 if p[i] < TINY else 1.0 if p[i] > 1 - TINY else p[i]
        live[:] = [i for i in live if 0 < p[i] < 1]

    while True:
        while len(live) < 3 and at < len(p):
            if 0 < p[at] < 1:
                live.append(at)
            at += 1
        if len(live) < 3:
            break
        a, b, c = live
        u = [(a, s[b] - s[c]), (b, s[c] - s[a]), (c, s[a] - s[b])]
        most = max(abs(d) for _, d in u)
        move([(i, d / most) for i, d in u] if most else [(a, 1.0), (b, -1.0)])
    if land:
        if len(live) == 2:
            a, b = live
            move([(a, s[b] / max(s[a], s[b])), (b, -s[a] / max(s[a], s[b]))])
        for i in live:
            p[i] = float(next(draws) < p[i])
        return settle(size, prob, np.asarray(p))
    return np.asarray(p)


def settle(size: np.ndarray, prob: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """End of the landing: while it brings the words nearer, change the one document that does so most."""
    off = float(size @ (taken - prob))
    change = np.where(taken > 0, -size, size)
    while len(size):
        i = int(np.argmin(np.abs(off + change)))
        if abs(off + change[i]) >= abs(off) - 0.5:
            break
        off += change[i]
        taken[i], change[i] = 1 - taken[i], -change[i]
    return taken


def targets(sizes: DataFrame, weights: tuple, share: float, cap: float) -> DataFrame:
    """source, source_size, target from ``sizes`` (source, source_size, a row each).

    The reshare: the sources not yet at their cap split by weight what the
    others leave, and those that then reach their cap join the others. Two
    numbers a round come to the driver.
    """
    ranked = global_rank(sizes, [F.col("source").asc_nulls_last()], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    known = cut(ranked.select("source", "source_size", (F.col("source_size") * F.lit(cap)).alias("most"),
                              F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).alias("weight")), "sources")
    wanted = share * (known.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        held, weight = known.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (wanted - (held or 0.0)) / weight if weight else level
        if new <= level:
            break
        level = new
    return known.select("source", "source_size", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def decide(seed: int, number: int, land: bool):
    """The flight over one block; its random numbers depend on the block's name and the round."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "mark", "n"], ascending=[False, True, True, True])
        name = 0 if pd.isna(key[0]) else 1 + zlib.crc32(str(key[0]).encode())
        rng = np.random.default_rng([seed, number, name, int(key[1])])
        return pdf.assign(prob=flight(pdf["size"].to_numpy(float), pdf["prob"].to_numpy(float), rng, land))
    return run


def mix_sources(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 1024,
                seed: int = 11) -> DataFrame:
    """A row a document: doc_id, mark and n (which tell equal ids apart), source, size, source_size, target, copies."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"),
                       F.xxhash64(text_col, source_col).alias("mark"))
    same = Window.partitionBy("doc_id", "mark").orderBy("size")
    units = cut(rows.withColumn("n", F.row_number().over(same)), "units")
    goal = cut(targets(units.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
               .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)),
               "targets")
    # Sources are few beside rows: Spark broadcasts the targets by their size, or splits a hot source's rows.
    aimed = units.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    whole = F.floor("rate")
    part = F.col("rate") - whole
    undecided = aimed.filter((F.col("size") > 0) & (part > TINY) & (part < 1 - TINY)).select(
        "doc_id", "mark", "n", "source", "size", part.alias("prob"))
    keys = ["doc_id", "mark", "n"]
    shape = "doc_id long, mark long, n int, source string, size long, prob double, round int, block long"
    done, number = None, 0
    while True:
        per_source = undecided.groupBy("source").agg(F.count("*").alias("units")).select(
            F.col("source").alias("of"), F.greatest(F.lit(1), F.ceil(F.col("units") / block)).alias("blocks"))
        most = per_source.agg(F.max("blocks")).first()[0]
        if most is None:
            break
        last = most <= 1
        dealt = undecided.join(per_source, F.col("source").eqNullSafe(F.col("of"))).select(
            *keys, "source", "size", "prob", F.lit(number).alias("round"),
            F.pmod(F.xxhash64(F.lit(seed + number), "doc_id", "mark", "n"), F.col("blocks")).alias("block"))

        out = cut(dealt.groupBy("source", "block").applyInPandas(decide(seed, number, last), shape), "flight")
        sure = out.filter((F.col("prob") <= 0) | (F.col("prob") >= 1)).select(*keys, F.col("prob").cast("int").alias("extra"))
        done = sure if done is None else done.unionByName(sure)
        if last:
            break
        undecided = out.filter((F.col("prob") > 0) & (F.col("prob") < 1)).select(*keys, "source", "size", "prob")
        number += 1
    copies = F.when(part >= 1 - TINY, whole + 1).otherwise(whole)
    if done is None:
        return aimed.withColumn("copies", copies.cast("int")).drop("rate")
    extra = done.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), F.col("n").alias("k"), "extra")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (F.col("n") == F.col("k"))
    return aimed.join(extra, same, "left").withColumn(
        "copies", (copies + F.coalesce("extra", F.lit(0))).cast("int")).drop("rate", "d", "m", "k", "extra")


def copies_of(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as ``mix`` (from ``mix_sources`` over the same rows) takes it.

    Rows of one id, text and source are told apart by their other columns, so
    reruns agree on which of them is taken.
    """
    mark, n = fresh(docs, "mark"), fresh(docs, "n")
    told = [F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    same = Window.partitionBy(id_col, mark).orderBy(F.xxhash64(*told))
    rows = docs.withColumn(mark, F.xxhash64(text_col, source_col)).withColumn(n, F.row_number().over(same))
    taken = mix.filter(F.col("copies") > 0).select(
        F.col("doc_id").alias("taken_id"), F.col("mark").alias("taken_mark"), F.col("n").alias("taken_n"), "copies")
    taken = taken.toDF(*[fresh(docs, c) for c in taken.columns])
    i, m, k, copies = (F.col(c) for c in taken.columns)
    found = rows.join(taken, F.col(id_col).eqNullSafe(i) & (F.col(mark) == m) & (F.col(n) == k))
    return found.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), copies)).alias(fresh(docs, "copy"))).select(*docs.columns)


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
