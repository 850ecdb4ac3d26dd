"""The bounded sample of labelled documents that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimart.llm.common import held_out


def training_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """text and label of at most ``bound`` labelled documents outside the held-out fold.

    Chosen by a hash of the id, so reruns agree. ``bound`` rows of two numbers
    are the most that is broadcast, and as many rows come back: an id with
    several rows counts with its least text (null last).
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    return rows.agg(F.min("text").alias("text")).select("doc_id", "text", "label")
