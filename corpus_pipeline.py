"""Training-data pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; further columns of the input are
kept. Null texts count as empty ones; repeated rows and ids are handled as the
operators state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.llm.common import cut, fresh, table
from kpimart.llm.dedup import near_duplicates
from kpimart.llm.mixing import copies_of, mix_sources
from kpimart.llm.packing import pack_documents
from kpimart.llm.pii import fit_pii, redacted, spans
from kpimart.llm.quality import THRESHOLD, fit_quality, quality_score


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model rejects go."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_score(model, F.col("text")) >= THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, likeness 0.8) stays."""
    mark, lead_id, lead_mark, row = (fresh(docs, c) for c in ("mark", "lead_id", "lead_mark", "row"))
    leads = near_duplicates(docs).filter("leads").select(F.col("doc_id").alias(lead_id), F.col("mark").alias(lead_mark)).distinct()
    rows = docs.withColumn(mark, F.unhex(F.md5("text")))
    kept = rows.join(leads, rows["doc_id"].eqNullSafe(F.col(lead_id)) & rows[mark].eqNullSafe(F.col(lead_mark)), "left_semi")
    # Rows of one id and text may differ in other columns: the one that stays is the same in every run.
    told = F.xxhash64(*[F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    one = kept.groupBy("doc_id", mark).agg(F.min_by(F.struct(*docs.columns), told).alias(row))
    return one.select(f"{row}.*")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; ``n_chars`` follows."""
    model = fit_pii(docs)
    found = fresh(docs, "found")
    rows = docs.withColumn(found, spans(F.coalesce("text", F.lit("")), model))
    rows = rows.withColumn("text", redacted(F.col("text"), F.col(found))).drop(found)
    return rows.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return copies_of(docs, mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece: where it lies in which sequence, and its token ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 0, 2048)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_pii),
    ("mix", mix),
    ("pack", pack),
]

# Classifiers, hashing and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
