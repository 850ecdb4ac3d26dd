"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder of its own for each call, under the cluster's shared checkpoint folder."""
    return f"{shared_path(spark, 'llm')}/{what}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of this subpackage that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later plans start from the files, so a lost executor costs a re-read and
    not the work before it.
    """
    path = new_folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no classifier learns from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rows' places (from 0) in ``order``, without one task sorting all.

    Range-partitioned and sorted, a row's place is its place in its partition
    plus the rows before that partition; only the counts by partition are
    summed in one task.
    """
    bits = 33  # of monotonically_increasing_id for the place in the partition
    dealt = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = cut(dealt.withColumn(name, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(F.col(name), bits)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    return placed.join(F.broadcast(firsts), part == F.col("part")).withColumn(
        name, F.col("first") + F.col(name).bitwiseAND((1 << bits) - 1)).drop("part", "first")
