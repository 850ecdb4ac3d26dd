"""Sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpimart.sources.manifest import commit_runs, read_manifest


def is_path(source: str) -> bool:
    return "/" in source or source.endswith(".parquet") or "://" in source


def read_source(spark: SparkSession, source: str, columns: Sequence[str] | Mapping[str, str] | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Scan a table or a path and keep only the declared columns.

    ``columns`` is a list of names, or a mapping source name -> new name.
    A missing column raises before any job runs. The projection reaches
    the Parquet scan (``ReadSchema``), so undeclared columns are never read.
    """
    df = spark.read.format(fmt).load(source) if is_path(source) else spark.table(source)
    if columns is None:
        return df
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    have = {f.name.lower(): f.name for f in df.schema.fields}
    missing = [c for c in mapping if c.lower() not in have]
    if missing:
        raise ValueError(f"{source}: missing columns {missing}; has {sorted(have.values())}")
    return df.select(*[F.col(have[src.lower()]).alias(dst) for src, dst in mapping.items()])


def conform(df: DataFrame, schema: StructType, required: Sequence[str] = ()) -> DataFrame:
    """Order columns by the declared schema, cast, and fail on NULL in ``required``.

    Columns are matched by name (never by position). Casts are ANSI, so a
    value beyond DECIMAL(9,2) raises instead of turning NULL. A NULL in a
    required column raises when the job runs.
    """
    have = {f.name.lower(): f.name for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"missing mart columns {missing}")
    req = {r.lower() for r in required}
    current = {f.name: f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = have[f.name.lower()]
        c = F.col(src)
        if current[src].dataType != f.dataType:
            c = c.cast(f.dataType.simpleString())
        if f.nullable and not current[src].nullable and f.name.lower() not in req:
            # Declared NULL-able: expose it as such whatever plan produced it.
            c = F.when(c.isNotNull(), c)
        if f.name.lower() in req:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in required column {f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass(frozen=True)
class Run:
    """A written and validated copy of a mart that is not current yet."""

    name: str
    place: str
    rows: int
    df: DataFrame


def write_run(df: DataFrame, schema: StructType, target: str, required: Sequence[str] = (),
              partition_by: Sequence[str] = (), fmt: str = "parquet") -> Run:
    """Write the rows of a refresh beside the mart's earlier runs, and check them.

    The rows are conformed and validated as they are written (a NULL key or a
    DECIMAL(9,2) overflow raises), read back and counted.

    ``partition_by`` names columns to lay folders out by. The folders carry
    copies; the columns stay in the files, so ``''`` and NULL stay apart and
    the declared column order holds.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    out = conform(df, schema, required)
    copies = {f"__folder_{c}": F.when(F.col(c).isNull(), "null").when(F.col(c) == "", "empty").otherwise(
        F.concat(F.lit("is "), F.col(c).cast("string"))) for c in partition_by}
    written = Observation(f"rows of {run}")
    writer = out.withColumns(copies).observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    if copies:
        writer = writer.partitionBy(*copies)
    if is_path(target):
        place = f"{target.rstrip('/')}/runs/{run}"
        writer.save(place)
    else:
        place = f"{target}__{run}"
        writer.saveAsTable(place)
    back = _run(spark, place, schema, fmt)
    expected, found = written.get.get("rows", 0), back.count()
    if expected != found:
        raise RuntimeError(f"{place}: wrote {expected} rows, read {found}; the previous mart stays")
    return Run(run, place, found, back)


def write_mart(df: DataFrame, schema: StructType, target: str, required: Sequence[str] = (),
               partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """Full-refresh a mart (O02): write the new rows beside the old, then switch.

    Every refresh writes a run of its own (:func:`write_run`): a folder under
    ``target``, or a table named after it. Only then does the mart point at
    the run: for a path through the next manifest of the folder it lies in
    (:mod:`kpimart.sources.manifest`), which two writers cannot both claim; a
    table name is a view that is replaced. Whatever fails before leaves the
    previous mart as it was. Earlier runs stay until ``expire_runs``. Returns
    the mart read back.
    """
    run = write_run(df, schema, target, required, partition_by, fmt)
    if is_path(target):
        folder, name = _split(target)
        commit_runs(df.sparkSession, folder, {name: {"run": run.name, "rows": run.rows}})
    else:
        columns = ", ".join(f"`{c}`" for c in schema.fieldNames())
        df.sparkSession.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT {columns} FROM {run.place}")
    return run.df


def _split(target: str) -> tuple[str, str]:
    """The folder of marts and the mart's name."""
    folder, _, name = target.rstrip("/").rpartition("/")
    return folder or ".", name


def _run(spark: SparkSession, place: str, schema: StructType, fmt: str) -> DataFrame:
    """One run with the declared columns, in their order."""
    df = spark.read.format(fmt).schema(schema).load(place) if is_path(place) else spark.table(place)
    return df.select(*schema.fieldNames())


def read_mart(spark: SparkSession, target: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The mart's current rows, in the declared column order."""
    if not is_path(target):
        return spark.table(target).select(*schema.fieldNames())
    folder, name = _split(target)
    return read_marts(spark, folder, {name: schema}, fmt=fmt)[name]


def read_marts(spark: SparkSession, folder: str, schemas: Mapping[str, StructType], number: int | None = None,
               fmt: str = "parquet") -> dict[str, DataFrame]:
    """Several marts of a folder as one manifest names them: the current one, or ``number``."""
    folder = folder.rstrip("/") or "/"
    marts = read_manifest(spark, folder, number).marts
    missing = sorted(set(schemas) - set(marts))
    if missing:
        raise ValueError(f"{folder}: no refresh of {', '.join(missing)} has succeeded yet")
    return {n: _run(spark, f"{folder}/{n}/runs/{marts[n]['run']}", schema, fmt) for n, schema in schemas.items()}


def stage(df: DataFrame, name: str | None = None, mode: str = "persist", by: Sequence[str] = (),
          columns: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Reusable staging result (O03), like ``SELECT .. INTO #temp``.

    ``persist``: MEMORY_AND_DISK cache; a lost executor recomputes its
    blocks from lineage. ``checkpoint``: reliable checkpoint into the
    shared ``spark.checkpoint.dir``, cutting the lineage. ``bucketed``: a
    table in the warehouse with ``columns`` (all by default), dealt by ``by``
    into ``buckets`` files (as many as shuffle partitions) that are sorted by
    it, so that joins and groupings on these columns read it without a
    shuffle; ``unstage`` drops it. The result is also registered as a temp
    view when ``name`` is given.
    """
    if mode == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
    elif mode == "checkpoint":
        from kpimart.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        out = df.checkpoint(eager=True)
    elif mode == "bucketed":
        out = _bucketed(df if columns is None else df.select(*columns), list(by), buckets)
    elif mode == "none":
        out = df
    else:
        raise ValueError(f"unknown stage mode {mode!r}")
    if name:
        out.createOrReplaceTempView(name)
    return out


def _bucketed(df: DataFrame, by: list[str], buckets: int | None) -> DataFrame:
    if not by:
        raise ValueError("a bucketed stage needs the columns it is dealt by")
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"kpimart_stage_{uuid.uuid4().hex}"
    # Dealt as the buckets are, each bucket comes from one task and is one file.
    df.repartition(n, *by).write.format("parquet").bucketBy(n, *by).sortBy(*by).saveAsTable(table)
    out = spark.table(table)
    out._kpimart_stage = table
    return out


def unstage(df: DataFrame, name: str | None = None) -> None:
    """Drop a staged result (``DROP TABLE #temp``)."""
    df.unpersist()
    table = getattr(df, "_kpimart_stage", None)
    if table:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if name:
        df.sparkSession.catalog.dropTempView(name)


@contextmanager
def staged(df: DataFrame, name: str | None = None, mode: str = "persist", **how) -> Iterator[DataFrame]:
    """``stage`` for the length of a ``with`` block; its cache, table and view go at the end.

    A cached plan serves every equal plan of the session, so a cache that
    outlives its use makes other queries read it instead of their tables.
    """
    out = stage(df, name, mode, **how)
    try:
        yield out
    finally:
        unstage(out, name)
