"""Enrichment joins and per-key ranking.

Joins to data-sized lookups carry no broadcast hint: AQE measures the
shuffled side at runtime and switches to a broadcast hash join only when it
is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that a
sort-merge join runs, with AQE's skew split for hot keys on the kept side.
A broadcast is forced only for inputs whose row count is known up front.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StructField, StructType

# Row bound under which a side of known size is broadcast outright.
BROADCAST_MAX_ROWS = 2_000_000

JoinOn = str | Sequence[str] | Mapping[str, str]


def maybe_broadcast(df: DataFrame, known_rows: int | None,
                    max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a proven row bound; otherwise let AQE decide."""
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(df)
    return df


def _pairs(on: JoinOn) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def _keyed(dim: DataFrame, pairs: list[tuple[str, str]], columns: Sequence[str],
           prefix: str) -> tuple[DataFrame, list[str]]:
    keys = [f"{prefix}{i}" for i in range(len(pairs))]
    sel = [F.col(r).alias(k) for (_, r), k in zip(pairs, keys)] + [F.col(c) for c in columns]
    return dim.select(*sel), keys


def _cond(df: DataFrame, pairs: list[tuple[str, str]], keys: list[str]) -> Column:
    cond = None
    for (left, _), k in zip(pairs, keys):
        c = df[left] == F.col(k)
        cond = c if cond is None else cond & c
    return cond


def enrich(df: DataFrame, dim: DataFrame, on: JoinOn, columns: Sequence[str],
           distinct: bool = False, known_rows: int | None = None) -> DataFrame:
    """Left equi-join that brings ``columns`` from ``dim``.

    Fan-out is kept: a key matching k rows yields k rows. With
    ``distinct=True`` the lookup is first reduced to distinct
    ``(key, columns)`` rows (a partial-aggregated shuffle), as in a
    ``SELECT DISTINCT`` lookup; a key with two distinct values still fans out.
    """
    pairs = _pairs(on)
    right, keys = _keyed(dim, pairs, columns, "__ek")
    if distinct:
        right = right.distinct()
    right = maybe_broadcast(right, known_rows)
    return df.join(right, _cond(df, pairs, keys), "left").drop(*keys)


def enrich_split(df: DataFrame, dim: DataFrame, on: JoinOn, columns: Sequence[str], least: int | None = None) -> DataFrame:
    """``enrich`` with every row of the fan-out kept, for keys that are hot on the lookup side.

    A left join cannot split the lookup's side of a skewed partition, so the
    lookup's keys are counted first (:func:`hot_keys`: one aggregate, few
    keys). Rows of other keys join as ever. A hot key's lookup rows are counted
    by distinct value and these counts dealt over several salts; its rows on
    the kept side are repeated once a salt, each pair meets under one salt, and
    the counts become rows again after the join. The salts depend on the
    rows' values only, so a task that runs again deals them alike. Without hot
    keys this is ``enrich``.
    """
    pairs = _pairs(on)
    right, keys = _keyed(dim, pairs, columns, "__ek")
    right = right.toDF(*keys, *[f"__c{i}" for i in range(len(columns))])
    values = right.columns[len(keys):]
    hot = hot_keys(right.dropna(subset=keys), keys, least)
    if hot is None:
        return enrich(df, dim, on, columns)
    most = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = [f"__h{i}" for i in range(len(keys))]

    def match(side: DataFrame, cols: Sequence[str]) -> Column:
        cond = F.lit(True)
        for c, h in zip(cols, named):
            cond = cond & (side[c] == hot[h])
        return cond

    shown = [F.col(v).alias(c) for v, c in zip(values, columns)]
    lefts = [left for left, _ in pairs]
    cold_left, cold_right = df.join(hot, match(df, lefts), "left_anti"), right.join(hot, match(right, keys), "left_anti")
    cold = cold_left.join(cold_right, _cond(cold_left, pairs, keys), "left").select(*df.columns, *shown)

    counted = right.join(hot, match(right, keys)).groupBy("__hot", *values).agg(F.count(F.lit(1)).alias("__n"))
    salt, n = F.col("__salt"), F.col("__n")
    first = F.pmod(F.xxhash64(*values), F.lit(most)) if values else F.lit(0)
    mine = F.floor(n / most) + F.when(F.pmod(salt - first, F.lit(most)) < n % most, 1).otherwise(0)
    salts = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("__salt")
    dealt = counted.select("*", salts).withColumn("__copies", mine.cast("int")).filter("__copies > 0")
    dealt = dealt.select(F.col("__hot").alias("__k"), F.col("__salt").alias("__s"), "__copies", *values)
    kept = df.join(hot, match(df, lefts)).select(*df.columns, "__hot", salts)
    met = kept.join(dealt, (F.col("__hot") == F.col("__k")) & (F.col("__salt") == F.col("__s")))
    met = met.select(*df.columns, *values, F.explode(F.array_repeat(F.lit(0), F.col("__copies"))).alias("__copy"))
    return cold.union(met.select(*df.columns, *shown))


def enrich_weighted(df: DataFrame, dim: DataFrame, on: JoinOn, columns: Sequence[str], weight_col: str = "_w",
                    base_weight: str | None = None) -> DataFrame:
    """``enrich`` with equal fan-out rows kept as one row and a weight.

    The lookup is first reduced to ``(key, columns, n)`` with a map-side
    combine, so a case that is hot on both sides gives its distinct lookup
    values once a row instead of every pairing. An unmatched row stays with
    weight 1.
    """
    pairs = _pairs(on)
    right, keys = _keyed(dim, pairs, columns, "__wk")
    right = right.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("__wn"))
    out = df.join(right, _cond(df, pairs, keys), "left")
    w = F.coalesce(F.col("__wn"), F.lit(1)).cast("long")
    if base_weight is not None:
        w = w * F.col(base_weight)
    return out.withColumn(weight_col, w).drop(*keys, "__wn")


def require_related_weighted(df: DataFrame, dim: DataFrame, on: JoinOn, predicate: Column, weight_col: str = "_w",
                             base_weight: str | None = None) -> DataFrame:
    """``require_related`` with the number of related rows as a weight; ``predicate`` reads ``dim`` only."""
    pairs = _pairs(on)
    keys = [f"__rw{i}" for i in range(len(pairs))]
    counts = (dim.filter(predicate).select(*[F.col(r).alias(k) for (_, r), k in zip(pairs, keys)])
                 .groupBy(*keys).agg(F.count(F.lit(1)).alias("__rn")))
    w = F.col("__rn").cast("long")
    if base_weight is not None:
        w = w * F.col(base_weight)
    return df.join(counts, _cond(df, pairs, keys)).withColumn(weight_col, w).drop(*keys, "__rn")


def enrich_multiplicity(df: DataFrame, dim: DataFrame, on: JoinOn, weight_col: str = "_w",
                        base_weight: str | None = None) -> DataFrame:
    """Fan-out of a left join that adds no columns, kept as a row weight.

    Equivalent to ``enrich(df, dim, on, columns=[])`` followed by counting,
    without producing the duplicated rows: the lookup is pre-aggregated to
    one ``(key, n)`` row per key (map-side combine, so a key holding a third
    of the lookup is reduced on every task before the shuffle), joined 1:1,
    and ``weight = coalesce(n, 1)`` (an unmatched row survives once).
    Measures then sum the weight instead of counting rows.
    """
    pairs = _pairs(on)
    keys = [f"__mk{i}" for i in range(len(pairs))]
    counts = (dim.select(*[F.col(r).alias(k) for (_, r), k in zip(pairs, keys)])
                 .groupBy(*keys).agg(F.count(F.lit(1)).alias("__mn")))
    nonnull = None
    for k in keys:
        c = F.col(k).isNotNull()
        nonnull = c if nonnull is None else nonnull & c
    counts = counts.filter(nonnull)
    out = df.join(counts, _cond(df, pairs, keys), "left")
    w = F.coalesce(F.col("__mn"), F.lit(1)).cast("long")
    if base_weight is not None:
        w = w * F.col(base_weight)
    return out.withColumn(weight_col, w).drop(*keys, "__mn")


def require_related(df: DataFrame, dim: DataFrame, on: JoinOn, predicate: Column,
                    columns: Sequence[str] = ()) -> DataFrame:
    """Keep rows with a related ``dim`` row satisfying ``predicate``.

    Written as the reference does (left join, then a predicate on the right
    side), which Catalyst plans as an inner join. Unmatched rows and NULL
    predicate results are dropped; fan-out is kept (not a semi-join).
    ``predicate`` may only reference ``columns`` of ``dim``.
    """
    pairs = _pairs(on)
    right, keys = _keyed(dim, pairs, columns, "__rk")
    return df.join(right, _cond(df, pairs, keys), "left").filter(predicate).drop(*keys)


def _order(order: Sequence[str], descending: bool) -> list[Column]:
    # T-SQL sorts NULL lowest: first in ASC, last in DESC (Spark's defaults too).
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]


def first_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str], tie: Sequence[str],
                  descending: bool = False) -> DataFrame:
    """First row per key by ``order`` then ``tie`` (O20 / O21 with the filter on).

    ``row_number() == 1`` directly above the window: Catalyst inserts a
    partial WindowGroupLimit before the shuffle, so every task forwards at
    most one row per key and a hot key never reaches one task whole. An
    empty ``tie`` orders by all remaining columns, which keeps the choice
    deterministic when a task is recomputed.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not tie:
        # No tie-breaker given (the source has none): order by every other
        # column, so a recomputed task (lost executor) picks the same row;
        # rows tied on all of them are identical anyway.
        skip = set(keys) | set(order)
        tie = [f.name for f in df.schema.fields if f.name not in skip and not isinstance(f.dataType, MapType)]
    w = Window.partitionBy(*keys).orderBy(*_order(order, descending), *[F.col(t).asc() for t in tie])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str],
                   tie: Sequence[str]) -> DataFrame:
    """Latest row per key (O21 with the filter on)."""
    return first_per_key(df, key, order, tie, descending=True)


def latest_flag(df: DataFrame, key: Sequence[str] | str, order: Sequence[str], tie: Sequence[str],
                flag_col: str = "is_latest") -> DataFrame:
    """All rows, with ``flag_col`` = 1 on the latest row per key, else 0 (O21, filter off).

    The reference only ever compares its latest-record rank with 1, so that
    comparison is what is computed. The latest ``(key, order, tie)`` per key
    comes from :func:`first_per_key` (partial top-1 per task) and is joined
    back on key, order and tie: the join keys spread a hot key over many
    partitions and the right side holds one row per key. Of rows tied on all
    of these one is flagged, as a row number would: they are numbered among
    themselves, over the partitioning the join already made.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not tie:
        skip = set(keys) | set(order)
        tie = [f.name for f in df.schema.fields if f.name not in skip and not isinstance(f.dataType, MapType)]
    cols = keys + list(order) + list(tie)
    latest = first_per_key(df.select(*cols), keys, order, tie, descending=True)
    latest = latest.select(*[F.col(c).alias(f"__lf{i}") for i, c in enumerate(cols)],
                           F.lit(1).alias("__flag"))
    cond = None
    for i, c in enumerate(cols):
        e = df[c].eqNullSafe(F.col(f"__lf{i}"))
        cond = e if cond is None else cond & e
    out = df.join(latest, cond, "left")
    return (out.withColumn(flag_col, one_of_equal(F.col("__flag").isNotNull(), cols))
               .drop(*[f"__lf{i}" for i in range(len(cols))], "__flag"))


def one_of_equal(found: Column, cols: Sequence[str]) -> Column:
    """1 on one of the ``found`` rows of each combination of ``cols``, else 0."""
    n = F.row_number().over(Window.partitionBy(*cols).orderBy(F.lit(0)))
    return F.when(found & (n == 1), 1).otherwise(0)


def row_rank(df: DataFrame, key: Sequence[str] | str, order: Sequence[str], tie: Sequence[str],
             out_col: str, descending: bool = False) -> DataFrame:
    """The row number itself within each key by ``order`` then ``tie``.

    Keys are counted first, which runs one aggregate of ``df``. Keys of usual
    size are numbered by a window. The rows of a hot key (:func:`hot_keys`) are
    range-partitioned by the order instead, so they spread over all tasks: a
    row's number is its place in its partition plus the key's rows in the
    partitions before. Where only the first row counts, :func:`first_per_key`
    and :func:`latest_flag` are cheaper.
    """
    keys = [key] if isinstance(key, str) else list(key)
    sort = [*_order(order, descending), *[F.col(t).asc() for t in tie]]
    hot = hot_keys(df, keys)
    cold = df if hot is None else df.join(hot, _null_safe(df, hot, keys), "left_anti")
    numbered = cold.withColumn(out_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*sort)))
    if hot is None:
        return numbered
    rows = df.join(hot, _null_safe(df, hot, keys)).drop(*[f"__h{i}" for i in range(len(keys))])
    return numbered.unionByName(_rank_by_range(rows, "__hot", sort, out_col).drop("__hot"))


# A key of fewer rows is never split: one task sorts it in seconds.
HOT_KEY_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], least: int | None = None) -> DataFrame | None:
    """Keys with more than ``least`` rows and more than a quarter of an average task's; None without any.

    At most four keys a shuffle partition can be that large, which bounds the
    result: it is collected and comes back as a broadcast table of the keys
    (``__h0``, ``__h1``, ..; NULL is a key) and a number each (``__hot``).
    """
    spark = df.sparkSession
    least = HOT_KEY_ROWS if least is None else least
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).observe(total, F.sum("__n").alias("rows"))
    top = counts.filter(F.col("__n") > least).orderBy(F.col("__n").desc()).limit(most).collect()
    share = (total.get.get("rows") or 0) // most
    found = [(*r[:-1], i) for i, r in enumerate(top) if r["__n"] > share]
    if not found:
        return None
    fields = [StructField(f"__h{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    return F.broadcast(spark.createDataFrame(found, StructType([*fields, StructField("__hot", IntegerType())])))


def _null_safe(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(hot[f"__h{i}"])
    return cond


def _rank_by_range(rows: DataFrame, key: str, sort: Sequence[Column], out_col: str) -> DataFrame:
    """Row numbers by ``sort`` within each of a few keys, whose rows spread over all partitions.

    Sorted rows are numbered by partition and written to the shared checkpoint
    folder, so both readings see the same places. A key's rows by partition
    are a row each (keys plus partitions at most), summed in one small window.
    """
    from kpimart.sources.io import stage

    spark = rows.sparkSession
    bits = 33  # of monotonically_increasing_id for the place in the partition
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows tied on everything spread too: their order is free.
    spread = rows.withColumn("__any", F.monotonically_increasing_id()).repartitionByRange(n, key, *sort, "__any")
    placed = stage(spread.sortWithinPartitions(key, *sort, "__any").withColumn("__at", F.monotonically_increasing_id()),
                   mode="checkpoint")
    part = F.shiftright("__at", bits)
    runs = placed.groupBy(F.col(key).alias("__k"), part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__k").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("__k", "__part", (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    out = placed.join(F.broadcast(runs), (F.col(key) == F.col("__k")) & (part == F.col("__part")))
    return out.withColumn(out_col, (F.col("__at") + F.col("__shift")).cast("int")).drop("__any", "__at", "__k", "__part", "__shift")


def latest_rank(df: DataFrame, key: Sequence[str] | str, order: Sequence[str], tie: Sequence[str],
                keep_latest: bool = False, flag_col: str = "is_latest") -> DataFrame:
    """Latest record per key (O21): the flag on every row, or only the latest rows.

    ``keep_latest=False`` (the source's default, its filter is commented
    out) keeps all rows and adds ``flag_col``; ``True`` keeps the latest row
    per key.
    """
    if keep_latest:
        return latest_per_key(df, key, order, tie)
    return latest_flag(df, key, order, tie, flag_col)
