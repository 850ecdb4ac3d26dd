"""Long-format measure operators.

Every measure returns ``by`` columns, constant label columns,
``Measure_Values`` and (optionally) ``Denominator``, cast to the mart's
value type. An empty group gives no row; NULL handling is SQL's.

Each operator takes an optional ``weight`` column: a row then stands for
``weight`` identical rows. This serves two plans with one code path:
fan-out kept as a weight (see ``enrich_multiplicity``) and the one-pass
plan, where a pre-aggregated histogram row carries its row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpimart.operators.selection import disc_place, nth_values

VALUE_TYPE = "decimal(9,2)"
VALUE = "Measure_Values"
DENOM = "Denominator"

By = Sequence[str | tuple[str, Column]]


def _by(by: By) -> list[Column]:
    out = []
    for b in by:
        out.append(F.col(b) if isinstance(b, str) else b[1].alias(b[0]))
    return out


def _by_names(by: By) -> list[str]:
    return [b if isinstance(b, str) else b[0] for b in by]


def _labels(labels: Mapping[str, object]) -> list[Column]:
    out = []
    for name, v in labels.items():
        col = v if isinstance(v, Column) else F.lit(v)
        if isinstance(v, str):
            col = col.cast("string")
        out.append(col.alias(name))
    return out


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _finish(agg: DataFrame, by: By, labels: Mapping[str, object], denominator,
            value_type: str) -> DataFrame:
    cols = [F.col(n) for n in _by_names(by)] + _labels(labels)
    cols.append(F.col("__v").cast(value_type).alias(VALUE))
    if denominator is not None:
        d = F.col("__d") if denominator == "__d" else F.lit(denominator)
        cols.append(d.cast(value_type).alias(DENOM))
    return agg.select(*cols)


def count_measure(df: DataFrame, by: By, labels: Mapping[str, object], counted: Column | str | None = None,
                  denominator: int | None = 0, weight: str | None = None,
                  value_type: str = VALUE_TYPE) -> DataFrame:
    """``COUNT(*)`` or ``COUNT(col)`` per group (O22); denominator constant or absent."""
    if weight is None:
        v = F.count(F.lit(1)) if counted is None else F.count(_c(counted))
    else:
        w = F.col(weight)
        v = F.sum(w) if counted is None else F.sum(F.when(_c(counted).isNotNull(), w).otherwise(0))
    agg = df.groupBy(*_by(by)).agg(v.alias("__v"))
    return _finish(agg, by, labels, denominator, value_type)


def ratio_measure(df: DataFrame, by: By, labels: Mapping[str, object], flag: Column | str,
                  weight: str | None = None, value_type: str = VALUE_TYPE) -> DataFrame:
    """``SUM(flag)`` over ``COUNT(*)`` per group."""
    f = _c(flag)
    if weight is None:
        aggs = [F.sum(f).alias("__v"), F.count(F.lit(1)).alias("__d")]
    else:
        w = F.col(weight)
        aggs = [F.sum(f * w).alias("__v"), F.sum(w).alias("__d")]
    agg = df.groupBy(*_by(by)).agg(*aggs)
    return _finish(agg, by, labels, "__d", value_type)


def sum_measure(df: DataFrame, by: By, labels: Mapping[str, object], quantity: Column | str,
                weight: str | None = None, value_type: str = VALUE_TYPE) -> DataFrame:
    """``SUM(x)`` over ``COUNT(*)`` per group (O24): NULL x is skipped in the
    sum but counted in the denominator."""
    q = _c(quantity)
    if weight is None:
        aggs = [F.sum(q).alias("__v"), F.count(F.lit(1)).alias("__d")]
    else:
        w = F.col(weight)
        aggs = [F.sum(q * w).alias("__v"), F.sum(w).alias("__d")]
    agg = df.groupBy(*_by(by)).agg(*aggs)
    return _finish(agg, by, labels, "__d", value_type)


def _value_counts(df: DataFrame, keys: Sequence[str], q: Column, weight: Column | None) -> DataFrame:
    """One row a group and value (NULL included) with its number of rows; partial on every task."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*[F.col(k) for k in keys], q.alias("__q")).agg(w.alias("__w"))


def exact_share(p: float) -> tuple[int, int]:
    """``p`` as written in decimal, as a fraction of whole numbers."""
    return Decimal(str(p)).as_integer_ratio()


def percentile_measure(df: DataFrame, by: By, labels: Mapping[str, object], quantity: Column | str,
                       p: float = 0.9, weight: str | None = None,
                       value_type: str = VALUE_TYPE, domain_bits: int | None = None) -> DataFrame:
    """Discrete ``p`` percentile with ``COUNT(x)`` as denominator.

    The reference's window + DISTINCT form equals this group aggregate,
    since its output holds only partition keys. Rows are counted by distinct
    value first (partial on every task); the value itself comes from a radix
    selection over these counts (:func:`nth_values`), so a group with any
    number of distinct values is spread over tasks. ``p`` is used as a decimal
    fraction in whole numbers: a double's ``ceil(p * n)`` is one too high
    for some ``p``. A group whose values are all NULL gives NULL over 0.
    """
    keys = _by_names(by)
    base = df.select(*_by(by), _c(quantity).alias("__x"), *([F.col(weight).alias("__w")] if weight else []))
    counts = _value_counts(base, keys, F.col("__x"), F.col("__w") if weight else None)
    found = nth_values(counts, keys, "__q", "__w", disc_place(*exact_share(p)), domain_bits)
    return _finish(found.withColumnRenamed("__nn", "__d"), by, labels, "__d", value_type)


def percentile_carry(df: DataFrame, partition: By, carry: Sequence[str], labels: Mapping[str, object],
                     quantity: Column | str, p: float = 0.9, denominator: int | None = 0,
                     weight: str | None = None, value_type: str = VALUE_TYPE,
                     domain_bits: int | None = None) -> DataFrame:
    """Percentile over a coarse partition, repeated on each finer distinct row.

    Same rows as ``PERCENTILE_DISC(..) OVER (PARTITION BY partition)``
    followed by ``DISTINCT`` over partition + carry columns. The percentile is
    selected from the partition's value counts, which know nothing of the
    carried columns, and joined to the distinct (partition, carry) rows; NULL
    partition keys group together as in a window PARTITION BY.
    """
    keys = _by_names(partition)
    base = df.select(*_by(partition), *[F.col(c) for c in carry], _c(quantity).alias("__x"),
                     *([F.col(weight).alias("__w")] if weight else []))
    counts = _value_counts(base, keys, F.col("__x"), F.col("__w") if weight else None)
    found = nth_values(counts, keys, "__q", "__w", disc_place(*exact_share(p)), domain_bits)
    found = found.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__v")
    finer = base.select(*keys, *carry).distinct()
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & finer[k].eqNullSafe(found[f"__k{i}"])
    out = finer.join(found, cond).select(*keys, *carry, "__v")
    return _finish(out, list(keys) + list(carry), labels, denominator, value_type)


def collapse_dims(df: DataFrame, dims: Sequence[str], sentinel: str = "") -> DataFrame:
    """Replace dimensions by the all-members sentinel before grouping."""
    return df.withColumns({d: F.lit(sentinel).cast("string") for d in dims})
