"""Mart builder (O29): measure specs -> measures -> stack -> conformed mart.

Two plans evaluate the same specs:

``plain``   each measure aggregates its base directly (the reference's
            shape: one aggregate per UNION branch).
``onepass`` each base is first reduced to a histogram over exactly the
            columns its measures read (group dims, filter columns, flags,
            quantities) with a row-count weight; every measure then runs
            on that small table with the weight. The base is scanned and
            shuffled once per mart instead of once per measure, and the
            shuffle carries partially aggregated rows only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpimart.functions.dates import ts_lit
from kpimart.operators.measures import (
    collapse_dims,
    count_measure,
    percentile_carry,
    percentile_measure,
    ratio_measure,
    sum_measure,
)
from kpimart.operators.scope import Segment, scope, segment, sql_literal
from kpimart.operators.stack import stack
from kpimart.sources.io import conform

KINDS = ("count", "ratio", "sum", "percentile", "carry")
WEIGHT = "__n"


@dataclass(frozen=True)
class MeasureSpec:
    """One long-format measure: one branch of the source's UNION."""

    key: str
    base: str
    kind: str
    labels: Mapping[str, str]
    by: tuple[str, ...]
    value: str | None = None
    where: tuple = ()
    segment: Segment | None = None
    collapse: tuple[str, ...] = ()
    carry: tuple[str, ...] = ()
    denominator: int | None = 0
    p: float = 0.9
    rename: tuple[tuple[str, str], ...] = ()   # base column -> output column
    domain_bits: int | None = None   # percentiles: values lie in a domain of 2 ** domain_bits numbers

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"{self.key}: kind {self.kind!r} not in {KINDS}")
        if any(isinstance(w, Column) for w in self.where):
            raise ValueError(f"{self.key}: conditions are (op, column, value) tuples, in either plan")
        if self.kind != "count" and self.value is None:
            raise ValueError(f"{self.key}: {self.kind} needs a value column")

    def filter_columns(self) -> set[str]:
        cols = {w[1] for w in self.where}
        if self.segment is not None:
            cols |= set(self.segment.columns)
        return cols


@dataclass(frozen=True)
class MartSpec:
    name: str
    schema: Callable[..., StructType]
    measures: tuple[MeasureSpec, ...]
    distinct: bool
    required: tuple[str, ...] = ("Load_Date", "Month_EndDate_Key")


@dataclass
class Base:
    """A staged input of a mart and its optional row-weight column."""

    df: DataFrame
    weight: str | None = None


def renamed(df: DataFrame, rename: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply a spec's output names (a base may hold two variants of a dimension)."""
    return df.withColumnsRenamed(dict(rename)) if rename else df


def run_measure(spec: MeasureSpec, df: DataFrame, load_date: Column, value_type: str,
                weight: str | None = None, counted_flag: str | None = None) -> DataFrame:
    """Evaluate one spec on a base (or a histogram when ``weight`` is set)."""
    return renamed(_run_measure(spec, df, load_date, value_type, weight, counted_flag), spec.rename)


def _run_measure(spec: MeasureSpec, df: DataFrame, load_date: Column, value_type: str,
                 weight: str | None, counted_flag: str | None) -> DataFrame:
    if spec.where:
        df = scope(df, *spec.where)
    if spec.segment is not None:
        df = segment(df, spec.segment)
    if spec.collapse:
        df = collapse_dims(df, spec.collapse)
    by = list(spec.by) + list(spec.collapse)
    labels = {"Load_Date": load_date, **spec.labels}
    if spec.kind == "count":
        counted = None
        if spec.value is not None:
            counted = F.when(F.col(counted_flag), F.lit(1)) if counted_flag else F.col(spec.value)
        return count_measure(df, by, labels, counted, spec.denominator, weight, value_type)
    if spec.kind == "ratio":
        return ratio_measure(df, by, labels, spec.value, weight, value_type)
    if spec.kind == "sum":
        return sum_measure(df, by, labels, spec.value, weight, value_type)
    if spec.kind == "percentile":
        return percentile_measure(df, by, labels, spec.value, spec.p, weight, value_type, spec.domain_bits)
    return percentile_carry(df, spec.by, spec.carry, labels, spec.value, spec.p, spec.denominator,
                            weight, value_type, spec.domain_bits)


def build_measures(mart: MartSpec, bases: Mapping[str, Base], as_of: dt.datetime, value_type: str,
                   plan: str = "onepass", only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Each measure of a mart as its own DataFrame, keyed by spec key."""
    load_date = ts_lit(as_of)
    specs = [s for s in mart.measures if only is None or s.key in only]
    if plan == "plain":
        out: dict[str, DataFrame] = {}
        for s in specs:
            b = bases[s.base]
            out[s.key] = run_measure(s, b.df, load_date, value_type, weight=b.weight)
        return out
    if plan != "onepass":
        raise ValueError(f"unknown plan {plan!r}")
    from kpimart.plans.onepass import KEY, mart_rows

    denom = "Denominator" in mart.schema().fieldNames()
    long = stack(mart_rows(bases, specs, sql_literal(as_of), value_type, denom), distinct=False)
    return {s.key: long.filter(F.col(KEY) == s.key).drop(KEY) for s in specs}


def labels_disjoint(specs: Sequence[MeasureSpec], columns: Sequence[str] | None = None) -> bool:
    """True when UNION's de-duplication cannot remove a row.

    Each measure's rows are unique by its group keys (a GROUP BY output),
    and measures whose label triples differ cannot produce equal rows. Then
    UNION and UNION ALL give the same rows and the distinct shuffle is
    skipped. With ``columns`` (the output's), a group column that the output
    drops could leave equal rows, so then it is not true either.
    """
    seen = set()
    for s in specs:
        names = dict(s.rename)
        if columns is not None and not {names.get(c, c) for c in (*s.by, *s.carry)} <= set(columns):
            return False
        t = tuple(sorted(s.labels.items()))
        if t in seen:
            return False
        seen.add(t)
    return True


def build_mart(mart: MartSpec, bases: Mapping[str, Base], as_of: dt.datetime, value_type: str,
               plan: str = "onepass", checkpoint: bool = False) -> DataFrame:
    """Stack all measures of a mart and conform them to its schema."""
    from kpimart.plans.schemas import decimal_type

    schema = mart.schema(decimal_type(value_type))
    if plan == "onepass":
        from kpimart.plans.onepass import KEY, mart_rows

        denom = "Denominator" in schema.fieldNames()
        # Parts carry the mart's columns and types (plus any grouping-only
        # column, e.g. a raw code behind a label); keep the mart's columns.
        cols = schema.fieldNames()
        parts = [p.select(*cols) for p in
                 mart_rows(bases, mart.measures, sql_literal(as_of), value_type, denom, checkpoint)]
        return conform(stack(parts, distinct=mart.distinct and not labels_disjoint(mart.measures, cols)), schema,
                       mart.required)
    measures = build_measures(mart, bases, as_of, value_type, plan)
    conformed = [conform(m, schema) for m in measures.values()]
    return conform(stack(conformed, distinct=mart.distinct), schema, mart.required)
