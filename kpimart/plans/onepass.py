"""One-pass evaluation of a mart's measures.

Per base: one histogram (a partial-aggregated shuffle of the base down to
the columns its measures read, with a row-count weight ``__n``). Per
grouping level of that base: one aggregate with a conditional sum per
measure (``SUM(CASE WHEN filter THEN ..)``) for all count / ratio / sum
measures, and one radix selection over the histogram's value counts for all
percentile measures. The results are unpivoted to long rows with
``inline``. A measure whose filter matches no row of a group emits no row
for it, as a GROUP BY would.

The per-measure expressions are written as SQL text (``selectExpr`` /
``F.expr``): each is parsed on the JVM in one call, which keeps building a
13-measure plan on the driver cheap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from kpimart.operators.measures import DENOM, VALUE, exact_share
from kpimart.operators.scope import all_of_sql, segment_sql, sql_ident, sql_literal
from kpimart.operators.selection import disc_place, nth_values

WEIGHT = "__n"
KEY = "__measure"
N = sql_ident(WEIGHT)


def spec_filter_sql(spec) -> str:
    """The measure's filter (scope conditions and segment) as SQL text."""
    parts = []
    if spec.where:
        parts.append(all_of_sql(spec.where))
    if spec.segment is not None:
        seg = segment_sql(spec.segment)
        if seg:
            parts.append(seg)
    return " AND ".join(f"({p})" for p in parts) if parts else "true"


def _nonnull_flag(value: str) -> str:
    return f"__nn_{value}"


def histogram(df: DataFrame, weight: str | None, specs: Sequence) -> DataFrame:
    """Distinct combinations of every column the specs read, with a weight.

    A counted column (``COUNT(col)``) enters only as its IS NOT NULL flag,
    so a unique id never widens the histogram.
    """
    keys: dict[str, str] = {}
    for s in specs:
        for c in list(s.by) + list(s.carry) + sorted(s.filter_columns()):
            keys.setdefault(c, sql_ident(c))
        if s.value is not None:
            if s.kind == "count":
                keys.setdefault(_nonnull_flag(s.value), f"{sql_ident(s.value)} IS NOT NULL")
            else:
                keys.setdefault(s.value, sql_ident(s.value))
    w = f"sum({sql_ident(weight)})" if weight else "count(1)"
    return df.groupBy(*[_expr(e, n) for n, e in keys.items()]).agg(_expr(f"CAST({w} AS BIGINT)", WEIGHT))


def _expr(sql: str, alias: str):
    from pyspark.sql import functions as F

    return F.expr(f"{sql} AS {sql_ident(alias)}")


def _dims(specs: Sequence) -> list[str]:
    """Output dimensions shared by specs unpivoted together, in a fixed order.

    Every spec must supply each one, from its group columns (``by`` and
    ``carry``) or as the ``''`` all-members sentinel (``collapse``).
    """
    dims: list[str] = []
    for s in specs:
        for d in list(s.by) + list(s.carry) + list(s.collapse):
            if d not in dims:
                dims.append(d)
    for s in specs:
        missing = set(dims) - set(s.by) - set(s.carry) - set(s.collapse)
        if missing:
            raise ValueError(f"{s.key}: no value for dimensions {sorted(missing)}")
    return dims


def _row_sql(spec, load_sql: str, dims: Sequence[str], value: str, denominator: str, present: str,
             value_type: str) -> str:
    fields = [f"'{KEY}', {sql_literal(spec.key)}", f"'Load_Date', {load_sql}"]
    fields += [f"{sql_literal(k)}, {sql_literal(v)}" for k, v in sorted(spec.labels.items())]
    grouped = set(spec.by) | set(spec.carry)
    # Rows that are dropped below, as those of another level, can hold sums too large for the type: they are not cast.
    value, denominator = (f"CASE WHEN {present} THEN {x} END" for x in (value, denominator))
    fields += [f"{sql_literal(d)}, {sql_ident(d) if d in grouped else chr(39) * 2}" for d in dims]
    fields += [
        f"'{VALUE}', CAST({value} AS {value_type})",
        f"'{DENOM}', CAST({denominator} AS {value_type})",
        f"'__present', {present}",
    ]
    return f"named_struct({', '.join(fields)})"


def _long(agg: DataFrame, rows: list[str], denom: bool) -> DataFrame:
    """Unpivot one struct per measure into rows, dropping absent measures."""
    out = agg.selectExpr(f"inline(array({', '.join(rows)}))")
    out = out.where("__present").drop("__present")
    return out if denom else out.drop(DENOM)


def _grouping_id(by: Sequence[str], cols: Sequence[str]) -> int:
    # grouping_id(): one bit per grouping column, first column highest, 1 = rolled up.
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in by)


def _simple_level(hist: DataFrame, sets: Sequence[tuple[str, ...]], specs: Sequence, load_sql: str,
                  value_type: str, denom: bool) -> DataFrame:
    """All count / ratio / sum measures of a base in one aggregate.

    Measures grouped at different levels (detail and month) share one
    ``GROUPING SETS`` aggregate, so the histogram is shuffled once; each
    measure keeps only the rows of its own set (``grouping_id()``).
    """
    cols: list[str] = []
    for b in sets:
        cols += [c for c in b if c not in cols]
    multi = len(sets) > 1
    grouped = hist.groupingSets([list(b) for b in sets], *cols) if multi else hist.groupBy(*cols)
    dims = _dims(specs)
    aggs, rows = [], []
    for i, s in enumerate(specs):
        f = spec_filter_sql(s)
        matched = f"sum(CASE WHEN {f} THEN {N} END)"  # NULL when no row matches: no output row
        if s.kind == "count":
            v = matched if s.value is None else \
                f"sum(CASE WHEN {f} THEN (CASE WHEN {sql_ident(_nonnull_flag(s.value))} THEN {N} ELSE 0 END) END)"
            d = sql_literal(s.denominator if s.denominator is not None else 0)
        else:  # ratio (flag) or sum (quantity): SUM(x) over COUNT(*)
            v = f"sum(CASE WHEN {f} THEN {sql_ident(s.value)} * {N} END)"
            d = f"__d{i}"
        aggs += [_expr(v, f"__v{i}"), _expr(matched, f"__d{i}")]
        present = f"__d{i} IS NOT NULL"
        if multi:
            present += f" AND __gid = {_grouping_id(s.by, cols)}"
        rows.append(_row_sql(s, load_sql, dims, f"__v{i}", d, present, value_type))
    if multi:
        aggs.append(_expr("grouping_id()", "__gid"))
    return _long(grouped.agg(*aggs), rows, denom)


def _percentile_level(hist: DataFrame, by: Sequence[str], specs: Sequence, load_sql: str,
                      value_type: str, denom: bool) -> DataFrame:
    """All discrete percentiles of one level and one value column in one selection.

    The histogram is first summed to one row a group and value, with one
    weight a measure (partial on every task), and unpivoted to a row a measure
    (``__m``). The measure is then part of the group, and one radix selection
    finds every group's value: no window holds all distinct values of a group.
    """
    from pyspark.sql import functions as F

    q = sql_ident(specs[0].value)
    dims = _dims(specs)
    filters = [spec_filter_sql(s) for s in specs]
    weights = [_expr(f"sum(CASE WHEN {f} THEN {N} END)", f"__w{i}") for i, f in enumerate(filters)]
    values = hist.groupBy(*by, _expr(q, "__q")).agg(*weights)
    each = ", ".join(f"named_struct('__m', {i}, '__w', __w{i})" for i, _ in enumerate(specs))
    values = values.selectExpr(*[sql_ident(b) for b in by], "__q", f"inline(array({each}))").where("__w IS NOT NULL")
    shares = [exact_share(s.p) for s in specs]
    num, den = (F.expr(f"CASE __m {' '.join(f'WHEN {i} THEN {x[j]}L' for i, x in enumerate(shares))} END") for j in (0, 1))
    found = nth_values(values, [*by, "__m"], "__q", "__w", disc_place(num, den), specs[0].domain_bits)
    rows = [_row_sql(s, load_sql, dims, "__v", "__nn", f"__m = {i}", value_type) for i, s in enumerate(specs)]
    return _long(found, rows, denom)


def _carry(hist: DataFrame, spec, load_sql: str, value_type: str, denom: bool) -> DataFrame:
    """Percentile over a partition, repeated on each distinct (partition, carry) row.

    Both come from the histogram: the percentile is selected from the
    partition's value counts, without the carried columns, and joined to the
    (partition, carry) groups that the measure's filter leaves. The filter is a
    conditional weight, not a Filter, so the histogram subtree stays identical
    to the other levels' and its shuffle is reused instead of rescanning the
    base.
    """
    from pyspark.sql import functions as F

    f = spec_filter_sql(spec)
    by = list(spec.by)
    values = hist.groupBy(*by, _expr(sql_ident(spec.value), "__q")).agg(
        _expr(f"sum(CASE WHEN {f} THEN {N} END)", "__w")).where("__w IS NOT NULL")
    found = nth_values(values, by, "__q", "__w", disc_place(*exact_share(spec.p)), spec.domain_bits)
    found = found.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], "__v")
    finer = hist.groupBy(*by, *spec.carry).agg(_expr(f"max(CASE WHEN {f} THEN 1 END)", "__a")).where("__a IS NOT NULL")
    cond = F.lit(True)
    for i, c in enumerate(by):
        cond = cond & finer[c].eqNullSafe(found[f"__k{i}"])
    d = sql_literal(spec.denominator if spec.denominator is not None else 0)
    return _long(finer.join(found, cond), [_row_sql(spec, load_sql, _dims([spec]), "__v", d, "true", value_type)], denom)


def evaluate(df: DataFrame, weight: str | None, specs: Sequence, load_sql: str, value_type: str,
             denom: bool, checkpoint: bool = False) -> list[DataFrame]:
    """Long-format rows of all ``specs`` over one base, tagged with ``__measure``."""
    hist = histogram(df, weight, specs)
    if checkpoint:
        from kpimart.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(hist.sparkSession)
        hist = hist.checkpoint(eager=True)
    simple: dict[tuple, list] = {}
    pct: dict[tuple, list] = {}
    out = []
    for s in specs:
        if s.kind == "carry":
            out.append(_renamed(_carry(hist, s, load_sql, value_type, denom), s.rename))
        elif s.kind == "percentile":
            pct.setdefault((s.value, tuple(s.by), s.rename, s.domain_bits), []).append(s)
        else:
            dims = frozenset(s.by) | frozenset(s.collapse)
            simple.setdefault((dims, s.rename), []).append(s)
    for (_dims_key, rename), ss in simple.items():
        sets = list(dict.fromkeys(tuple(s.by) for s in ss))
        out.append(_renamed(_simple_level(hist, sets, ss, load_sql, value_type, denom), rename))
    for (_value, by, rename, _bits), ss in pct.items():
        out.append(_renamed(_percentile_level(hist, by, ss, load_sql, value_type, denom), rename))
    return out


def _renamed(df: DataFrame, rename) -> DataFrame:
    return df.withColumnsRenamed(dict(rename)) if rename else df


def mart_rows(bases: Mapping, specs: Sequence, load_sql: str, value_type: str, denom: bool,
              checkpoint: bool = False) -> list[DataFrame]:
    by_base: dict[str, list] = {}
    for s in specs:
        by_base.setdefault(s.base, []).append(s)
    out = []
    for name, ss in by_base.items():
        b = bases[name]
        out += evaluate(b.df, b.weight, ss, load_sql, value_type, denom, checkpoint)
    return out
