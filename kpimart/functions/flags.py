"""0/1 indicator and label expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _flag(cond: Column) -> Column:
    # CASE WHEN cond THEN 1 ELSE 0: NULL conditions give 0.
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def sla_flag(done: ColumnOrName, deadline: ColumnOrName, status: ColumnOrName | None = None,
             done_values: Iterable[str] | None = None, as_date: bool = True) -> Column:
    """1 when the work is done by the deadline, else 0.

    ``as_date=True``: status in ``done_values`` and date(done) <= date(deadline).
    ``as_date=False``: deadline >= done without casting ``done``, so a
    completion later on the deadline day misses (the DATE side is widened
    to midnight).
    """
    if as_date:
        cond = F.to_date(_c(done)) <= F.to_date(_c(deadline))
    else:
        cond = _c(deadline) >= _c(done)
    if status is not None:
        if done_values is None:
            raise ValueError("status given without done_values")
        cond = _c(status).isin(list(done_values)) & cond
    return _flag(cond)


def threshold_flag(c: ColumnOrName, limit) -> Column:
    """1 when c <= limit, NULL and above give 0."""
    return _flag(_c(c) <= F.lit(limit))


def _like_escape(prefix: str) -> str:
    return prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def prefix_match(c: ColumnOrName, prefix: str, ignore_case: bool = True,
                 negate: bool = False) -> Column:
    """``c LIKE 'prefix%'`` as a predicate; NULL stays NULL.

    Used as a filter, NULL rows are dropped in both the plain and the
    negated form, as with SQL ``NOT LIKE``.
    """
    pattern = _like_escape(prefix) + "%"
    col = _c(c)
    pred = col.ilike(pattern) if ignore_case else col.like(pattern)
    return ~pred if negate else pred


def prefix_flag(c: ColumnOrName, prefix: str, ignore_case: bool = True) -> Column:
    """1 when c starts with prefix, NULL gives 0."""
    return _flag(prefix_match(c, prefix, ignore_case))


def relabel(c: ColumnOrName, mapping: Mapping[str, str], default: ColumnOrName | None = None,
            keep_other: bool = False, ignore_case: bool = False) -> Column:
    """Map codes to labels (O16); ``ignore_case`` compares without case and trailing blanks.

    ``keep_other=True`` keeps unmapped values (merging spellings);
    otherwise unmapped values give ``default`` (NULL when None, a CASE
    without ELSE).
    """
    col = _c(c)
    by_label: dict[str, list[str]] = {}
    for code, label in mapping.items():
        by_label.setdefault(label, []).append(code.rstrip(" ").lower() if ignore_case else code)
    out = None
    key = F.lower(F.rtrim(col)) if ignore_case else col
    for label, codes in by_label.items():
        cond = key == codes[0] if len(codes) == 1 else key.isin(codes)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if keep_other:
        fallback = col
    elif default is None:
        fallback = F.lit(None).cast("string")
    else:
        fallback = _c(default) if not isinstance(default, str) else F.lit(default)
    return fallback if out is None else out.otherwise(fallback)
