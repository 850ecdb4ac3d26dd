"""Scope predicates and filters.

SQL three-valued logic is kept: a NOT IN list drops NULLs unless the
``or_null`` form is asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(c: Column) -> Column:
    """What text compares by under a case-insensitive collation: no case, no blanks at the end."""
    return F.lower(F.rtrim(c))


def predicate(spec: Sequence | Column, ignore_case: bool = False) -> Column:
    """One condition: a Column, or a tuple ``(op, column[, value])``, read as its SQL text."""
    return spec if isinstance(spec, Column) else F.expr(predicate_sql(spec, ignore_case))


def all_of(conds: Iterable[Sequence | Column], ignore_case: bool = False) -> Column | None:
    cols = [predicate(c, ignore_case) for c in conds]
    return reduce(lambda a, b: a & b, cols) if cols else None


def scope(df: DataFrame, *conds: Sequence | Column, ignore_case: bool = False) -> DataFrame:
    """Filter by a conjunction of conditions (O11); pushed to the scan by Catalyst.

    With ``ignore_case`` text compares without case and trailing blanks.
    """
    cond = all_of(conds, ignore_case)
    return df if cond is None else df.filter(cond)


@dataclass(frozen=True)
class Segment:
    """A named business segment: a conjunction of IN lists over dimensions."""

    name: str
    members: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def predicate(self, ignore_case: bool = False) -> Column | None:
        return all_of((("in", col, vals) for col, vals in self.members.items()), ignore_case)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.members)


def segment(df: DataFrame, seg: Segment, label_col: str | None = None, ignore_case: bool = False) -> DataFrame:
    """Rows of a segment, optionally labelled with its name."""
    cond = seg.predicate(ignore_case)
    out = df if cond is None else df.filter(cond)
    return out.withColumn(label_col, F.lit(seg.name)) if label_col else out


def transition_scope(df: DataFrame, from_col: str, to_col: str, from_values: Iterable[str],
                     to_values: Iterable[str], extra: Iterable[Sequence | Column] = (), ignore_case: bool = False) -> DataFrame:
    """Rows whose class moved from one list into another (O17); ``ignore_case`` as in :func:`scope`."""
    return scope(df, ("in", from_col, tuple(from_values)), ("in", to_col, tuple(to_values)), *extra, ignore_case=ignore_case)


# ---- conditions as SQL text, the one form that both plans read --------------
# One ``F.expr`` per condition is parsed on the JVM in a single call; a long
# IN list built from Column objects costs a round trip per value.

def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _in_sql(col: str, values) -> str:
    values = list(values)
    return f"{col} IN ({', '.join(values)})" if values else "false"


_SQL_OPS = {
    "in": lambda c, v: _in_sql(c, v),
    # NOT IN drops NULLs, as three-valued logic has it; over an empty list it keeps every row
    "not_in": lambda c, v: f"NOT ({_in_sql(c, v)})",
    "not_in_or_null": lambda c, v: f"(NOT ({_in_sql(c, v)}) OR {c} IS NULL)",
    "eq": lambda c, v: f"{c} = {v}",
    "not_null": lambda c, _=None: f"{c} IS NOT NULL",
    "gt": lambda c, v: f"{c} > {v}",
    "ge": lambda c, v: f"{c} >= {v}",
}


def predicate_sql(spec: Sequence, ignore_case: bool = False) -> str:
    """SQL text of one ``(op, column[, value])`` condition."""
    op, col, *arg = spec
    if op not in _SQL_OPS:
        raise ValueError(f"unknown scope op {op!r}; use one of {sorted(_SQL_OPS)}")
    text = op in ("in", "not_in", "not_in_or_null", "eq") and ignore_case
    values = [arg[0]] if arg and op in ("eq", "gt", "ge") else list(arg[0]) if arg else []
    text = text and all(isinstance(v, str) for v in values)
    shown = [sql_literal(v.rstrip(" ").lower() if text else v) for v in values]
    c = f"lower(rtrim({sql_ident(col)}))" if text else sql_ident(col)
    if op == "not_null":
        return f"({_SQL_OPS[op](c)})"
    return f"({_SQL_OPS[op](c, shown[0] if op in ('eq', 'gt', 'ge') else shown)})"


def all_of_sql(conds: Iterable[Sequence]) -> str | None:
    parts = [predicate_sql(c) for c in conds]
    return " AND ".join(parts) if parts else None


def segment_sql(seg: Segment) -> str | None:
    return all_of_sql(("in", col, vals) for col, vals in seg.members.items())
