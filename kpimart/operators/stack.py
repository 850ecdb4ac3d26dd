"""Stacking measures into one long table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def stack(measures: Sequence[DataFrame], distinct: bool) -> DataFrame:
    """Union measures by column name; ``distinct=True`` is SQL ``UNION``.

    All inputs must have the same column names and types (checked on the
    driver from the analysed schemas, no job runs).
    """
    if not measures:
        raise ValueError("nothing to stack")
    first = measures[0]
    want = {f.name: f.dataType for f in first.schema.fields}
    for i, m in enumerate(measures[1:], start=1):
        got = {f.name: f.dataType for f in m.schema.fields}
        if got != want:
            raise ValueError(f"measure {i} schema {got} differs from {want}")
    out = reduce(lambda a, b: a.unionByName(b), measures)
    return out.distinct() if distinct else out
