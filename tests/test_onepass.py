"""The one-pass engine against the plain operators on expanded rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpimart.functions import ts_lit
from kpimart.operators.scope import Segment, sql_literal
from kpimart.plans.mart import MeasureSpec, run_measure
from kpimart.plans.onepass import KEY, evaluate
from tests.conftest import SF0001, rows

AS_OF = dt.datetime(2001, 8, 15)


@pytest.fixture(scope="module")
def weighted(spark):
    o = spark.read.parquet(f"{SF0001}/orders.parquet")
    return o.select(
        F.last_day(F.to_date("o_orderdate")).alias("M"), F.col("o_orderpriority").alias("P"),
        F.col("o_orderstatus").alias("S"),
        F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_orderkey") % 53).alias("x"),
        F.when(F.col("o_custkey") % 4 == 0, None).otherwise(F.col("o_custkey")).alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0).alias("flag"),
        (1 + F.col("o_orderkey") % 3).alias("w"))


def _specs():
    seg = Segment("hi", {"P": ("1-URGENT", "2-HIGH")})
    lab = lambda m: {"Section": "s", "Sub_Section": "t", "Measure_Type": m}
    out = [
        MeasureSpec("c_all", "b", "count", lab("c_all"), ("M", "P")),
        MeasureSpec("c_id", "b", "count", lab("c_id"), ("M", "P"), "id"),
        MeasureSpec("c_seg", "b", "count", lab("c_seg"), ("M",), "id", segment=seg, collapse=("P",)),
        MeasureSpec("r", "b", "ratio", lab("r"), ("M", "P"), "flag", where=(("eq", "S", "F"),)),
        MeasureSpec("s", "b", "sum", lab("s"), ("M",), "x", collapse=("P",)),
    ]
    for p in (0.1, 0.5, 0.9, 1.0):
        out.append(MeasureSpec(f"p{p}", "b", "percentile", lab(f"p{p}"), ("M",), "x", collapse=("P",), p=p))
    out.append(MeasureSpec("pc", "b", "carry", lab("pc"), ("M",), "x", carry=("P",), where=(("eq", "S", "O"),)))
    return out


def test_onepass_equals_plain_on_expanded_rows(spark, weighted):
    specs = _specs()
    parts = evaluate(weighted, "w", specs, sql_literal(AS_OF), "decimal(9,2)", denom=True)
    got = {}
    for part in parts:
        for s in specs:
            sub = part.filter(F.col(KEY) == s.key).drop(KEY)
            if sub.head(1):
                got[s.key] = sub
    expanded = weighted.select("*", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("_copy")).drop("w", "_copy")
    for s in specs:
        want = run_measure(s, expanded, ts_lit(AS_OF), "decimal(9,2)")
        cols = sorted(want.columns)
        assert s.key in got, s.key
        assert rows(got[s.key].select(*cols)) == rows(want.select(*cols)), s.key


def test_only_a_measure_s_own_rows_must_fit_the_type(spark):
    lab = lambda m: {"Section": "s", "Sub_Section": "t", "Measure_Type": m}
    specs = [MeasureSpec("days", "b", "sum", lab("days"), ("M", "P"), "x"),
             MeasureSpec("n", "b", "count", lab("n"), ("M",), collapse=("P",))]

    def got(each):
        df = spark.createDataFrame([("m", "a", each, 1), ("m", "b", each, 1)], "M string, P string, x long, w long")
        return [r for part in evaluate(df, "w", specs, sql_literal(AS_OF), "decimal(9,2)", denom=True) for r in part.collect()]

    # Each group's sum fits decimal(9,2); the month's, which no measure returns, does not.
    assert sorted((r[KEY], r.P, int(r.Measure_Values)) for r in got(9_000_000)) == [
        ("days", "a", 9_000_000), ("days", "b", 9_000_000), ("n", "", 2)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        got(10_000_000)
