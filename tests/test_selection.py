"""Radix selection of order statistics."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpimart.operators import percentile_carry, percentile_measure
from kpimart.operators.selection import code_bits, disc_place, nth_values, order_code

DOUBLES = [-math.inf, -1e308, -2.5, -1.0, -5e-324, 0.0, 5e-324, 1e-9, 0.1, 1.0, 1.0000000000000002, 3.7, 1e15, 1e308, math.inf, math.nan]


@pytest.mark.parametrize("kind,values", [
    ("double", DOUBLES), ("float", [-3.5, 0.0, 1.5, 1e30]), ("int", [-2**31, -65537, -1, 0, 1, 65535, 65536, 2**31 - 1]),
    ("long", [-2**63, -2**40, -1, 0, 7, 2**33, 2**63 - 1]), ("smallint", [-32768, -1, 0, 32767]),
    ("decimal(18,4)", [Decimal("-99999999999999.9999"), Decimal("-0.0001"), Decimal("0"), Decimal("0.0001"), Decimal("99999999999999.9999")]),
    ("date", [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]),
    ("timestamp", [dt.datetime(1960, 1, 1), dt.datetime(2024, 2, 29, 1, 2, 3, 4), dt.datetime(2024, 2, 29, 1, 2, 3, 5)])])
def test_codes_order_as_values(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").select("x", order_code(F.col("x"), df_kind(spark, kind)).alias("c"))
    codes = [r.c for r in df.orderBy("x").collect()]
    assert all(a < b for a, b in zip(codes, codes[1:]))


def df_kind(spark, kind):
    return spark.createDataFrame([], f"x {kind}").schema["x"].dataType


def cume_dist_percentile(df, p):
    """PERCENTILE_DISC by its definition, in SQL on whole numbers."""
    num, den = Decimal(str(p)).as_integer_ratio()
    df.createOrReplaceTempView("cume_rows")
    return {r.g: (r.v, r.n) for r in df.sparkSession.sql(f"""
        WITH n AS (SELECT g, count(x) AS n FROM cume_rows GROUP BY g),
        r AS (SELECT g, x, count(*) OVER (PARTITION BY g ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
              FROM cume_rows WHERE x IS NOT NULL)
        SELECT n.g, min(CASE WHEN r.run * {den} >= n.n * {num} THEN r.x END) AS v, any_value(n.n) AS n
        FROM n LEFT JOIN r ON n.g <=> r.g GROUP BY n.g""").collect()}


@pytest.mark.parametrize("kind", ["double", "int", "bigint", "decimal(12,3)", "smallint", "decimal(30,2)", "string"])
@pytest.mark.parametrize("p", [0.07, 0.55, 0.9])
def test_percentiles_equal_cume_dist(spark, kind, p):
    draw = random.Random(p)
    rows = []
    for g in ["a", "b", None, "nulls"]:
        for _ in range(300):
            x = None if g == "nulls" or draw.random() < 0.1 else round(draw.choice([draw.gauss(0, 3), draw.expovariate(1e-3), -7.0]), 3)
            rows.append((g, x))
    df = spark.createDataFrame(rows, "g string, x double").select("g", F.col("x").cast(kind).alias("x"))
    values = df.groupBy("g", "x").agg(F.count("*").alias("n"))
    num, den = Decimal(str(p)).as_integer_ratio()
    got = {r.g: (r["__v"], r["__nn"]) for r in nth_values(values, ["g"], "x", "n", disc_place(num, den)).collect()}
    assert got == cume_dist_percentile(df, p)
    assert got["nulls"] == (None, 0)


def test_a_month_of_many_values_never_meets_in_one_task(spark, monkeypatch):
    from kpimart.operators import selection

    n, windows, pick = 400_000, [], selection._pick

    def counted(rows, keys, order, nth, placed):
        windows.append(rows.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return pick(rows, keys, order, nth, placed)

    df = spark.range(n).select(F.lit("m").alias("month"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 8 - 1000.0).alias("x"),
                               F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("ward"))
    want = (n * 9 // 10 - 1) / 8 - 1000.0
    monkeypatch.setattr(selection, "_pick", counted)
    exact = [float(r.Measure_Values) for r in percentile_measure(df, ["month"], {}, "x", 0.9, value_type="decimal(18,3)").collect()]
    assert exact == [want]
    assert len(windows) == 4 and max(windows) <= 1 << 16   # rows that a group's windows held, level by level
    carried = percentile_carry(df, ["month"], ["ward"], {}, "x", 0.9, value_type="decimal(18,3)").collect()
    assert sorted((r.ward, float(r.Measure_Values)) for r in carried) == [("A", want), ("B", want)]
    windows.clear()
    whole = df.select("month", ((F.col("x") + 1000) * 8).cast("int").alias("x"))
    assert float(percentile_measure(whole, ["month"], {}, "x", 0.55, value_type="decimal(18,3)").first().Measure_Values) == n * 55 // 100 - 1
    assert len(windows) == 2 and max(windows) <= 1 << 16


@pytest.mark.parametrize("domain_bits", [None, 23, 40])
def test_a_declared_domain_changes_no_result(spark, domain_bits):
    draw = random.Random(9)
    rows = [(g, draw.choice([None, draw.randint(-50, 50), draw.randint(-2**40, 2**40)])) for g in "abc" for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, x long")   # values outside the domain are selected all the same
    for p in (0.07, 0.9):
        num, den = Decimal(str(p)).as_integer_ratio()
        got = nth_values(df.groupBy("g", "x").agg(F.count("*").alias("n")), ["g"], "x", "n", disc_place(num, den), domain_bits).collect()
        assert {r.g: (r["__v"], r["__nn"]) for r in got} == cume_dist_percentile(df, p)


def test_day_counts_of_marts_take_one_window(spark, inputs_small):
    from kpimart.plans import TEST_PARAMS, build
    from kpimart.plans.registry import TIE

    for name in ("permits", "inspections"):
        plan = build(name, inputs_small, TEST_PARAMS, "onepass", TIE)._jdf.queryExecution().optimizedPlan().toString()
        assert "__digit" not in plan and "__run" in plan
