"""Measure operators (O22-O28) on literal edge rows, plus weighted equivalence."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpimart.operators import collapse_dims, count_measure, percentile_carry, percentile_measure, ratio_measure, \
    stack, sum_measure
from tests.conftest import rows

L = {"Measure_Type": "m"}


def test_count_nonnull_all_null_gives_zero(spark):
    df = spark.createDataFrame([("g", None), ("g", None)], "g string, x long")
    out = count_measure(df, ["g"], L, counted="x").collect()
    assert [(r.g, r.Measure_Values, r.Denominator) for r in out] == [("g", Decimal("0.00"), Decimal("0.00"))]
    assert count_measure(df, ["g"], L, denominator=None).columns == ["g", "Measure_Type", "Measure_Values"]


def test_sum_skips_null_denominator_counts_it(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("g", None)], "g string, x long")
    r = sum_measure(df, ["g"], L, "x").first()
    assert (r.Measure_Values, r.Denominator) == (Decimal("3.00"), Decimal("3.00"))


def test_ratio_null_flag_in_denominator(spark):
    df = spark.createDataFrame([("g", 1), ("g", 0), ("g", 0)], "g string, f int")
    r = ratio_measure(df, ["g"], L, "f").first()
    assert (r.Measure_Values, r.Denominator) == (Decimal("1.00"), Decimal("3.00"))


def test_percentile_edges(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", None)] + [("c", i) for i in range(1, 11)],
                               "g string, x long")
    got = {r.g: (r.Measure_Values, r.Denominator) for r in percentile_measure(df, ["g"], L, "x", 0.9).collect()}
    assert got["a"] == (Decimal("2.00"), Decimal("2.00"))
    assert got["b"] == (None, Decimal("0.00"))
    assert got["c"] == (Decimal("9.00"), Decimal("10.00"))


@pytest.mark.parametrize("seed", [1, 2])
def test_weighted_percentile_equals_expanded_rows(spark, seed):
    rnd = random.Random(seed)
    data = [(f"g{rnd.randint(0, 6)}", rnd.choice([None] + list(range(40))), rnd.randint(1, 4)) for _ in range(400)]
    df = spark.createDataFrame(data, "g string, x long, w long")
    expanded = df.select("g", "x", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("_"))
    plain = percentile_measure(expanded, ["g"], L, "x", 0.9)
    weighted = percentile_measure(df, ["g"], L, "x", 0.9, weight="w")
    assert rows(plain) == rows(weighted)
    assert rows(sum_measure(expanded, ["g"], L, "x")) == rows(sum_measure(df, ["g"], L, "x", weight="w"))
    assert rows(count_measure(expanded, ["g"], L, "x")) == rows(count_measure(df, ["g"], L, "x", weight="w"))


def test_percentile_carry_repeats_value_per_ward(spark):
    df = spark.createDataFrame([("m", "A", 1), ("m", "B", 5), ("m", None, 9), ("m", "A", 3)],
                               "m string, ward string, x long")
    out = percentile_carry(df, ["m"], ["ward"], L, "x", 0.9).collect()
    assert len(out) == 3 and {r.Measure_Values for r in out} == {Decimal("9.00")}
    w = percentile_carry(df.withColumn("n", F.lit(1)), ["m"], ["ward"], L, "x", 0.9, weight="n").collect()
    assert rows(spark.createDataFrame(out)) == rows(spark.createDataFrame(w))


def test_percentile_carry_null_partition_key(spark):
    df = spark.createDataFrame([(None, "A", 1), (None, "B", 2), ("t", "A", 7)], "t string, ward string, x long")
    out = {(r.t, r.ward): r.Measure_Values for r in percentile_carry(df, ["t"], ["ward"], L, "x", 0.9).collect()}
    assert out == {(None, "A"): Decimal("2.00"), (None, "B"): Decimal("2.00"), ("t", "A"): Decimal("7.00")}


def test_stack_distinct_and_all(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    assert stack([a, a], distinct=True).count() == 1
    assert stack([a, a], distinct=False).count() == 2
    with pytest.raises(ValueError):
        stack([a, spark.createDataFrame([("x", "1")], "k string, v string")], distinct=True)


def test_collapse_dims(spark):
    df = spark.createDataFrame([("m", "A-C"), ("m", "R-3")], "m string, jc string")
    out = count_measure(collapse_dims(df, ["jc"]), ["m", "jc"], L)
    assert [(r.m, r.jc, r.Measure_Values) for r in out.collect()] == [("m", "", Decimal("2.00"))]


def test_percentile_aggregate_equals_window_distinct_form(spark):
    from tests.conftest import SF0001

    df = spark.read.parquet(f"{SF0001}/orders.parquet").select(
        F.last_day(F.to_date("o_orderdate")).alias("m"), "o_orderpriority",
        F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderkey") % 97).alias("x"))
    ours = percentile_measure(df, ["m", "o_orderpriority"], L, "x", 0.9)
    df.createOrReplaceTempView("pct_src")
    window_form = spark.sql("""
        SELECT DISTINCT m, o_orderpriority, 'm' AS Measure_Type,
          CAST(percentile_disc(0.9) WITHIN GROUP (ORDER BY x) OVER (PARTITION BY m, o_orderpriority)
               AS DECIMAL(9,2)) AS Measure_Values,
          CAST(count(x) OVER (PARTITION BY m, o_orderpriority) AS DECIMAL(9,2)) AS Denominator
        FROM pct_src""")
    assert rows(ours) == rows(window_form)
