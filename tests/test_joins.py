"""Enrichment joins and per-key ranking."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpimart.operators import enrich, enrich_multiplicity, first_per_key, latest_flag, latest_per_key, \
    require_related
from tests.conftest import rows


def test_enrich_keeps_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id long, w string")
    out = enrich(left, dim, {"k": "id"}, ["w"])
    assert rows(out) == [(1, "a", "x"), (1, "a", "y"), (2, "b", "z"), (3, "c", None)]


def test_enrich_distinct_pair_still_fans_out(spark):
    left = spark.createDataFrame([(10,), (20,)], "addr long")
    dim = spark.createDataFrame([(10, "W1"), (10, "W1"), (10, "W2"), (20, "W3")], "address_id long, ward string")
    out = enrich(left, dim, {"addr": "address_id"}, ["ward"], distinct=True)
    assert rows(out) == [(10, "W1"), (10, "W2"), (20, "W3")]


def test_enrich_multiplicity_equals_fan_out_count(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    dim = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "id long")
    weighted = enrich_multiplicity(left, dim, {"k": "id"}, "w")
    assert rows(weighted) == [(1, 3), (2, 1), (3, 1), (None, 1)]
    fanned = enrich(left, dim, {"k": "id"}, [])
    assert weighted.agg(F.sum("w")).first()[0] == fanned.count() == 6


def test_require_related_edge_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (4,)], "ssl long")
    owners = spark.createDataFrame([(2, None), (3, "Y"), (4, "N")], "ssl_key long, delcode string")
    out = require_related(left, owners, {"ssl": "ssl_key"}, F.col("delcode") != "Y", columns=["delcode"])
    assert rows(out) == [(4, "N")]   # unmatched, NULL code and Y are dropped
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan


def test_first_per_key_rank_then_filter(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        (1, t(2024, 1, 1), 1, "Other"), (1, t(2024, 1, 2), 2, "Housing"),
        (2, t(2024, 1, 3), 3, "Housing"), (2, t(2024, 1, 3), 4, "Housing"),
    ], "case long, done timestamp_ntz, eid long, grp string")
    first = first_per_key(df, "case", ["done"], ["eid"])
    assert rows(first.filter(F.col("grp") == "Housing").select("case", "eid")) == [(2, 3)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_flag_matches_row_number(spark, inputs_small):
    n = inputs_small["class_notice"]
    tie = ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus"]
    ours = latest_flag(n.select("ssl_info", "record_date", *tie), "ssl_info", ["record_date"], tie, "f")
    w = Window.partitionBy("ssl_info").orderBy(F.col("record_date").desc(), *tie)
    ref = n.select("ssl_info", "record_date", *tie).withColumn(
        "f", F.when(F.row_number().over(w) == 1, 1).otherwise(0))
    assert rows(ours) == rows(ref)
    latest = latest_per_key(n.select("ssl_info", "record_date", *tie), "ssl_info", ["record_date"], tie)
    assert latest.count() == ours.filter("f = 1").count() == n.select("ssl_info").distinct().count()


def test_first_per_key_without_tie_is_deterministic(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, "b"), (1, t, "a"), (2, t, "z")], "k long, d timestamp_ntz, v string")
    first = first_per_key(df.repartition(3), "k", ["d"], [])
    assert rows(first) == [(1, t, "a"), (2, t, "z")]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
