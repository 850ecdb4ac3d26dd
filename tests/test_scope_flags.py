"""Scope predicates, flags and labels (O11-O17) on literal edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from kpimart.functions import prefix_flag, prefix_match, relabel, sla_flag, threshold_flag
from kpimart.operators import Segment, scope, segment, transition_scope


def test_not_in_drops_null_or_null_keeps(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert sorted(r.s for r in scope(df, ("not_in", "s", ["a"])).collect()) == ["b"]
    assert sorted((r.s or "~") for r in scope(df, ("not_in_or_null", "s", ["a"])).collect()) == ["b", "~"]
    assert scope(df, ("not_null", "s")).count() == 2


def test_lower_bound_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 10, 1, 0, 0, 0),), (dt.datetime(2022, 10, 1, 0, 0, 1),)],
                               "t timestamp_ntz")
    assert [r.t.second for r in scope(df, ("gt", "t", dt.datetime(2022, 10, 1))).collect()] == [1]
    assert scope(df, ("ge", "t", dt.datetime(2022, 10, 1))).count() == 2
    assert scope(df, ("gt", "t", dt.date(2022, 10, 1))).count() == 1


def test_sla_flag_both_forms(spark):
    df = spark.createDataFrame([
        ("Abated", dt.datetime(2024, 1, 15, 18, 0), dt.date(2024, 1, 15)),
        ("Abated", None, dt.date(2024, 1, 15)),
        ("Pending", dt.datetime(2024, 1, 1), dt.date(2024, 1, 15)),
    ], "st string, done timestamp_ntz, due date")
    got = [r.f for r in df.select(sla_flag("done", "due", "st", ["Abated"]).alias("f")).collect()]
    assert got == [1, 0, 0]
    df2 = spark.createDataFrame([(dt.datetime(2024, 1, 15, 9, 0), dt.date(2024, 1, 15)),
                                 (dt.datetime(2024, 1, 15, 0, 0), dt.date(2024, 1, 15))],
                                "done timestamp_ntz, due date")
    got2 = [r.f for r in df2.select(sla_flag("done", "due", as_date=False).alias("f")).collect()]
    assert got2 == [0, 1]


def test_threshold_flag(spark):
    df = spark.createDataFrame([(2,), (3,), (None,)], "c int")
    assert [r.f for r in df.select(threshold_flag("c", 2).alias("f")).collect()] == [1, 0, 0]


def test_prefix_flag_and_negated_filter(spark):
    df = spark.createDataFrame([("No Access - x",), ("Passed",), (None,)], "s string")
    assert [r.f for r in df.select(prefix_flag("s", "NO ACCESS").alias("f")).collect()] == [1, 0, 0]
    assert [r.f for r in df.select(prefix_flag("s", "NO ACCESS", ignore_case=False).alias("f")).collect()] == [0, 0, 0]
    kept = df.filter(prefix_match("s", "NO ACCESS", negate=True)).collect()
    assert [r.s for r in kept] == ["Passed"]                     # NULL status dropped too
    pct = spark.createDataFrame([("50%off",), ("50 off",)], "s string")
    assert pct.filter(prefix_match("s", "50%")).count() == 1     # % is literal


def test_relabel(spark):
    df = spark.createDataFrame([("Class 3",), ("Class 4",), ("Class 9",)], "c string")
    got = [r.x for r in df.select(relabel("c", {"Class 3": "Buildings", "Class 4": "Blighted"}).alias("x")).collect()]
    assert got == ["Buildings", "Blighted", None]
    merge = {"Follow Up Inspection": "Follow-Up Inspection", "Follow-Up Inspection": "Follow-Up Inspection"}
    df2 = spark.createDataFrame([("Follow Up Inspection",), ("Initial",), (None,)], "c string")
    assert [r.x for r in df2.select(relabel("c", merge, keep_other=True).alias("x")).collect()] == \
        ["Follow-Up Inspection", "Initial", None]


def test_segments_and_transition(spark):
    df = spark.createDataFrame([("A-C", "New Building Permit"), ("R-3", "New Building Permit"),
                                ("A-C", "Fence Permit")], "jc string, pt string")
    seg = Segment("LCC", {"jc": ("A-C", "V-C"), "pt": ("New Building Permit",)})
    out = segment(df, seg, label_col="Sub_Section").collect()
    assert [(r.jc, r.Sub_Section) for r in out] == [("A-C", "LCC")]
    only_pt = Segment("DC", {"pt": ("New Building Permit",)})
    assert segment(df, only_pt).count() == 2
    t = spark.createDataFrame([("Class 3", "Class 1", "Success"), ("Class 3", "Class 3", "Success"),
                               ("Class 4", "Class 2", "Failed")], "f string, t string, u string")
    assert transition_scope(t, "f", "t", ["Class 3", "Class 4"], ["Class 1", "Class 2"],
                            extra=[("eq", "u", "Success")]).count() == 1


def test_scope_pushes_filters_to_scan(spark):
    from tests.conftest import SF0001

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = spark.read.parquet(f"{SF0001}/orders.parquet")
    plan = scope(df, ("gt", "o_orderdate", dt.datetime(1996, 10, 1)), ("eq", "o_orderstatus", "F")) \
        .select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1996-10-01T00:00)" in plan and "EqualTo(o_orderstatus,F)" in plan
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["o_orderdate", "o_orderkey", "o_orderstatus"]
    assert F is not None


def test_sql_text_conditions_match_column_conditions(spark):
    from kpimart.operators.scope import Segment, predicate, predicate_sql, segment_sql

    df = spark.createDataFrame(
        [("a", 1, dt.datetime(2022, 10, 1)), ("it's", 2, dt.datetime(2022, 10, 1, 0, 0, 1)),
         ("back\\slash", None, None), (None, 3, dt.datetime(2023, 1, 1))],
        "s string, n int, t timestamp_ntz")
    conds = [("in", "s", ["a", "it's", "back\\slash"]), ("not_in", "s", ["a"]), ("not_in_or_null", "s", ["a"]),
             ("eq", "s", "it's"), ("eq", "n", 2), ("not_null", "n"), ("gt", "t", dt.datetime(2022, 10, 1)),
             ("ge", "t", dt.datetime(2022, 10, 1)), ("gt", "t", dt.date(2022, 10, 1))]
    for c in conds:
        by_col = sorted(map(str, df.filter(predicate(c)).collect()))
        by_sql = sorted(map(str, df.filter(F.expr(predicate_sql(c))).collect()))
        assert by_col == by_sql, c
    seg = Segment("x", {"s": ("a", "it's"), "n": (1, 2)})
    assert df.filter(seg.predicate()).count() == df.filter(F.expr(segment_sql(seg))).count() == 2
