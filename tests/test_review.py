"""Cases a review asked for: calendar gaps, weights, exact percentiles, ranks, text mode, loaders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpimart.operators import (
    add_business_days,
    business_day_calendar,
    calendar_of,
    enrich,
    enrich_weighted,
    fiscal_calendar,
    latest_flag,
    month_end_calendar,
    percentile_carry,
    percentile_measure,
    row_rank,
    scope,
    segment,
)
from kpimart.operators.scope import Segment, predicate, predicate_sql
from kpimart.functions import relabel
from kpimart.plans import TEST_PARAMS, build
from kpimart.plans.inputs import Inputs, Lazy, load_inputs, test_inputs as adapter_inputs
from kpimart.sources.schemas import SOURCES
from tests.conftest import SF0001, rows


def test_calendar_reaches_as_of(spark):
    params = TEST_PARAMS.with_(as_of=dt.datetime(2025, 1, 15))
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    cal = calendar_of(orders, "o_orderdate", params.calendar_start, params.as_of.date())
    got = month_end_calendar(cal, params.as_of, params.calendar_start).collect()
    assert len(got) == 12 * 28 + 4 and sum(r.Indicator_Latest_Month for r in got) == 1
    plan = cal._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" in plan


@pytest.mark.parametrize("missing", ["2020-01-31", "2020-06-30", "2020-12-31"])
def test_a_missing_month_raises(spark, missing):
    cal = fiscal_calendar(spark, dt.date(2020, 1, 1), dt.date(2020, 12, 31)).filter(F.col("pkdate") != missing)
    with pytest.raises(Exception, match="misses a month"):
        month_end_calendar(cal, dt.datetime(2020, 12, 5), dt.date(2020, 1, 1)).collect()


def test_calendar_without_facts(spark):
    none = spark.createDataFrame([], "d date")
    cal = calendar_of(none, "d", dt.date(2020, 10, 1), dt.date(2021, 3, 1))
    assert cal.agg(F.min("pkdate"), F.max("pkdate")).first() == (dt.date(2019, 10, 1), dt.date(2022, 9, 30))


def test_holidays_off_the_calendar_raise(spark):
    bd = business_day_calendar(fiscal_calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    ok = spark.createDataFrame([(dt.date(2024, 1, 5),), (None,)], "d date")
    assert {r.t for r in add_business_days(ok, "d", 3, "t", bd).collect()} == {dt.date(2024, 1, 10), None}
    for day in (dt.date(2023, 12, 29), dt.date(2024, 1, 30), dt.date(2024, 3, 1)):
        with pytest.raises(Exception, match="no calendar day"):
            add_business_days(spark.createDataFrame([(day,)], "d date"), "d", 3, "t", bd).collect()


def test_holidays_reach_the_inspections(spark, inputs_small):
    from kpimart.plans.inspections import stage_inspections

    # the first and last bound the calendar; the Mondays between are off
    days = (dt.date(2000, 1, 3), *(dt.date(2024, 1, 1) + dt.timedelta(7 * k) for k in range(60)), dt.date(2030, 1, 2))
    met = lambda p: stage_inspections(inputs_small, p).agg(F.sum("SLA_MET"), F.count("*")).first()
    plain, off = met(TEST_PARAMS), met(TEST_PARAMS.with_(holidays=days))
    assert off[0] > plain[0] and off[1] == plain[1]
    mart = build("inspections", inputs_small, TEST_PARAMS.with_(holidays=days), "onepass", {"inspections": ("event_id",)})
    assert mart.count() > 0


def test_weights_equal_rows_with_a_case_hot_on_both_sides(spark, inputs_small):
    v, a = inputs_small["violations"], inputs_small["address"]
    hot = v.select("cap_id").first()[0]
    v = v.withColumn("cap_id", F.when(F.pmod(F.hash("cap_id", "service_date"), F.lit(3)) == 0, F.lit(hot)).otherwise(F.col("cap_id")))
    a = a.unionByName(a.limit(300).withColumn("b1_alt_id", F.lit(hot).cast("long")))
    owners = inputs_small["owner_points"]
    tables = {**inputs_small.tables, "violations": v, "address": a, "owner_points": owners.unionByName(owners)}
    inputs = Inputs(tables, inputs_small.calendar)
    tie = {"class_notice": ("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")}
    assert rows(build("violations", inputs, TEST_PARAMS, "onepass", tie)) == rows(build("violations", inputs, TEST_PARAMS, "plain", tie))
    left = v.select("cap_id")
    assert enrich_weighted(left, a, {"cap_id": "b1_alt_id"}, ["ward"]).agg(F.sum("_w")).first()[0] == \
        enrich(left, a, {"cap_id": "b1_alt_id"}, ["ward"]).count()


@pytest.mark.parametrize("p,want", [(0.07, 7), (0.55, 55), (0.9, 90), (1.0, 100), (0.001, 1)])
def test_percentiles_are_exact(spark, p, want):
    df = spark.range(1, 101).select(F.lit("g").alias("g"), F.lit("c").alias("c"), F.col("id").alias("x"), F.lit(3).alias("w"))
    labels = {"Section": "s"}
    smallest = df.select("x", F.cume_dist().over(__import__("pyspark").sql.Window.orderBy("x")).alias("share")).filter(
        F.round("share", 6) >= p).agg(F.min("x")).first()[0]
    assert smallest == want
    for weight in (None, "w"):
        assert percentile_measure(df, ["g"], labels, "x", p, weight).first().Measure_Values == want
        assert percentile_carry(df, ["g"], ["c"], labels, "x", p, weight=weight).first().Measure_Values == want


def test_one_latest_row_with_full_duplicates(spark):
    df = spark.createDataFrame([("k", 2, "a"), ("k", 2, "a"), ("k", 1, "a"), ("m", None, None), ("m", None, None)], "k string, o int, x string")
    for tie in ([], ["x"]):
        got = latest_flag(df, "k", ["o"], tie, "f")
        assert got.groupBy("k").agg(F.sum("f").alias("n")).filter("n != 1").count() == 0 and got.count() == 5
    ranks = sorted((r.k, r.r) for r in row_rank(df, "k", ["o"], ["x"], "r", descending=True).collect())
    assert ranks == [("k", 1), ("k", 2), ("k", 3), ("m", 1), ("m", 2)]


def test_one_first_inspection_without_a_tie_breaker(spark, inputs_small):
    from kpimart.plans.inspections import stage_inspections, with_first_record

    st = stage_inspections(inputs_small, TEST_PARAMS)
    got = with_first_record(st.unionByName(st), ())
    assert got.groupBy("CAP_ID").agg(F.sum("FIRST_RECORD").alias("n")).filter("n != 1").count() == 0


def test_text_without_case_and_trailing_blanks(spark):
    df = spark.createDataFrame([("HOUSING",), ("Housing  ",), ("housing",), (" Housing",), (None,)], "g string")
    assert scope(df, ("in", "g", ["Housing "]), ignore_case=True).count() == 3
    assert scope(df, ("not_in", "g", ["Housing"]), ignore_case=True).count() == 1
    assert scope(df, ("eq", "g", "Housing")).count() == 0
    assert segment(df, Segment("s", {"g": ("HOUSING",)}), ignore_case=True).count() == 3
    assert df.select(relabel("g", {"Housing": "H"}, ignore_case=True).alias("x")).filter("x = 'H'").count() == 3


def test_conditions_have_one_form(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 0, 0, 0, 500_000)), (None, dt.datetime(2020, 1, 1))], "a int, t timestamp_ntz")
    half = dt.datetime(2020, 1, 1, 0, 0, 0, 500_000)
    assert scope(df, ("gt", "t", half)).count() == 0 and scope(df, ("ge", "t", half)).count() == 1
    for spec, n in ((("in", "a", []), 0), (("not_in", "a", []), 2), (("in", "a", [1]), 1), (("not_in_or_null", "a", [1]), 1)):
        assert df.filter(predicate(spec)).count() == df.filter(predicate_sql(spec)).count() == n


def test_a_column_condition_is_refused_when_the_measure_is_made():
    from kpimart.plans.mart import MeasureSpec

    with pytest.raises(ValueError, match="conditions are"):
        MeasureSpec("k", "b", "count", {}, ("m",), where=(F.lit(True),))


def test_inputs_are_lazy(spark):
    inputs = adapter_inputs(spark, SF0001)
    assert isinstance(inputs.tables, Lazy) and not inputs.tables.made
    assert set(inputs.tables) == set(SOURCES)
    inputs["permits"]
    assert set(inputs.tables.made) == {"permits"}


def test_load_inputs_checks_columns_before_any_job(spark, tmp_path, inputs_small):
    places = {}
    for name in SOURCES:
        places[name] = str(tmp_path / name)
        inputs_small[name].limit(50).write.parquet(places[name])
    inputs_small["address"].withColumnRenamed("ward", "WARD_NAME").limit(50).write.parquet(str(tmp_path / "renamed"))
    got = load_inputs(spark, {**places, "address": str(tmp_path / "renamed")}, {"address": {"ward": "WARD_NAME"}}, TEST_PARAMS)
    assert got["address"].columns == SOURCES["address"].fieldNames()
    assert build("permits", got, TEST_PARAMS).count() >= 0
    with pytest.raises(ValueError, match="missing columns"):
        load_inputs(spark, {"address": str(tmp_path / "renamed")}, params=TEST_PARAMS)
    with pytest.raises(ValueError, match="unknown sources"):
        load_inputs(spark, {"addresses": "x"})


def test_refresh_takes_marts_of_the_caller(spark, tmp_path, inputs_small):
    from kpimart.plans import refresh_all
    from kpimart.plans.mart import Base, MartSpec, MeasureSpec
    from kpimart.plans.schemas import violations_schema
    from kpimart.sources import read_mart

    mine = MartSpec("mine", violations_schema, (MeasureSpec(
        "all", "b", "count", {"Section": "s", "Sub_Section": "t", "Violation_Type": "u", "Filter_1": "v", "Measure_Type": "m"},
        ("Month_EndDate_Key", "Ward"), denominator=None),), False)
    base = spark.createDataFrame([(dt.date(2001, 7, 31), "W")] * 3, "Month_EndDate_Key date, Ward string")
    tie = {"class_notice": ("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus"), "inspections": ("event_id",)}
    out = refresh_all(inputs_small, TEST_PARAMS, str(tmp_path), tie=tie, extra={"mine": (mine, {"b": Base(base)})})
    assert set(out) == {"calendar", "violations", "permits", "inspections", "mine"}
    assert read_mart(spark, f"{tmp_path}/mine", violations_schema()).first().Measure_Values == 3
