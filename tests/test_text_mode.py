"""Whole marts over sources of a case-insensitive system."""

from pyspark.sql import functions as F

from kpimart.plans import TEST_PARAMS, Inputs, build
from kpimart.plans import params as P
from kpimart.plans.registry import TIE, rough
from kpimart.plans.text import LISTED, SHOWN, fold_source, folded, usual_spellings
from kpimart.sources.schemas import SOURCES
from tests.conftest import rows

MODE = TEST_PARAMS.with_(ignore_case=True)


def test_marts_of_other_spellings_equal_the_clean_ones(spark, inputs_small):
    for name in ("violations", "permits"):
        clean = rows(build(name, inputs_small, TEST_PARAMS, "onepass", TIE))
        other = rough(inputs_small)
        assert rows(build(name, other, MODE, "onepass", TIE)) == clean
        assert rows(build(name, other, TEST_PARAMS, "onepass", TIE)) != clean
    plain = build("violations", rough(inputs_small), MODE, "plain", TIE)
    assert rows(plain) == rows(build("violations", inputs_small, TEST_PARAMS, "plain", TIE))


def test_text_keys_join_and_group_without_case(spark):
    address = spark.createDataFrame([("C1 ", "a1", "WARD 1"), ("c2", "A1", "Ward 1  "), ("C3", "a2", "Ward 1"), ("c4", "a3", None)],
                                    "b1_alt_id string, address_id string, ward string")
    violations = spark.createDataFrame(
        [(c, "HOUSING ", "emergency", "Served", s, "ABATED", None, None) for c, s in (("c1", "open"), ("C2  ", None), ("c3", "CANCELLED "), ("C4", "Open"))],
        SOURCES["violations"].simpleString()[7:-1].replace("cap_id:bigint", "cap_id:string"))
    got = folded(Inputs({"address": address, "violations": violations}, spark.range(0), None))
    assert sorted(map(tuple, got["address"].collect()), key=str) == [
        ("c1", "a1", "Ward 1"), ("c2", "a1", "Ward 1"), ("c3", "a2", "Ward 1"), ("c4", "a3", None)]
    v = {r.cap_id: r for r in got["violations"].collect()}
    assert v.keys() == {"c1", "c2", "c3", "c4"}
    assert (v["c1"].grp, v["c1"].response_level, v["c1"].abatement_status) == ("Housing", "Emergency", "Abated")
    assert (v["c1"].cap_status, v["c2"].cap_status, v["c3"].cap_status) == ("open", None, "Cancelled")


def test_usual_spelling_is_the_most_frequent_then_the_first(spark):
    df = spark.createDataFrame([(x,) for x in ("b", "B", "B ", "a", "A", None, "", " ")], "w string")
    assert {(r["__key"], r["__usual"]) for r in usual_spellings(df, "w").collect()} == {("b", "B"), ("a", "A"), ("", "")}


def test_other_columns_and_names_stay(spark, inputs_small):
    src = inputs_small["class_notice"].withColumn("note", F.lit("Kept As It Is "))
    out = fold_source("class_notice", src)
    assert out.columns == src.columns and out.select("note").distinct().collect()[0].note == "Kept As It Is "


def test_lists_have_one_spelling_a_value():
    for columns in LISTED.values():
        for values in columns.values():
            assert len({v.lower() for v in values}) == len(set(values))
    assert all(set(cols) <= set(SOURCES[n].fieldNames()) for n, cols in SHOWN.items())
    assert P.NO_ACCESS_PREFIX.lower() not in P.CANCELLED_CASE_STATUSES
