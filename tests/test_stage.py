"""Bucketed staging tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

from kpimart.plans import TEST_PARAMS, build, refresh_all
from kpimart.plans.inputs import CASE_KEYS, staged_by_case
from kpimart.plans.registry import TIE
from kpimart.sources import staged
from tests.conftest import rows


def warehouse(spark):
    place = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    return {n for n in (os.listdir(place) if os.path.isdir(place) else []) if n.startswith("kpimart_stage_")}


def exchanges(df, column):
    """Hash shuffles on a column in a plan that does not adapt."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"Exchange hashpartitioning\({column}#", plan))


@pytest.fixture
def static_plans(spark):
    """No broadcast joins and no adaptive plans: shuffles show as they would at scale."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_grouping_and_joining_by_the_key_does_not_shuffle(spark, static_plans):
    df = spark.range(2000).select((F.col("id") % 97).alias("case"), "id", F.lit("x").alias("unused"))
    with staged(df, "kpimart_bucketed", "bucketed", by=["case"], columns=["case", "id"], buckets=4) as one, \
            staged(df, mode="bucketed", by=["case"], buckets=4) as two:
        assert one.columns == ["case", "id"] and spark.table("kpimart_bucketed").count() == 2000 and len(warehouse(spark)) == 2
        grouped = one.groupBy("case").agg(F.count("*").alias("n"))
        joined = grouped.join(two.groupBy(F.col("case").alias("k")).agg(F.max("id").alias("m")), F.col("case") == F.col("k"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows(joined) == rows(df.groupBy("case").agg(F.count("*").alias("n"), F.col("case").alias("k"), F.max("id").alias("m")))
    assert not warehouse(spark) and not spark.catalog.tableExists("kpimart_bucketed")
    with pytest.raises(ValueError, match="dealt by"):
        with staged(df, mode="bucketed"):
            pass


def test_marts_over_staged_cases_do_not_shuffle_them(spark, inputs_small, static_plans):
    plain = build("violations", inputs_small, TEST_PARAMS, "onepass", TIE)
    shuffles = plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    with staged_by_case(inputs_small, {"inspections": TIE["inspections"]}, buckets=4) as held:
        assert len(warehouse(spark)) == len(CASE_KEYS)
        mart = build("violations", held, TEST_PARAMS, "onepass", TIE)
        assert "Bucketed: true" in mart._jdf.queryExecution().executedPlan().toString()
        assert exchanges(mart, "cap_id") == exchanges(mart, "b1_alt_id") == 0
        assert mart._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") < shuffles
        assert rows(mart) == rows(plain)
        first = build("inspections", held, TEST_PARAMS, "onepass", TIE)
        assert exchanges(first, "CAP_ID") == exchanges(first, "cap_id") == 0
        assert rows(first) == rows(build("inspections", inputs_small, TEST_PARAMS, "onepass", TIE))
    assert not warehouse(spark)


def test_a_staged_refresh_leaves_nothing_behind(spark, inputs_small, tmp_path):
    got = refresh_all(inputs_small, TEST_PARAMS, str(tmp_path), tie=TIE, stage_by_case=True)
    assert not warehouse(spark)
    for name in ("violations", "inspections"):
        assert rows(got[name]) == rows(build(name, inputs_small, TEST_PARAMS, "onepass", TIE))
