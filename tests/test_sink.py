"""Mart sink (O02) and staging."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kpimart.plans.schemas import REQUIRED, permits_schema
from kpimart.sources import read_mart, read_source, stage, staged, unstage, write_mart

ROW = (dt.datetime(2001, 8, 15), dt.date(2001, 7, 31), "S", "Sub", "A-C", "P", "M", 3, 0)
COLS = "Load_Date timestamp_ntz, Month_EndDate_Key date, Section string, Sub_Section string, Job_Class string, " \
       "Permit_Types string, Measure_Type string, Measure_Values long, Denominator long"


def _target():
    return os.path.join(tempfile.mkdtemp(prefix="kpimart-sink-"), "permits")


def test_write_orders_by_name_casts_and_replaces(spark):
    target = _target()
    df = spark.createDataFrame([ROW], COLS).select("Measure_Values", "Denominator", *[c.split()[0] for c in
                                                   COLS.split(", ")][:7])   # shuffled column order
    out = write_mart(df, permits_schema(), target, REQUIRED)
    assert out.columns == permits_schema().fieldNames()
    assert str(out.schema["Measure_Values"].dataType) == "DecimalType(9,2)"
    again = write_mart(df.union(df), permits_schema(), target, REQUIRED)
    assert again.count() == 2                      # replaced, not appended to the first run


def test_null_key_raises_and_keeps_previous(spark):
    target = _target()
    good = spark.createDataFrame([ROW], COLS)
    write_mart(good, permits_schema(), target, REQUIRED)
    bad = good.withColumn("Month_EndDate_Key", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="NULL in required column Month_EndDate_Key"):
        write_mart(bad, permits_schema(), target, REQUIRED)
    assert read_mart(spark, target, permits_schema()).count() == 1


def test_overflow_raises(spark):
    big = spark.createDataFrame([ROW], COLS).withColumn("Measure_Values", F.lit(99999999))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        write_mart(big, permits_schema(), _target(), REQUIRED)


def test_read_source_checks_and_prunes(spark):
    from tests.conftest import SF0001

    path = f"{SF0001}/orders.parquet"
    df = read_source(spark, path, {"o_orderkey": "cap_id", "O_ORDERDATE": "issued_date"})
    assert df.columns == ["cap_id", "issued_date"]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in \
        df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="missing columns"):
        read_source(spark, path, ["no_such_column"])


def test_stage_modes(spark):
    df = spark.range(100)
    s = stage(df, "kpimart_stage_test")
    assert spark.table("kpimart_stage_test").count() == 100
    unstage(s, "kpimart_stage_test")
    c = stage(df, None, mode="checkpoint")
    assert c.count() == 100
    assert "LogicalRDD" in c._jdf.queryExecution().logical().toString()


def test_read_source_from_table_name(spark):
    spark.range(5).withColumn("Ward", F.lit("W1")).createOrReplaceTempView("kpimart_src_view")
    df = read_source(spark, "kpimart_src_view", {"ID": "case_id", "ward": "ward"})
    assert df.columns == ["case_id", "ward"] and df.count() == 5
    with pytest.raises(ValueError, match="missing columns"):
        read_source(spark, "kpimart_src_view", ["nope"])


def test_failed_write_keeps_the_old_rows(spark):
    target = _target()
    good = spark.createDataFrame([ROW], COLS)
    write_mart(good, permits_schema(), target, REQUIRED, ("Section",))
    # rows pass validation; no file system takes a folder name this long
    long = good.withColumn("Section", F.lit("x" * 5000))
    with pytest.raises(Exception):  # noqa: B017
        write_mart(long, permits_schema(), target, REQUIRED, ("Section",))
    assert [r.Section for r in read_mart(spark, target, permits_schema()).collect()] == ["S"]


def test_partitioned_round_trip_keeps_sentinel_null_and_order(spark):
    target = _target()
    rows = [ROW[:5] + (v,) + ROW[6:] for v in ("", None, "a/b=c", "null", "empty", " ")]
    write_mart(spark.createDataFrame(rows, COLS), permits_schema(), target, REQUIRED, ("Permit_Types",))
    back = read_mart(spark, target, permits_schema())
    assert back.columns == permits_schema().fieldNames()
    assert sorted(str(r.Permit_Types) for r in back.collect()) == sorted(["", "None", "a/b=c", "null", "empty", " "])


def test_first_refresh_of_a_table_and_the_next(spark):
    name = "kpimart_sink_table"
    good = spark.createDataFrame([ROW], COLS)
    write_mart(good, permits_schema(), name, REQUIRED, ("Section",))
    write_mart(good.union(good), permits_schema(), name, REQUIRED)
    assert read_mart(spark, name, permits_schema()).count() == 2
    assert spark.table(name).columns == permits_schema().fieldNames()


def test_reading_before_any_refresh(spark):
    with pytest.raises(ValueError, match="no refresh"):
        read_mart(spark, _target(), permits_schema())


def test_staging_leaves_no_cache_behind(spark):
    from kpimart.plans.registry import QUERIES
    from tests.conftest import SF0001

    def cached():
        return "InMemoryTableScan" in QUERIES["stage_violations"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()

    QUERIES["op_stage"](spark, SF0001).count()
    assert not cached()
    with staged(QUERIES["stage_violations"](spark, SF0001), "kpimart_staged_view") as df:
        df.count()
        assert cached()
    assert not cached() and not spark.catalog.tableExists("kpimart_staged_view")


def test_bounds_reach_the_scan(spark):
    from kpimart.operators import scope
    from tests.conftest import SF0001

    o = read_source(spark, f"{SF0001}/orders.parquet", {"o_orderkey": "cap_id", "o_orderdate": "issued_date"})
    plan = scope(o, ("gt", "issued_date", dt.datetime(1996, 10, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1996-10-01T00:00)" in plan


def test_shared_folder_has_to_be_named_off_local_masters(monkeypatch):
    from types import SimpleNamespace

    from kpimart.session import ensure_checkpoint_dir

    fake = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(
        master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)
