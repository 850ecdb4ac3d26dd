"""One commit over several marts."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from kpimart.plans import TEST_PARAMS, Inputs, refresh_all
from kpimart.plans.registry import TIE
from kpimart.plans.schemas import REQUIRED, calendar_schema, inspections_schema, permits_schema, violations_schema
from kpimart.sources import expire_runs, read_manifest, read_mart, read_marts, write_mart
from kpimart.sources.manifest import commit_runs
from tests.conftest import rows
from tests.test_sink import COLS, ROW

SCHEMAS = {"calendar": calendar_schema(), "violations": violations_schema(), "permits": permits_schema(),
           "inspections": inspections_schema()}


def test_a_failing_mart_leaves_all_marts_at_the_old_as_of(spark, inputs_small, tmp_path):
    folder = str(tmp_path)
    refresh_all(inputs_small, TEST_PARAMS, folder, tie=TIE)
    before = {n: rows(df) for n, df in read_marts(spark, folder, SCHEMAS).items()}
    runs = {n: set(os.listdir(f"{folder}/{n}/runs")) for n in SCHEMAS}

    late = TEST_PARAMS.with_(as_of=TEST_PARAMS.as_of + dt.timedelta(days=40))
    broken = Inputs({**inputs_small.tables, "inspections": inputs_small["inspections"].withColumn(
        "grp", F.raise_error(F.lit("broken source")).cast("string"))}, inputs_small.calendar, inputs_small.cal_rows)
    for parallel in (True, False):
        with pytest.raises(Exception, match="broken source"):
            refresh_all(broken, late, folder, tie=TIE, parallel=parallel)
    assert read_manifest(spark, folder).number == 1
    assert {n: rows(df) for n, df in read_marts(spark, folder, SCHEMAS).items()} == before
    # the other marts' new runs are gone
    assert all({r for r in os.listdir(f"{folder}/{n}/runs") if os.path.exists(f"{folder}/{n}/runs/{r}/_SUCCESS")} == runs[n] for n in SCHEMAS)

    refresh_all(inputs_small, late, folder, tie=TIE)
    now = read_marts(spark, folder, SCHEMAS)
    assert {df.select("Load_Date").distinct().count() for df in now.values()} == {1}
    assert {df.first()["Load_Date"] for df in now.values()} == {late.as_of}
    old = read_marts(spark, folder, SCHEMAS, number=1)
    assert {n: rows(df) for n, df in old.items()} == before


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    folder = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: commit_runs(spark, folder, {f"m{i % 4}": {"run": f"r{i}", "rows": i}}), range(24)))
    assert sorted(m.number for m in got) == list(range(1, 25))
    last = read_manifest(spark, folder)
    assert last.number == 24 and set(last.marts) == {"m0", "m1", "m2", "m3"}
    # each manifest is the one before it and its own run
    by_number = {m.number: m for m in got}
    for n in range(2, 25):
        assert len({(k, v["run"]) for k, v in by_number[n].marts.items()}
                   - {(k, v["run"]) for k, v in by_number[n - 1].marts.items()}) == 1
    assert not [n for n in os.listdir(f"{folder}/manifests") if "draft" in n and not n.endswith(".crc")]


def test_two_refreshes_at_once_and_the_later_is_read(spark, tmp_path):
    target = f"{tmp_path}/permits"
    one = spark.createDataFrame([ROW], COLS)
    two = one.union(one)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda df: write_mart(df, permits_schema(), target, REQUIRED), [one, two]))
    last = read_manifest(spark, str(tmp_path))
    assert last.number == 2
    assert read_mart(spark, target, permits_schema()).count() == last.marts["permits"]["rows"]
    assert {read_marts(spark, str(tmp_path), {"permits": permits_schema()}, n)["permits"].count() for n in (1, 2)} == {1, 2}


def test_expired_runs_go_and_what_is_named_stays(spark, tmp_path):
    folder, target = str(tmp_path), f"{tmp_path}/permits"
    df = spark.createDataFrame([ROW], COLS)
    for _ in range(4):
        write_mart(df, permits_schema(), target, REQUIRED)
    write_mart(df, permits_schema(), f"{folder}/other", REQUIRED)     # manifests of both marts
    os.makedirs(f"{target}/runs/being-written")
    named = {n: read_manifest(spark, folder, n).marts["permits"]["run"] for n in range(1, 5)}
    gone = expire_runs(spark, folder, keep=2)
    assert gone == sorted(f"permits/{named[n]}" for n in (1, 2, 3))
    assert set(os.listdir(f"{target}/runs")) >= {named[4], "being-written"}
    assert read_mart(spark, target, permits_schema()).count() == 1 and read_manifest(spark, folder).number == 5
    with pytest.raises(ValueError, match="no manifest 1"):
        read_marts(spark, folder, {"permits": permits_schema()}, number=1)
    assert expire_runs(spark, folder, keep=2, older_than=dt.timedelta(0)) == ["permits/being-written"]
    write_mart(df, permits_schema(), target, REQUIRED)
    assert read_manifest(spark, folder).number == 6                   # numbers go on
    with pytest.raises(ValueError, match="current"):
        expire_runs(spark, folder, keep=0)


def test_reading_marts_before_any_refresh(spark, tmp_path):
    with pytest.raises(ValueError, match="no refresh of permits"):
        read_marts(spark, str(tmp_path), {"permits": permits_schema()})
    assert read_manifest(spark, str(tmp_path)).number == 0
    assert expire_runs(spark, str(tmp_path)) == []
