"""Marts end to end: plain vs one-pass, oracle SQL agreement, plan properties."""

import duckdb
import pytest

import __spark_entry__ as entry
from kpimart.plans import TEST_PARAMS, build
from kpimart.plans.registry import QUERIES, TIE
from oracle import ORACLE_SQL
from tests.conftest import SF0001, rows

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["violations", "permits", "inspections"])
def test_onepass_equals_plain(spark, inputs_small, name):
    a = build(name, inputs_small, TEST_PARAMS, "onepass", TIE)
    b = build(name, inputs_small, TEST_PARAMS, "plain", TIE)
    assert a.schema == b.schema
    assert rows(a) == rows(b)


def _canon(values):
    out = []
    for r in values:
        out.append(tuple("NULL" if v is None else (f"{float(v):.4f}" if hasattr(v, "as_tuple") else str(v))
                         for v in r))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle_sql(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    cols = sorted(df.columns)
    got = _canon(tuple(r[c] for c in cols) for r in df.collect())
    res = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = _canon(tuple(r[i] for i in idx) for r in res.fetchall())
    assert got == want


def test_registry_and_oracle_cover_each_other():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["Load_Date", "Month_EndDate_Key"] and df.count() > 0


@pytest.mark.parametrize("name", ["violations", "permits", "inspections"])
def test_no_python_udf_in_plans(spark, inputs_small, name):
    plan = build(name, inputs_small, TEST_PARAMS, "onepass", TIE)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_calendar_join_is_broadcast(spark, inputs_small):
    from kpimart.plans.violations import stage_violations

    plan = stage_violations(inputs_small, TEST_PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "BroadcastHashJoin" in plan


def test_permits_onepass_scans_each_source_once_per_mart(spark, inputs_small):
    plan = build("permits", inputs_small, TEST_PARAMS, "onepass", TIE)._jdf.queryExecution().executedPlan().toString()
    plain = build("permits", inputs_small, TEST_PARAMS, "plain", TIE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") < plain.count("FileScan")


def test_refresh_all_writes_four_marts(spark, inputs_small):
    import tempfile

    from kpimart.plans import refresh_all

    target = tempfile.mkdtemp(prefix="kpimart-refresh-")
    out = refresh_all(inputs_small, TEST_PARAMS, target, "onepass", TIE, partition_by={"permits": ["Section"]})
    assert set(out) == {"calendar", "violations", "permits", "inspections"}
    counts = {name: df.count() for name, df in out.items()}
    for name, n in counts.items():
        assert n == build(name, inputs_small, TEST_PARAMS, "onepass", TIE).count() > 0
    again = refresh_all(inputs_small, TEST_PARAMS, target, "onepass", TIE)
    assert {name: df.count() for name, df in again.items()} == counts   # replaced, not appended


def test_permits_union_distinct_equals_union_all(spark, inputs_small):
    from dataclasses import replace

    from kpimart.plans import build_mart, permits
    from kpimart.plans.mart import labels_disjoint
    from kpimart.plans.refresh import mart_bases

    assert labels_disjoint(permits.MART.measures)
    bases = mart_bases("permits", inputs_small, TEST_PARAMS, "plain", TIE)
    distinct = build_mart(permits.MART, bases, TEST_PARAMS.as_of, TEST_PARAMS.value_type, "plain")
    union_all = build_mart(replace(permits.MART, distinct=False), bases, TEST_PARAMS.as_of,
                           TEST_PARAMS.value_type, "plain")
    assert rows(distinct) == rows(union_all)


def test_checkpointed_histograms_give_same_mart(spark, inputs_small):
    params = TEST_PARAMS.with_(checkpoint_histograms=True)
    a = build("permits", inputs_small, params, "onepass", TIE)
    assert "LogicalRDD" in a._jdf.queryExecution().logical().toString()     # lineage cut at the histogram
    assert rows(a) == rows(build("permits", inputs_small, TEST_PARAMS, "onepass", TIE))


def test_refresh_all_parallel_equals_sequential(spark, inputs_small):
    import tempfile

    from kpimart.plans import refresh_all

    par = refresh_all(inputs_small, TEST_PARAMS, tempfile.mkdtemp(prefix="kpimart-par-"), "onepass", TIE)
    seq = refresh_all(inputs_small, TEST_PARAMS, tempfile.mkdtemp(prefix="kpimart-seq-"), "onepass", TIE,
                      parallel=False)
    for name in par:
        assert rows(par[name]) == rows(seq[name]), name


def test_latest_notice_filter_on(spark, inputs_small):
    params = TEST_PARAMS.with_(keep_latest_notice=True)
    on = build("violations", inputs_small, params, "onepass", TIE)
    off = build("violations", inputs_small, TEST_PARAMS, "onepass", TIE)
    assert rows(on) == rows(build("violations", inputs_small, params, "plain", TIE))
    vac = "Measure_Type = 'Vacant Properties Returned to Productive Use'"
    assert 0 < on.filter(vac).agg({"Measure_Values": "sum"}).first()[0] <= \
        off.filter(vac).agg({"Measure_Values": "sum"}).first()[0]
