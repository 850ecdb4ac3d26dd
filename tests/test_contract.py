"""Type contract of the sources."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kpimart.plans import TEST_PARAMS, load_inputs
from kpimart.sources.schemas import SOURCES, as_declared

PERMITS = "cap_id string, issued_date date, permit_type string, job_class int, permit_types string, review_cycles {0}, business_days {1}"


def permits(spark, rows, cycles="int", days="bigint"):
    full = [("c1", dt.date(2024, 2, 29), "Construction", 3, "New", a, b) for a, b in rows]
    return spark.createDataFrame(full, PERMITS.format(cycles, days))


def test_widening_types_are_taken(spark):
    out = as_declared("permits", permits(spark, [(2, 40), (None, None)]))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string"] + [f.dataType.simpleString() for f in SOURCES["permits"].fields][1:]
    first = out.collect()[0]
    assert (first.issued_date, first.job_class, first.review_cycles, first.business_days) == (dt.datetime(2024, 2, 29), "3", 2, 40)


@pytest.mark.parametrize("cycles,days,rows,said", [
    ("string", "bigint", [("2", 1)], "review_cycles holds string, declared is bigint"),
    ("double", "bigint", [(2.0, 1)], "review_cycles holds double, declared is bigint"),
    ("int", "decimal(9,2)", [(2, None)], r"business_days holds decimal\(9,2\), declared is bigint"),
    ("timestamp", "bigint", [(dt.datetime(2024, 1, 1), 1)], "review_cycles holds timestamp")])
def test_narrowing_and_text_for_numbers_are_refused_before_a_job(spark, cycles, days, rows, said):
    df = permits(spark, rows, cycles, days).withColumn("permit_types", F.raise_error(F.lit("a job ran")).cast("string"))
    with pytest.raises(TypeError, match=said):
        as_declared("permits", df)


def test_text_for_a_time_is_refused_and_keys_keep_their_type(spark):
    with pytest.raises(TypeError, match="issued_date holds string, declared is timestamp_ntz"):
        as_declared("permits", permits(spark, [(1, 1)]).withColumn("issued_date", F.lit("2024-01-01")))
    assert as_declared("cap_apo", spark.createDataFrame([(1.5,)], "b1_alt_id double")).first()[0] == 1.5


def test_parsed_columns_leave_out_and_count_rows_without_an_exact_value(spark):
    rows = [("2", 40.0), (" 3 ", 41.0), ("x", 42.0), ("4", 42.5), (None, None), ("", 1e30), ("5", float("nan"))]
    seen = Observation()
    df = permits(spark, rows, "string", "double")
    out = as_declared("permits", df, ("review_cycles", "business_days"), seen)
    assert sorted(((r.review_cycles, r.business_days) for r in out.collect()), key=str) == [(2, 40), (3, 41), (None, None)]
    assert seen.get == {"rows": 4, "bad_review_cycles": 2, "bad_business_days": 3}
    with pytest.raises(ValueError, match="need no parsing"):
        as_declared("permits", permits(spark, [(1, 1)]), ("review_cycles",))


def test_loader_refuses_or_counts(spark, tmp_path, inputs_small):
    path = str(tmp_path / "permits")
    rough = inputs_small["permits"].limit(20).withColumn("business_days", F.when(F.col("business_days") % 2 == 0, "n/a").otherwise("7"))
    rough.write.parquet(path)
    place = {"permits": path, "violations": str(tmp_path / "violations")}
    inputs_small["violations"].limit(5).write.parquet(place["violations"])
    with pytest.raises(TypeError, match="permits: business_days holds string"):
        load_inputs(spark, place, params=TEST_PARAMS)
    got = load_inputs(spark, place, params=TEST_PARAMS, parse={"permits": ["business_days"]})
    kept = got["permits"].collect()
    bad = rough.filter("business_days = 'n/a'").count()
    assert len(kept) == 20 - bad and got.rejects["permits"].get["rows"] == bad > 0
