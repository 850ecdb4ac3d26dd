"""Date functions (O05-O09) against hand-written edge rows and brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpimart.functions import add_business_days_expr, business_days_between, month_end, month_start
from kpimart.operators.calendar import (
    add_business_days,
    business_day_calendar,
    calendar_rows,
    fiscal_calendar,
    month_end_calendar,
)

D = dt.date


def _one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols))
    return df.select(expr.alias("x")).first()["x"]


def test_month_keys(spark):
    assert _one(spark, month_start("d"), d=D(2024, 3, 15)) == D(2024, 3, 1)
    assert _one(spark, month_end("d"), d=D(2024, 2, 10)) == D(2024, 2, 29)
    assert _one(spark, month_end("d"), d=dt.datetime(2024, 3, 31, 23, 59)) == D(2024, 3, 31)


def test_month_end_calendar_edges(spark):
    cal = fiscal_calendar(spark, D(2022, 10, 1), D(2026, 9, 30))
    out = month_end_calendar(cal, dt.datetime(2025, 2, 10), D(2023, 1, 1))
    by_key = {r["Month_EndDate_Key"]: r for r in out.collect()}
    assert max(by_key) == D(2025, 2, 28)                        # bounded by EOMONTH(as_of)
    assert by_key[D(2024, 3, 31)]["Month_EndDate_PreviousMonth"] == D(2024, 2, 29)
    assert by_key[D(2025, 2, 28)]["Month_EndDate_PreviousYearMonth"] == D(2024, 2, 29)
    assert by_key[D(2024, 2, 29)]["Month_EndDate_PreviousYearMonth"] == D(2023, 2, 28)
    assert by_key[D(2025, 1, 31)]["Display_Name"] == "J-25"
    assert by_key[D(2024, 10, 31)]["Fiscal_Year"] == 2025 and by_key[D(2024, 10, 31)]["Fiscal_Quarter"] == "Q1"
    assert by_key[D(2024, 9, 30)]["Fiscal_Year"] == 2024 and by_key[D(2024, 9, 30)]["Fiscal_Quarter"] == "Q4"
    latest = [k for k, r in by_key.items() if r["Indicator_Latest_Month"] == 1]
    prev = [k for k, r in by_key.items() if r["Indicator_Previous_Month"] == 1]
    prev_y = [k for k, r in by_key.items() if r["Indicator_Previous_Year_Month"] == 1]
    assert latest == [D(2025, 2, 28)] and prev == [D(2025, 1, 31)] and prev_y == [D(2024, 2, 29)]


def test_fiscal_calendar_size(spark):
    cal = fiscal_calendar(spark, D(2020, 10, 1), D(2021, 9, 30))
    assert cal.count() == calendar_rows(D(2020, 10, 1), D(2021, 9, 30)) == 365


BD_CASES = [
    (D(2024, 1, 5), D(2024, 1, 8), 1),    # Fri -> Mon
    (D(2024, 1, 7), D(2024, 1, 8), 0),    # Sun -> Mon
    (D(2024, 1, 6), D(2024, 1, 8), 0),    # Sat -> Mon
    (D(2024, 1, 6), D(2024, 1, 6), -1),   # Sat -> same Sat
    (D(2024, 1, 6), D(2024, 1, 7), -1),   # Sat -> Sun
    (D(2024, 1, 7), D(2024, 1, 7), -1),   # Sun -> same Sun
    (D(2024, 1, 7), D(2024, 1, 13), 4),   # Sun -> Sat
    (D(2024, 1, 5), D(2024, 1, 6), 0),    # Fri -> Sat
    (D(2024, 1, 5), D(2024, 1, 7), 0),    # Fri -> Sun
    (D(2024, 1, 8), D(2024, 1, 5), -1),   # Mon back to Fri
    (D(2024, 1, 5), D(2024, 1, 1), -4),   # Fri back to Mon
]


def test_business_days_edge_rows(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in BD_CASES], "a date, b date")
    got = [r["x"] for r in df.select(business_days_between("a", "b").alias("x")).collect()]
    assert got == [e for _, _, e in BD_CASES]


def _tsql_bdays(a: dt.date, b: dt.date) -> int:
    # DATEDIFF(dd) - 2 * DATEDIFF(wk) - [a is Sunday] - [b is Saturday]; weeks start on Sunday.
    def sunday(d):
        return d - dt.timedelta(days=(d.weekday() + 1) % 7)
    return ((b - a).days - 2 * ((sunday(b) - sunday(a)).days // 7)
            - (1 if a.weekday() == 6 else 0) - (1 if b.weekday() == 5 else 0))


def test_business_days_brute_force(spark):
    base = D(2023, 12, 25)
    pairs = [(base + dt.timedelta(days=i), base + dt.timedelta(days=j)) for i in range(21) for j in range(-10, 40)]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", business_days_between("a", "b").alias("x")).collect()
    for r in got:
        assert r["x"] == _tsql_bdays(r["a"], r["b"]), (r["a"], r["b"])
        if r["a"].weekday() < 5 and r["b"].weekday() < 5 and r["a"] <= r["b"]:
            weekdays = sum(1 for k in range(1, (r["b"] - r["a"]).days + 1)
                           if (r["a"] + dt.timedelta(days=k)).weekday() < 5)
            assert r["x"] == weekdays


def _nth_weekday_after(d: dt.date, n: int) -> dt.date:
    k = 0
    while n:
        k += 1
        if (d + dt.timedelta(days=k)).weekday() < 5:
            n -= 1
    return d + dt.timedelta(days=k)


def test_add_business_days_edges_and_brute_force(spark):
    assert _one(spark, add_business_days_expr("d", 10), d=D(2024, 1, 1)) == D(2024, 1, 15)
    assert _one(spark, add_business_days_expr("d", 10), d=D(2024, 1, 10)) == D(2024, 1, 24)
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), n) for i in range(14) for n in range(1, 30)]
    df = spark.createDataFrame(rows, "d date, n int")
    got = df.select("d", "n", add_business_days_expr("d", F.col("n")).alias("x")).collect()
    for r in got:
        assert r["x"] == _nth_weekday_after(r["d"], r["n"]), (r["d"], r["n"])


def test_add_business_days_calendar_form_equals_closed_form(spark):
    cal = fiscal_calendar(spark, D(2023, 10, 1), D(2025, 9, 30))
    bd = business_day_calendar(cal)
    starts = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(120)], "d date")
    a = add_business_days(starts, "d", 10, "t_cal", bd, cal_rows=731)
    b = a.withColumn("t_closed", add_business_days_expr("d", 10))
    assert b.filter(~F.col("t_cal").eqNullSafe(F.col("t_closed"))).count() == 0


def test_add_business_days_with_holiday(spark):
    cal = fiscal_calendar(spark, D(2023, 10, 1), D(2024, 9, 30))
    hol = spark.createDataFrame([(D(2024, 1, 15),)], "holiday date")    # a Monday
    bd = business_day_calendar(cal, hol)
    starts = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 12),)], "d date")
    got = dict(add_business_days(starts, "d", 10, "t", bd, cal_rows=366).select("d", "t").collect())
    assert got[D(2024, 1, 1)] == D(2024, 1, 16)     # skips the holiday
    assert got[D(2024, 1, 12)] == D(2024, 1, 29)


def test_span_of_a_date_column_comes_from_footers(spark, tmp_path):
    from kpimart.operators.calendar import date_span, footer_span, measured_calendar

    path = str(tmp_path / "facts")
    days = spark.range(1000).select(F.date_add(F.lit("2020-02-29").cast("date"), F.col("id").cast("int")).alias("day"),
                                    F.col("id").cast("string").alias("other"))
    days.repartition(4).write.parquet(path)
    facts = spark.read.parquet(path).select(F.col("day").alias("d"))
    plan = footer_span(spark, path, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(day), MAX(day)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    want = (D(2020, 2, 29), D(2022, 11, 24))
    assert date_span(facts, "d", (path, "day")) == date_span(facts, "d") == want
    assert date_span(facts.limit(0), "d") == (None, None)
    cal, n = measured_calendar(facts, "d", D(2021, 1, 1), D(2021, 12, 31), files=(path, "day"))
    got = cal.agg(F.min("pkdate"), F.max("pkdate"), F.count("*")).first()
    assert tuple(got) == (D(2018, 10, 1), D(2024, 9, 30), n)
    times = facts.select(F.col("d").cast("timestamp_ntz").alias("t"))
    times.write.parquet(str(tmp_path / "times"))
    assert footer_span(spark, str(tmp_path / "times"), "t") is None
    assert date_span(times, "t", (str(tmp_path / "times"), "t")) == want


@pytest.mark.parametrize("fy,lo,hi", [(10, D(2001, 9, 30), D(2001, 10, 1)), (1, D(1999, 12, 31), D(2000, 1, 1)), (7, D(1996, 2, 29), D(1996, 7, 1))])
def test_measured_calendar_equals_the_calendar_in_the_plan(spark, fy, lo, hi):
    from kpimart.operators.calendar import calendar_of, measured_calendar

    facts = spark.createDataFrame([(lo,), (hi,), (None,)], "d date")
    cal, n = measured_calendar(facts, "d", D(2000, 6, 1), D(2000, 6, 30), fy)
    want = calendar_of(facts, "d", D(2000, 6, 1), D(2000, 6, 30), fy)
    assert cal.count() == n and sorted(map(tuple, cal.collect())) == sorted(map(tuple, want.collect()))


def test_the_span_is_measured_once_a_refresh(spark, monkeypatch):
    from kpimart.operators import calendar
    from kpimart.plans import TEST_PARAMS, build, test_inputs
    from tests.conftest import SF0001

    seen, span = [], calendar.date_span
    monkeypatch.setattr(calendar, "date_span", lambda *a: seen.append(a) or span(*a))
    inputs = test_inputs(spark, SF0001)
    assert not seen
    plans = [build(n, inputs, TEST_PARAMS)._jdf.queryExecution().executedPlan().toString() for n in ("calendar", "violations")]
    assert len(seen) == 1
    assert "FileScan" not in plans[0] and "orders" not in plans[0]


@pytest.mark.parametrize("holidays", [
    [], [D(2024, 1, 6)], [D(2024, 1, 1), D(2024, 1, 15), D(2024, 1, 16), D(2024, 1, 15), D(2024, 3, 2)],
    [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 60, 3)], [D(1960, 2, 1), D(1969, 12, 29), D(1970, 1, 1), D(2024, 2, 29)],
    [D(2024, 2, 5) + dt.timedelta(days=k) for k in range(40)]])
def test_business_days_with_holidays_equal_counting(spark, holidays):
    from kpimart.functions import add_business_days_off_expr

    off = set(holidays)

    def count(d, n):
        while d.weekday() > 4 or d in off:      # a start that is off counts from the business day before it
            d -= dt.timedelta(days=1)
        while n:
            d += dt.timedelta(days=1)
            n -= d.weekday() < 5 and d not in off
        return d

    days = [D(2023, 12, 1) + dt.timedelta(days=k) for k in range(120)] + [D(1969, 12, 20) + dt.timedelta(days=k) for k in range(30)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "d date")
    for n in (1, 10, 23):
        got = df.select("d", add_business_days_off_expr("d", n, holidays).alias("t"))
        assert {r.d: r.t for r in got.collect()} == {None: None, **{d: count(d, n) for d in days}}
    plan = df.select(add_business_days_off_expr("d", 10, holidays))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
