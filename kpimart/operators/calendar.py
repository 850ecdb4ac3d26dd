"""Fiscal calendar operators (O04, O05, O10) and holiday-aware business days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from kpimart.functions.dates import date_lit, ts_lit
from kpimart.operators.joins import maybe_broadcast

CAL_COLUMNS = ["pkdate", "fiscal_year", "fiscal_quarter", "fiscal_quarter_char_desc",
               "calendar_month_name_short", "calendar_year"]


def calendar_rows(start: dt.date, end: dt.date) -> int:
    """Exact row count of a day-level calendar: its proven size bound."""
    return max(0, (end - start).days + 1)


def fiscal_calendar(spark: SparkSession, start: dt.date, end: dt.date,
                    fy_start_month: int = 10) -> DataFrame:
    """One row per day in [start, end] with fiscal year and quarter.

    The fiscal year is named after the calendar year it ends in; with
    ``fy_start_month=10`` it runs 1 October to 30 September.
    """
    n = calendar_rows(start, end)
    days = spark.range(0, n, 1, max(1, n // 200_000 + 1)).select(
        F.date_add(date_lit(start), F.col("id").cast("int")).alias("pkdate"))
    return fiscal_days(days, fy_start_month)


def fiscal_days(days: DataFrame, fy_start_month: int = 10) -> DataFrame:
    """The fiscal columns of days (``pkdate``)."""
    shifted = F.add_months(F.col("pkdate"), (13 - fy_start_month) % 12)
    year, quarter = F.year(shifted), F.concat(F.lit("Q"), F.quarter(shifted).cast("string"))
    return days.select(
        "pkdate",
        year.alias("fiscal_year"),
        quarter.alias("fiscal_quarter"),
        F.concat(F.lit("FY"), year.cast("string"), F.lit(" "), quarter).alias("fiscal_quarter_char_desc"),
        F.date_format("pkdate", "MMM").alias("calendar_month_name_short"),
        F.year("pkdate").alias("calendar_year"),
    )


def calendar_of(facts: DataFrame, date_col: str, start: dt.date, end: dt.date, fy_start_month: int = 10,
                pad_years: int = 1) -> DataFrame:
    """Day calendar over whole fiscal years around ``[start, end]`` and the dates of ``facts``.

    The span is a one-row aggregate of the fact table, padded by
    ``pad_years`` fiscal years on both sides and exploded to days, all inside
    the plan: nothing runs while it is built, and a late date in the facts
    cannot fall off the calendar.
    """
    day = F.to_date(date_col)
    span = facts.agg(F.least(F.min(day), date_lit(start)).alias("lo"), F.greatest(F.max(day), date_lit(end)).alias("hi"))
    back = (fy_start_month - 1) % 12

    def opens(d: Column) -> Column:
        """First day of the fiscal year of ``d``."""
        return F.add_months(F.trunc(F.add_months(d, -back), "year"), back)

    first = F.add_months(opens(F.col("lo")), -12 * pad_years)
    last = F.date_sub(F.add_months(opens(F.col("hi")), 12 * (pad_years + 1)), 1)
    return fiscal_days(span.select(F.explode(F.sequence(first, last)).alias("pkdate")), fy_start_month)


def date_span(facts: DataFrame, date_col: str, files: tuple[str, str] | None = None) -> tuple[dt.date | None, dt.date | None]:
    """First and last day of a column, by one job; (None, None) without any.

    ``files`` names the Parquet files that ``facts`` holds whole and the column
    there. A DATE column is then answered from the files' footers: Spark pushes
    the aggregate into the scan of a V2 source, which is read in a session of
    its own so that no other plan sees its settings. Other columns and sources
    cost a scan of that one column.
    """
    found = footer_span(facts.sparkSession, *files) if files else None
    if found is None:
        day = F.to_date(date_col)
        found = facts.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    row = found.first()
    return row["lo"], row["hi"]


def footer_span(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """Minimum and maximum of a DATE column from Parquet footers; None for another type."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = other.read.parquet(path)
    if table.schema[column].dataType != DateType():
        return None
    return table.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def measured_calendar(facts: DataFrame, date_col: str, start: dt.date, end: dt.date, fy_start_month: int = 10,
                      pad_years: int = 1, files: tuple[str, str] | None = None) -> tuple[DataFrame, int]:
    """:func:`calendar_of` with its span measured now, by one job, and its row count.

    For a refresh: the span is read once and every mart gets the same calendar
    of known size, which is generated from two literals and never scans the
    facts again.
    """
    lo, hi = date_span(facts, date_col, files)
    lo, hi = min(filter(None, (lo, start))), max(filter(None, (hi, end)))

    def opens(d: dt.date) -> int:
        """The calendar year in which the fiscal year of ``d`` opens."""
        return d.year - (d.month < fy_start_month)

    first = dt.date(max(1, opens(lo) - pad_years), fy_start_month, 1)
    after = opens(hi) + pad_years + 1
    last = dt.date(after, fy_start_month, 1) - dt.timedelta(days=1) if after <= dt.MAXYEAR else dt.date.max
    return fiscal_calendar(facts.sparkSession, first, last, fy_start_month), calendar_rows(first, last)


def month_end_calendar(cal: DataFrame, as_of: dt.datetime, start: dt.date) -> DataFrame:
    """Month-end reporting calendar.

    Keeps month-end days in [start, EOMONTH(as_of)] and derives previous
    month end, same month last year, the ``M-YY`` display label and the
    latest / previous / same-month-last-year indicators from ``as_of``. A
    calendar in which one of these months is missing raises when the job runs.
    """
    d = F.col("pkdate")
    as_of_d = date_lit(as_of.date() if isinstance(as_of, dt.datetime) else as_of)

    def indicator(target: Column) -> Column:
        return F.when(F.last_day(d) == F.last_day(target), 1).otherwise(0)

    # Months are few: one ordered window sees them all and fails on a gap.
    w = Window.orderBy("pkdate")
    first, last = F.last_day(date_lit(start)), F.last_day(as_of_d)
    due = F.coalesce(F.last_day(F.add_months(F.lag(d).over(w), 1)), first)
    gap = (d != due) | (F.lead(d).over(w).isNull() & (d != last))
    months = cal.filter((d == F.last_day(d)) & (d >= date_lit(start)) & (d <= last)).select("*", gap.alias("__gap"))
    whole = F.when(F.col("__gap"), F.raise_error(F.concat(
        F.lit("the calendar misses a month next to "), d.cast("string")))).otherwise(d)
    return (
        months
        .select(
            ts_lit(as_of).alias("Load_Date"),
            whole.cast("date").alias("Month_EndDate_Key"),
            F.last_day(F.add_months(d, -1)).alias("Month_EndDate_PreviousMonth"),
            F.last_day(F.add_months(d, -12)).alias("Month_EndDate_PreviousYearMonth"),
            F.col("fiscal_year").cast("int").alias("Fiscal_Year"),
            F.col("fiscal_quarter").alias("Fiscal_Quarter"),
            F.col("calendar_month_name_short").alias("Month_ShortName"),
            F.concat(F.substring("calendar_month_name_short", 1, 1), F.lit("-"),
                     F.right(F.col("calendar_year").cast("string"), F.lit(2))).alias("Display_Name"),
            indicator(as_of_d).alias("Indicator_Latest_Month"),
            indicator(F.add_months(as_of_d, -1)).alias("Indicator_Previous_Month"),
            indicator(F.add_months(as_of_d, -12)).alias("Indicator_Previous_Year_Month"),
        )
    )


def fiscal_period(df: DataFrame, cal: DataFrame, date_col: str | Column, min_fiscal_year: int | None,
                  cal_rows: int | None = None) -> DataFrame:
    """Attach FISCAL_YEAR / FISCAL_QUARTER by date, keep fiscal years >= min.

    A left join on the date; the year filter then drops unmatched dates as
    in the reference (Catalyst plans it as an inner join). The calendar is
    broadcast only when its row count is known and small.
    """
    key = F.to_date(F.col(date_col) if isinstance(date_col, str) else date_col)
    c = cal.select(F.col("pkdate").alias("__cal_date"), F.col("fiscal_year").alias("FISCAL_YEAR"),
                   F.col("fiscal_quarter_char_desc").alias("FISCAL_QUARTER"))
    c = maybe_broadcast(c, cal_rows)
    out = df.join(c, key == F.col("__cal_date"), "left").drop("__cal_date")
    if min_fiscal_year is not None:
        out = out.filter(F.col("FISCAL_YEAR") >= F.lit(min_fiscal_year))
    return out


def business_day_calendar(cal: DataFrame, holidays: DataFrame | None = None,
                          holiday_col: str = "holiday") -> DataFrame:
    """Day calendar with a running business-day ordinal.

    ``bd_ord`` counts weekdays that are not holidays up to and including the
    day. The ordered window runs over the calendar's days in one task: the
    calendar is bounded by its date span (366 rows per year), never by the
    fact data.
    """
    days = cal.select(F.col("pkdate"))
    if holidays is not None:
        # The holiday table's size is the caller's: no hint, AQE broadcasts it
        # only when it measures small.
        h = holidays.select(F.to_date(holiday_col).alias("__h")).distinct()
        days = days.join(h, F.col("pkdate") == F.col("__h"), "left")
        is_hol = F.col("__h").isNotNull()
    else:
        is_hol = F.lit(False)
    is_bd = (F.weekday("pkdate") < 5) & ~is_hol
    w = Window.orderBy("pkdate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(
        "pkdate",
        is_bd.alias("is_business_day"),
        F.sum(F.when(is_bd, 1).otherwise(0)).over(w).alias("bd_ord"),
    )


def add_business_days(df: DataFrame, start: str | Column, n: int, out_col: str,
                      bd_cal: DataFrame | None = None, cal_rows: int | None = None) -> DataFrame:
    """Add ``n`` business days to a date column.

    Without a business-day calendar this is the closed weekday formula.
    With one (holidays), the start's business ordinal is looked up and the
    day with ordinal + n is the answer; both lookups are equi-joins against
    the bounded calendar. A date off the calendar, or whose answer is, raises
    when the job runs; a NULL date stays NULL.
    """
    from kpimart.functions.dates import add_business_days_expr

    start_c = F.col(start) if isinstance(start, str) else start
    if bd_cal is None:
        return df.withColumn(out_col, add_business_days_expr(start_c, n))
    first = bd_cal.select(F.col("pkdate").alias("__d0"), F.col("bd_ord").alias("__o0"))
    target = (bd_cal.filter("is_business_day")
              .select(F.col("pkdate").alias("__t"), F.col("bd_ord").alias("__o1")))
    first, target = maybe_broadcast(first, cal_rows), maybe_broadcast(target, cal_rows)
    day = F.to_date(start_c)
    off = F.raise_error(F.concat(F.lit(f"no calendar day {n} business days after "), day.cast("string")))
    return (df.join(first, day == F.col("__d0"), "left")
              .join(target, (F.col("__o0") + F.lit(n)) == F.col("__o1"), "left")
              .withColumn(out_col, F.when(day.isNotNull() & F.col("__t").isNull(), off.cast("date")).otherwise(F.col("__t")))
              .drop("__d0", "__o0", "__t", "__o1"))
