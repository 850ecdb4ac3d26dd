"""Date column functions.

Everything here is a closed-form Catalyst expression, so it stays inside
whole-stage codegen and needs no calendar lookup.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    if isinstance(value, dt.datetime):
        text = value.isoformat(" ")  # with the fraction of a second, if any
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def date_lit(value: dt.date | str) -> Column:
    """A DATE literal."""
    if isinstance(value, dt.datetime):
        value = value.date()
    text = value.isoformat() if isinstance(value, dt.date) else str(value)
    return F.lit(text).cast("date")


def month_end(c: ColumnOrName) -> Column:
    """EOMONTH(c): last day of the month of a date or time, as DATE."""
    return F.last_day(F.to_date(_c(c)))


def month_start(c: ColumnOrName) -> Column:
    """DATEADD(DAY, 1, EOMONTH(c, -1)): first day of the month, as DATE."""
    return F.trunc(F.to_date(_c(c)), "month")


def deadline_expr(start: ColumnOrName, category: ColumnOrName,
                  days_by_value: dict[str, int], default_days: int) -> Column:
    """Start date plus N days, N chosen by a category value.

    NULL or unlisted categories take ``default_days`` (a CASE with ELSE).
    """
    cat = _c(category)
    days = None
    for value, n in days_by_value.items():
        days = (F.when(cat == value, F.lit(n)) if days is None
                else days.when(cat == value, F.lit(n)))
    days = F.lit(default_days) if days is None else days.otherwise(F.lit(default_days))
    return F.date_add(F.to_date(_c(start)), days)


def _week_sunday(d: Column) -> Column:
    # Sunday that opens the week of d (dayofweek: Sunday = 1 .. Saturday = 7).
    return F.date_sub(d, F.dayofweek(d) - 1)


def business_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Weekday difference as the reference computes it.

    days - 2 * (Sunday week boundaries crossed) - [start is Sunday]
    - [end is Saturday]. The start day is excluded, holidays are ignored,
    and Sat->Sat, Sat->Sun, Sun->Sun give -1, exactly like the source
    formula. Locale free: uses ``dayofweek`` instead of day names.
    """
    a = F.to_date(_c(start))
    b = F.to_date(_c(end))
    days = F.datediff(b, a)
    weeks = F.datediff(_week_sunday(b), _week_sunday(a)) / 7
    start_sunday = F.when(F.dayofweek(a) == 1, 1).otherwise(0)
    end_saturday = F.when(F.dayofweek(b) == 7, 1).otherwise(0)
    return (days - weeks.cast("int") * 2 - start_sunday - end_saturday).cast("int")


def add_business_days_expr(start: ColumnOrName, n: int | Column) -> Column:
    """Date ``n`` weekdays after ``start`` (O09, no holidays), n >= 1.

    A weekend start counts from the Friday before it, so the first
    business day after Saturday or Sunday is Monday. Closed form:
    with w = weekday(d) (Mon = 0), shift d back to Friday when w > 4, then
    add n + 2 * ((min(w, 4) + n) div 5) calendar days.
    """
    d = F.to_date(_c(start))
    n_col = n if isinstance(n, Column) else F.lit(n)
    w = F.weekday(d)
    base = F.date_sub(d, F.greatest(F.lit(0), w - 4))
    span = n_col + 2 * F.floor((F.least(w, F.lit(4)) + n_col) / 5).cast("int")
    return F.date_add(base, span.cast("int"))


def _weekdays_up_to(d: Column) -> Column:
    """How many weekdays there are up to and including a day, from Monday 1969-12-29 on."""
    day = F.unix_date(d) + 3
    return 5 * F.floor(day / 7).cast("int") + F.least(F.pmod(day, F.lit(7)) + 1, F.lit(5))


def _count_below(values: Sequence[int], x: Column, equal: bool) -> Column:
    """How many of the sorted ``values`` lie below ``x`` (or at it), by binary search in a literal array."""
    held, steps = F.lit(list(values)), [1 << i for i in reversed(range(len(values).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        value = F.get(held, at + step - 1)          # NULL past the end
        return F.when(value <= x if equal else value < x, at + step).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), further)


def add_business_days_off_expr(start: ColumnOrName, n: int, holidays: Sequence[dt.date]) -> Column:
    """Date ``n`` business days after ``start`` (O09), ``holidays`` being off besides weekends; n >= 1.

    No calendar and no join: the holidays on weekdays are a sorted literal
    array, and a row searches it twice. With w(d) the weekdays up to d, a
    holiday's place among business days is w less the holidays up to it; the
    target is the weekday that many places further as holidays lie before it.
    Days outside the listed holidays are judged by their weekday alone, so no
    date is off the calendar. A start that is off counts from the last
    business day before it.
    """
    off = sorted({h for h in holidays if h.weekday() < 5})
    if not off:
        return add_business_days_expr(start, n)
    days = [(h - dt.date(1970, 1, 1)).days for h in off]
    places = [5 * ((d + 3) // 7) + (d + 3) % 7 + 1 - (i + 1) for i, d in enumerate(days)]
    d = F.to_date(_c(start))
    place = _weekdays_up_to(d) - _count_below(days, F.unix_date(d), equal=True) + n
    at = place + _count_below(places, place, equal=False) - 1
    day = 7 * F.floor(at / 5).cast("int") + F.pmod(at, F.lit(5)) - 3
    return F.when(d.isNotNull(), F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")))


def month_keys(df, col: str, end_name: str = "Month_EndDate_Key", start_name: str = "Month_StartDate_Key"):
    """Add month end and month start keys of a date or time column."""
    return df.withColumns({end_name: month_end(col), start_name: month_start(col)})


def add_deadline(df, start: str, category: str, days_by_value: dict[str, int], default_days: int,
                 out_col: str = "TARGET_RESOLUTION_DATE"):
    """Add ``start + N days``, N chosen by ``category``."""
    return df.withColumn(out_col, deadline_expr(start, category, days_by_value, default_days))
