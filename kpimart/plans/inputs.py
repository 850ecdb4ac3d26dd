"""The set of source tables a refresh reads, plus the day calendar."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from contextlib import ExitStack, contextmanager
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession

from kpimart.operators.calendar import measured_calendar
from kpimart.plans import params as P
from kpimart.sources.io import is_path, read_source, staged
from kpimart.sources.schemas import SOURCES, as_declared


class Lazy(Mapping):
    """Tables by name, made when first asked for: a query builds only what it reads."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self.makers, self.made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.makers[name]()
        return self.made[name]

    def __iter__(self):
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


class Inputs:
    """Source DataFrames keyed by name (see ``SOURCES``) and the fiscal calendar.

    ``calendar`` is a DataFrame, or a function that makes it and its row count
    when first used: once for all marts of a refresh. ``cal_rows`` is the
    calendar's exact row count when known (one row per day of its span), which
    allows a broadcast of proven size.
    """

    def __init__(self, tables: Mapping[str, DataFrame],
                 calendar: DataFrame | Callable[[], tuple[DataFrame, int | None]], cal_rows: int | None = None,
                 rejects: Mapping[str, Observation] | None = None):
        self.rejects = dict(rejects or {})
        self.tables, self._cal_rows, self._calendar, self._lock = tables, cal_rows, calendar, Lock()

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def calendar(self) -> DataFrame:
        with self._lock:  # marts are built side by side
            if callable(self._calendar):
                self._calendar, self._cal_rows = self._calendar()
        return self._calendar

    @property
    def cal_rows(self) -> int | None:
        return self.calendar is not None and self._cal_rows or None


def load_inputs(spark: SparkSession, places: Mapping[str, str], renames: Mapping[str, Mapping[str, str]] | None = None,
                params: P.MartParams | None = None, calendar: str | None = None, fmt: str = "parquet",
                parse: Mapping[str, Collection[str]] | None = None) -> Inputs:
    """The real sources: each name of ``SOURCES`` from a path or a table.

    ``renames`` maps, by source, a declared column to its name there. Every
    source is opened at once; a missing column, or one whose type does not
    widen to the declared one, raises before any job. ``parse`` names, by
    source, columns to convert value by value instead; the rows this leaves
    out are counted in the ``rejects`` of the inputs, by source, when a job
    has run.
    ``calendar`` is the place of a day calendar with the columns of
    ``fiscal_days``; without one it is made from the violations' dates and
    ``params``.
    """
    renames = renames or {}
    unknown = sorted(set(places) - set(SOURCES))
    if unknown:
        raise ValueError(f"unknown sources {unknown}; declared are {sorted(SOURCES)}")
    tables, parse = {}, parse or {}
    rejects = {name: Observation(f"rejects of {name}") for name in parse}
    for name, place in places.items():
        own = renames.get(name, {})
        df = read_source(spark, place, {own.get(c, c): c for c in SOURCES[name].fieldNames()}, fmt)
        tables[name] = as_declared(name, df, parse.get(name, ()), rejects.get(name))
    if calendar is not None:
        days = read_source(spark, calendar, CALENDAR_COLUMNS, fmt)
        return Inputs(tables, days, rejects=rejects)
    if params is None:
        raise ValueError("params are needed to make a calendar")
    place, day = places["violations"], renames.get("violations", {}).get("service_date", "service_date")
    files = (place, day) if fmt == "parquet" and is_path(place) else None
    return Inputs(tables, lambda: measured_calendar(tables["violations"], "service_date", params.calendar_start,
                                                    params.as_of.date(), params.fy_start_month, files=files),
                  rejects=rejects)


# Sources that several measures and marts join and group by a case.
CASE_KEYS = {"violations": "cap_id", "address": "b1_alt_id", "permits": "cap_id", "cap_apo": "b1_alt_id", "inspections": "cap_id"}


@contextmanager
def staged_by_case(inputs: Inputs, columns: Mapping[str, Collection[str]] | None = None, buckets: int | None = None) -> Iterator[Inputs]:
    """The inputs with the sources of ``CASE_KEYS`` staged by case, for the length of a ``with`` block.

    Each is read once and written as a bucketed table of its declared columns
    (and ``columns`` besides, by source, such as tie-breakers); what joins or
    groups by case then shuffles none of them. The tables go at the end.
    """
    columns = columns or {}
    with ExitStack() as tables:
        held = {n: tables.enter_context(staged(inputs[n], mode="bucketed", by=[key], buckets=buckets,
                                               columns=[*SOURCES[n].fieldNames(), *columns.get(n, ())]))
                for n, key in CASE_KEYS.items() if n in inputs.tables}
        rest = {n: (lambda n=n: inputs[n]) for n in inputs.tables if n not in held}
        yield Inputs(Lazy({**rest, **{n: (lambda d=d: d) for n, d in held.items()}}), lambda: (inputs.calendar, inputs.cal_rows))


CALENDAR_COLUMNS = ("pkdate", "fiscal_year", "fiscal_quarter", "fiscal_quarter_char_desc",
                    "calendar_month_name_short", "calendar_year")


def test_inputs(spark: SparkSession, sf_dir: str, fy_start_month: int = 10) -> Inputs:
    """Adapter tables over the driver's parquet files (FIXTURES.md section 3)."""
    from kpimart.sources import adapters

    tables = Lazy(adapters.makers(spark, sf_dir))
    p = P.TEST_PARAMS

    def calendar() -> tuple[DataFrame, int]:
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderdate")
        return measured_calendar(orders, "o_orderdate", p.calendar_start, p.as_of.date(), fy_start_month)

    return Inputs(tables, calendar)
