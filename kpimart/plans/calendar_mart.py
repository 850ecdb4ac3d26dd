"""The month-end reporting calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpimart.operators.calendar import month_end_calendar
from kpimart.plans.inputs import Inputs
from kpimart.plans.params import MartParams
from kpimart.plans.schemas import REQUIRED, calendar_schema
from kpimart.sources.io import conform


def mart_calendar(inputs: Inputs, params: MartParams) -> DataFrame:
    cal = month_end_calendar(inputs.calendar, params.as_of, params.calendar_start)
    return conform(cal, calendar_schema(), REQUIRED)
