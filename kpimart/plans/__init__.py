"""Marts expressed with the operators: specs, stages, one-pass plan, refresh."""

from kpimart.plans.inputs import Inputs, load_inputs, test_inputs
from kpimart.plans.mart import Base, MartSpec, MeasureSpec, build_mart, build_measures
from kpimart.plans.onepass import histogram
from kpimart.plans.params import TEST_PARAMS, MartParams
from kpimart.plans.refresh import build, measure, refresh_all

__all__ = ["Base", "Inputs", "MartParams", "MartSpec", "MeasureSpec", "TEST_PARAMS", "build", "build_mart",
           "build_measures", "histogram", "load_inputs", "measure", "refresh_all", "test_inputs"]
