"""Full refresh of all four marts for one ``as_of``."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame

from kpimart.plans import inspections, permits, violations
from kpimart.plans.calendar_mart import mart_calendar
from kpimart.plans.inputs import Inputs, staged_by_case
from kpimart.plans.mart import Base, MartSpec, build_mart, build_measures
from kpimart.plans.params import MartParams
from kpimart.plans.schemas import REQUIRED, calendar_schema, decimal_type
from kpimart.plans.text import folded
from kpimart.sources.io import Run, write_run
from kpimart.sources.manifest import commit_runs, remove

MARTS = {"violations": violations, "permits": permits, "inspections": inspections}


def mart_bases(name: str, inputs: Inputs, params: MartParams, plan: str = "onepass", tie: dict | None = None):
    tie = tie or {}
    if params.ignore_case:
        inputs = folded(inputs)
    if name == "violations":
        return violations.bases(inputs, params, plan, tuple(tie.get("class_notice", ())))
    if name == "permits":
        return permits.bases(inputs, params, plan)
    if name == "inspections":
        return inspections.bases(inputs, params, tuple(tie.get("inspections", ())))
    raise KeyError(name)


def build(name: str, inputs: Inputs, params: MartParams, plan: str = "onepass", tie: dict | None = None
          ) -> DataFrame:
    """One mart as a DataFrame (not written)."""
    if name == "calendar":
        return mart_calendar(inputs, params)
    mod = MARTS[name]
    return build_mart(mod.MART, mart_bases(name, inputs, params, plan, tie), params.as_of, params.value_type,
                      plan, params.checkpoint_histograms)


def measure(key: str, inputs: Inputs, params: MartParams, plan: str = "onepass", tie: dict | None = None
            ) -> DataFrame:
    """One measure (a UNION branch), conformed to its mart's schema."""
    from kpimart.sources.io import conform

    for name, mod in MARTS.items():
        if any(s.key == key for s in mod.MART.measures):
            b = mart_bases(name, inputs, params, plan, tie)
            m = build_measures(mod.MART, b, params.as_of, params.value_type, plan, only=[key])[key]
            return conform(m, mod.MART.schema(decimal_type(params.value_type)))
    raise KeyError(key)


def refresh_all(inputs: Inputs, params: MartParams, target_dir: str, plan: str = "onepass",
                tie: dict | None = None, partition_by: dict | None = None, parallel: bool = True,
                extra: Mapping[str, tuple[MartSpec, Mapping[str, Base]]] | None = None,
                stage_by_case: bool = False) -> dict[str, DataFrame]:
    """Rebuild and replace the calendar and the three subject marts.

    Each mart is written to ``target_dir/<name>`` (a shared folder) as a new
    run. When all of them are written and validated, one manifest makes all
    runs current (:mod:`kpimart.sources.manifest`): whichever mart fails, all
    stay at the previous ``as_of``, the new runs are removed and the first
    failure is raised. ``extra`` adds marts of the caller's: a spec and its
    bases by name. With ``parallel`` the marts are submitted from a thread
    pool: Spark runs their jobs concurrently, so one mart's small final stages
    overlap another's scans. With ``stage_by_case`` the sources keyed by case
    are first written as bucketed tables, which all marts then read without a
    shuffle on the case, and dropped at the end.
    """
    if stage_by_case:
        more = {"inspections": tuple((tie or {}).get("inspections", ()))}
        with staged_by_case(inputs, more) as held:
            return refresh_all(held, params, target_dir, plan, tie, partition_by, parallel, extra)
    from concurrent.futures import ThreadPoolExecutor

    partition_by = partition_by or {}
    vt = decimal_type(params.value_type)
    schemas = {"calendar": (calendar_schema(), REQUIRED)}
    schemas.update({name: (mod.MART.schema(vt), mod.MART.required) for name, mod in MARTS.items()})
    extra = extra or {}
    schemas.update({name: (spec.schema(vt), spec.required) for name, (spec, _) in extra.items()})

    def rows(name: str) -> DataFrame:
        if name in extra:
            return build_mart(*extra[name], params.as_of, params.value_type, plan, params.checkpoint_histograms)
        return build(name, inputs, params, plan, tie)

    def one(name: str) -> Run:
        schema, required = schemas[name]
        return write_run(rows(name), schema, os.path.join(target_dir, name), required, partition_by.get(name, ()))

    names, runs, errors = list(schemas), {}, []
    with ThreadPoolExecutor(max_workers=len(names) if parallel else 1) as pool:
        futures = {name: pool.submit(one, name) for name in names}
    for name, f in futures.items():
        if f.exception() is None:
            runs[name] = f.result()
        else:
            errors.append(f.exception())
    if errors:
        for run in runs.values():
            remove(run.df.sparkSession, run.place)
        raise errors[0]
    commit_runs(next(iter(runs.values())).df.sparkSession, target_dir.rstrip("/"),
                {n: {"run": r.name, "rows": r.rows, "as_of": str(params.as_of)} for n, r in runs.items()})
    return {name: run.df for name, run in runs.items()}
