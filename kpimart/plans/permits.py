"""Permits mart: M08-M22 and M29."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimart.functions.dates import month_end, month_start
from kpimart.functions.flags import threshold_flag
from kpimart.operators.joins import enrich, enrich_multiplicity
from kpimart.operators.scope import Segment, scope
from kpimart.plans import params as P
from kpimart.plans.inputs import Inputs
from kpimart.plans.mart import Base, MartSpec, MeasureSpec
from kpimart.plans.schemas import permits_schema

MONTH = "Month_EndDate_Key"
DIMS = ("Job_Class", "Permit_Types")

LCC = Segment(P.SUB_LCC, {"Job_Class": P.LCC_JOB_CLASSES, "Permit_Types": P.LCC_PERMIT_TYPES})
# "Danger Close": the issued count filters job class and permit type, the
# other three measures permit type only.
DC_ISSUED = Segment(P.SUB_DANGER_CLOSE, {"Job_Class": P.DANGER_CLOSE_JOB_CLASSES,
                                         "Permit_Types": P.DANGER_CLOSE_PERMIT_TYPES})
DC = Segment(P.SUB_DANGER_CLOSE, {"Permit_Types": P.DANGER_CLOSE_PERMIT_TYPES})


def _scoped_permits(inputs: Inputs, params: P.MartParams) -> DataFrame:
    return scope(inputs["permits"], ("gt", "issued_date", params.permit_lower_bound),
                 ("eq", "permit_type", P.PERMIT_TYPE_CONSTRUCTION))


def _permit_columns(df: DataFrame, extra=()) -> DataFrame:
    return df.select(month_end("issued_date").alias(MONTH), month_start("issued_date").alias("Month_StartDate_Key"),
                     F.col("cap_id").alias("CAP_ID"), F.col("job_class").alias("Job_Class"),
                     F.col("permit_types").alias("Permit_Types"),
                     F.col("review_cycles").alias("Review_Cycles"),
                     F.col("business_days").alias("Business_Days"), *extra)


def stage_permits(inputs: Inputs, params: P.MartParams) -> DataFrame:
    """M08 row by row: issued construction permits, fanned out by address records."""
    p = enrich(_scoped_permits(inputs, params), inputs["cap_apo"], {"cap_id": "b1_alt_id"}, columns=[])
    return _permit_columns(p)


def stage_permits_weighted(inputs: Inputs, params: P.MartParams, weight: str = "_w") -> DataFrame:
    """M08 with the address fan-out kept as a row weight (no duplicated rows)."""
    p = enrich_multiplicity(_scoped_permits(inputs, params), inputs["cap_apo"], {"cap_id": "b1_alt_id"}, weight)
    return _permit_columns(p, [F.col(weight)])


def stage_applications(inputs: Inputs, params: P.MartParams) -> DataFrame:
    """Completed applicant uploads after the lower bound."""
    u = scope(inputs["uploads"], ("eq", "group_name", P.UPLOAD_GROUP), ("eq", "task_name", P.UPLOAD_TASK),
              ("eq", "task_status", P.UPLOAD_STATUS), ("gt", "task_date", params.permit_lower_bound))
    return u.select(month_end("task_date").alias(MONTH), month_start("task_date").alias("Month_StartDate_Key"),
                    F.col("job_class").alias("Job_Class"), F.col("permit_types").alias("Permit_Types"),
                    F.col("upload_id").alias("pdox_b1_id"))


def bases(inputs: Inputs, params: P.MartParams, plan: str = "onepass") -> dict[str, Base]:
    if plan == "onepass":
        issued = Base(stage_permits_weighted(inputs, params, "_w"), weight="_w")
    else:
        issued = Base(stage_permits(inputs, params))
    issued.df = issued.df.withColumn("over_2_indic", threshold_flag("Review_Cycles", P.REVIEW_CYCLE_LIMIT))
    return {"issued": issued, "applications": Base(stage_applications(inputs, params))}


def _labels(section, sub, measure):
    return {"Section": section, "Sub_Section": sub, "Measure_Type": measure}


def _measures():
    S, V = P.SEC_PERMIT_SPEED, P.SEC_PERMIT_VOLUME
    detail = (MONTH, *DIMS)
    out = [
        MeasureSpec("permit_issued", "issued", "count", _labels(V, P.SUMMARY, P.M_PERMITS_ISSUED), detail, "CAP_ID"),
        MeasureSpec("permit_applications", "applications", "count", _labels(V, P.SUMMARY, P.M_APPLICATIONS),
                    detail, "pdox_b1_id"),
        MeasureSpec("permit_two_cycles", "issued", "ratio", _labels(S, P.SUMMARY, P.M_TWO_CYCLES), detail,
                    "over_2_indic"),
        MeasureSpec("permit_total_days", "issued", "sum", _labels(S, P.SUMMARY, P.M_TOTAL_DAYS), detail,
                    "Business_Days"),
        MeasureSpec("permit_p90", "issued", "percentile", _labels(S, P.SUMMARY, P.M_P90_ISSUED), (MONTH,),
                    "Business_Days", collapse=DIMS, p=P.PERCENTILE, domain_bits=P.DAY_BITS),
    ]
    for prefix, sub, seg_issued, seg in (("lcc", P.SUB_LCC, LCC, LCC), ("dc", P.SUB_DANGER_CLOSE, DC_ISSUED, DC)):
        out += [
            MeasureSpec(f"{prefix}_issued", "issued", "count", _labels(V, sub, P.M_PERMITS_ISSUED), (MONTH,),
                        "CAP_ID", segment=seg_issued, collapse=DIMS),
            MeasureSpec(f"{prefix}_applications", "applications", "count", _labels(V, sub, P.M_APPLICATIONS),
                        (MONTH,), "pdox_b1_id", segment=seg, collapse=DIMS),
            MeasureSpec(f"{prefix}_p90", "issued", "percentile", _labels(S, sub, P.M_P90_ISSUED), (MONTH,),
                        "Business_Days", segment=seg, collapse=DIMS, p=P.PERCENTILE, domain_bits=P.DAY_BITS),
            MeasureSpec(f"{prefix}_two_cycles", "issued", "ratio", _labels(S, sub, P.M_TWO_CYCLES), (MONTH,),
                        "over_2_indic", segment=seg, collapse=DIMS),
        ]
    return tuple(out)


MART = MartSpec(name="permits", schema=permits_schema, distinct=True, measures=_measures())
