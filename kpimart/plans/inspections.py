"""Inspections mart: M23-M27 and M30."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimart.functions.dates import add_business_days_off_expr, business_days_between, month_end
from kpimart.functions.flags import prefix_flag, prefix_match, relabel, sla_flag
from kpimart.operators.joins import first_per_key, one_of_equal
from kpimart.operators.scope import scope
from kpimart.plans import params as P
from kpimart.plans.inputs import Inputs
from kpimart.plans.mart import Base, MartSpec, MeasureSpec
from kpimart.plans.schemas import inspections_schema

MONTH = "Month_EndDate_Key"
DIMS = (MONTH, "Inspection_Cap_Type", "Inspection_Type", "Ward")


def stage_inspections(inputs: Inputs, params: P.MartParams, tie: tuple[str, ...] = ()) -> DataFrame:
    """Completed inspections in scope with month, SLA and no-access flags.

    ``SLA_MET``: the date 10 business days after the creation date must be
    on or after the completion time (a DATE against a time, so completing
    later on the target day misses). ``NOT_NO_ACCESS`` is the predicate
    ``status NOT LIKE 'NO ACCESS%'`` (NULL for a NULL status).
    """
    i = scope(inputs["inspections"],
              ("ge", "completed_date", params.inspection_lower_bound),
              ("in", "status_des", P.INSPECTION_DONE_STATUSES),
              ("not_in", "division_code", P.EXCLUDED_DIVISIONS),
              ("not_in_or_null", "inspector_group", P.EXCLUDED_INSPECTOR_GROUPS))
    target = add_business_days_off_expr("created_date", P.SLA_BUSINESS_DAYS, params.holidays)
    return i.select(
        month_end("completed_date").alias(MONTH),
        F.col("grp").alias("Inspection_Cap_Type"),
        F.col("action_type").alias("Inspection_Type"),
        F.col("cap_id").alias("CAP_ID"),
        F.col("cap_status").alias("CAP_STATUS"),
        F.col("created_date").alias("CAP_CREATEDATE"),
        F.col("completed_date").alias("COMPLETED_DATE"),
        sla_flag("completed_date", target, as_date=False).alias("SLA_MET"),
        prefix_flag("cap_status", P.NO_ACCESS_PREFIX).alias("NO_ACCESS_FLAG"),
        prefix_match("cap_status", P.NO_ACCESS_PREFIX, negate=True).alias("NOT_NO_ACCESS"),
        F.col("ward").alias("WARD"),
        *[F.col(t) for t in tie],
    )


def with_first_record(stage: DataFrame, tie: tuple[str, ...]) -> DataFrame:
    """Flag the first inspection per case (the reference's ``UNIQUE_RECORD = 1``) on every row.

    The first ``(CAP_ID, COMPLETED_DATE, tie)`` per case comes from a
    partial top-1 per task and is joined back on all of those columns, so a
    hot case spreads over many partitions and no task sorts a whole case.
    """
    first = first_per_key(stage.select("CAP_ID", "COMPLETED_DATE", *tie), "CAP_ID", ["COMPLETED_DATE"], list(tie))
    cols = ["CAP_ID", "COMPLETED_DATE", *tie]
    first = first.select(*[F.col(c).alias(f"__f{i}") for i, c in enumerate(cols)], F.lit(1).alias("__first"))
    cond = None
    for i, c in enumerate(cols):
        e = stage[c].eqNullSafe(F.col(f"__f{i}"))
        cond = e if cond is None else cond & e
    return (stage.join(first, cond, "left")
                 .withColumn("FIRST_RECORD", one_of_equal(F.col("__first").isNotNull(), cols))
                 .drop(*[f"__f{i}" for i in range(len(cols))], "__first"))


def bases(inputs: Inputs, params: P.MartParams, tie: tuple[str, ...] = ()) -> dict[str, Base]:
    """Two bases, so the inspections table is scanned twice per refresh.

    ``inspections`` feeds the volume measures and the 90th percentile: the
    percentile's merged inspection type and business days are extra columns
    (days only on Housing rows, the only rows that measure reads).
    ``first`` is the first inspection per case, ranked over all groups; the
    Housing filter comes after the rank.
    """
    st = stage_inspections(inputs, params, tie)
    ward = F.col("WARD").alias("Ward")
    housing = F.col("Inspection_Cap_Type") == P.HOUSING
    everything = st.select(
        MONTH, "Inspection_Cap_Type", "Inspection_Type", ward, "NO_ACCESS_FLAG", "NOT_NO_ACCESS",
        relabel("Inspection_Type", P.FOLLOW_UP_SPELLINGS, keep_other=True).alias(MERGED_TYPE),
        F.when(housing, business_days_between("CAP_CREATEDATE", "COMPLETED_DATE")).alias(HOUSING_DAYS))
    first = first_per_key(st, "CAP_ID", ["COMPLETED_DATE"], list(tie)).select(
        MONTH, "Inspection_Cap_Type", "Inspection_Type", ward, "SLA_MET")
    return {"inspections": Base(everything), "first": Base(first)}


MERGED_TYPE = "Inspection_Type_Merged"
HOUSING_DAYS = "housing_days"


def _labels(section, sub, measure):
    return {"Section": section, "Sub_Section": sub, "Measure_Type": measure}


MART = MartSpec(
    name="inspections",
    schema=inspections_schema,
    distinct=False,
    measures=(
        MeasureSpec("insp_completed", "inspections", "count",
                    _labels(P.SEC_INSPECTION_VOLUME, P.SUB_COMPLETED, P.M_COMPLETED), DIMS,
                    where=(("eq", "NOT_NO_ACCESS", True),), denominator=0),
        MeasureSpec("insp_no_access", "inspections", "ratio",
                    _labels(P.SEC_INSPECTION_VOLUME, P.SUB_NO_ACCESS, P.M_NO_ACCESS), DIMS, "NO_ACCESS_FLAG"),
        MeasureSpec("insp_ten_days", "first", "ratio",
                    _labels(P.SEC_INSPECTION_SPEED, P.SUB_TEN_DAYS, P.M_TEN_DAYS), DIMS, "SLA_MET",
                    where=(("eq", "Inspection_Cap_Type", P.HOUSING),)),
        MeasureSpec("insp_p90", "inspections", "carry", _labels(P.SEC_INSPECTION_SPEED, P.SUB_P90, P.M_P90),
                    (MONTH, "Inspection_Cap_Type", MERGED_TYPE), HOUSING_DAYS,
                    where=(("eq", "Inspection_Cap_Type", P.HOUSING),), carry=("Ward",), denominator=0,
                    p=P.PERCENTILE, domain_bits=P.DAY_BITS, rename=((MERGED_TYPE, "Inspection_Type"),)),
    ),
)
