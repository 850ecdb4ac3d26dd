"""Violations mart: M02-M07 and M28."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpimart.functions.dates import deadline_expr, month_end
from kpimart.functions.flags import relabel, sla_flag
from kpimart.operators.calendar import fiscal_period
from kpimart.operators.joins import enrich, enrich_split, enrich_weighted, latest_per_key, require_related, require_related_weighted
from kpimart.operators.scope import scope, transition_scope
from kpimart.plans import params as P
from kpimart.plans.inputs import Inputs
from kpimart.plans.mart import Base, MartSpec, MeasureSpec
from kpimart.plans.schemas import violations_schema

MONTH = "Month_EndDate_Key"
DIMS = (MONTH, "Violation_Type", "Filter_1", "Ward")


def stage_violations(inputs: Inputs, params: P.MartParams, weight: str | None = None) -> DataFrame:
    """Scoped violations with deadline, ward, fiscal period, SLA flag, month.

    With ``weight``, equal rows that the address records of a case make are
    one row and a count in that column. Without it every row is kept, and a
    case with very many address records is split over tasks.
    """
    v = scope(inputs["violations"],
              ("not_null", "service_status"),
              ("in", "grp", P.VIOLATION_GROUPS),
              ("in", "response_level", P.RESPONSE_LEVELS),
              ("not_in", "cap_status", P.CANCELLED_CASE_STATUSES))
    v = v.withColumn("TARGET_RESOLUTION_DATE",
                     deadline_expr("service_date", "response_level", P.DEADLINE_DAYS, P.DEFAULT_DEADLINE_DAYS))
    if weight:
        v = enrich_weighted(v, inputs["address"], {"cap_id": "b1_alt_id"}, ["ward"], weight)
    else:
        v = enrich_split(v, inputs["address"], {"cap_id": "b1_alt_id"}, ["ward"])
    v = v.withColumnRenamed("ward", "WARD")
    v = fiscal_period(v, inputs.calendar, "TARGET_RESOLUTION_DATE", params.min_fiscal_year, inputs.cal_rows)
    return v.select(
        "FISCAL_YEAR", "FISCAL_QUARTER", "cap_id", "grp", "response_level", "cap_status", "service_status",
        "abatement_status", "service_date", "abated_date", "TARGET_RESOLUTION_DATE", "WARD",
        sla_flag("abated_date", "TARGET_RESOLUTION_DATE", "abatement_status", P.ABATED_STATUSES)
        .alias("SLA_MET_INDICATOR"),
        month_end("TARGET_RESOLUTION_DATE").alias("ABATED_MONTH"),
        *([weight] if weight else []),
    )


NOTICE_COLUMNS = ("ssl_info", "otr_address", "workflow_status", "update_status", "class_id_from",
                  "class_id_to", "record_date", "update_date_time")


def stage_vacant_reuse(inputs: Inputs, params: P.MartParams, tie: tuple[str, ...] = (),
                       weight: str | None = None) -> DataFrame:
    """Class changes from vacant/blighted to occupied, with ward, owner check and month.

    The latest-record-per-parcel filter exists but is off by default, as in
    the reference (``params.keep_latest_notice``). With ``weight``, a parcel's
    owner points are a count in that column.
    """
    n = transition_scope(inputs["class_notice"], "class_id_from", "class_id_to",
                         P.VACANT_FROM_CLASSES, P.VACANT_TO_CLASSES,
                         extra=[("in", "workflow_status", P.OCCUPIED_WORKFLOW_STATUSES),
                                ("eq", "update_status", P.UPDATE_SUCCESS)])
    owners_ok = F.col("delcode") != F.lit(P.OWNER_EXCLUDED_CODE)
    if params.keep_latest_notice:
        # The source's order: the latest-record rank sees the rows before the
        # owner check.
        n = enrich(n, inputs["address"], {"otr_address": "address_id"}, ["ward"], distinct=True)
        n = latest_per_key(n, "ssl_info", ["record_date"], list(tie))
        n = _owners(n, inputs, owners_ok, weight)
    else:
        # Same rows in either order (the owner predicate reads owner columns
        # only; both joins' fan-outs multiply), but checking owners first
        # drops rows before the second join's shuffle.
        n = _owners(n, inputs, owners_ok, weight)
        n = enrich(n, inputs["address"], {"otr_address": "address_id"}, ["ward"], distinct=True)
    return n.select(month_end("update_date_time").alias("VACANTPROP_PRODUCTIVEUSE_MONTH"),
                    *NOTICE_COLUMNS, F.col("ward").alias("WARD"), *([weight] if weight else []))


def _owners(n: DataFrame, inputs: Inputs, owners_ok: Column, weight: str | None) -> DataFrame:
    if weight:
        return require_related_weighted(n, inputs["owner_points"], {"ssl_info": "ssl_key"}, owners_ok, weight)
    return require_related(n, inputs["owner_points"], {"ssl_info": "ssl_key"}, owners_ok, columns=["delcode"])


def bases(inputs: Inputs, params: P.MartParams, plan: str = "onepass", tie: tuple[str, ...] = ()
          ) -> dict[str, Base]:
    w = "_w" if plan == "onepass" else None
    s1 = stage_violations(inputs, params, w)
    s2 = stage_vacant_reuse(inputs, params, tie, w)
    kept = [w] if w else []
    abatement = s1.select(F.col("ABATED_MONTH").alias(MONTH), F.col("response_level").alias("Violation_Type"),
                          F.col("grp").alias("Filter_1"), F.col("WARD").alias("Ward"), "SLA_MET_INDICATOR", *kept)
    # Grouped by the raw class (the label is a function of it, no ELSE), as
    # the source does; the mart's conform drops the raw class column.
    vacant = s2.select(F.col("VACANTPROP_PRODUCTIVEUSE_MONTH").alias(MONTH),
                       F.lit("").alias("Violation_Type"),
                       relabel("class_id_from", P.VACANT_CLASS_LABELS).alias("Filter_1"),
                       F.col("WARD").alias("Ward"), "class_id_from", *kept)
    return {"abatement": Base(abatement, w), "vacant": Base(vacant, w)}


def _spec(key, base, section, measure, where=()):
    return MeasureSpec(key=key, base=base, kind="count",
                       labels={"Section": section, "Sub_Section": P.SUMMARY, "Measure_Type": measure},
                       by=DIMS, where=where, denominator=None)


MART = MartSpec(
    name="violations",
    schema=violations_schema,
    distinct=False,
    measures=(
        _spec("viol_abated", "abatement", P.SEC_HOUSING_VIOLATIONS, P.M_VIOLATIONS_ABATED),
        _spec("viol_emergency_30d", "abatement", P.SEC_ABATEMENT_SPEED, P.M_NOIE_30,
              where=(("eq", "Violation_Type", P.EMERGENCY), ("eq", "SLA_MET_INDICATOR", 1))),
        _spec("viol_routine_90d", "abatement", P.SEC_ABATEMENT_SPEED, P.M_NOIR_90,
              where=(("eq", "Violation_Type", P.ROUTINE), ("eq", "SLA_MET_INDICATOR", 1))),
        MeasureSpec(key="viol_vacant_reuse", base="vacant", kind="count",
                    labels={"Section": P.SEC_HOUSING_VIOLATIONS, "Sub_Section": P.SUMMARY,
                            "Measure_Type": P.M_VACANT_REUSE},
                    by=DIMS + ("class_id_from",), denominator=None),
    ),
)
