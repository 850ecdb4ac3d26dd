"""Text as a case-insensitive source compares it, for whole marts.

A source with a case-insensitive collation takes 'Abated', 'ABATED' and
'abated  ' for one value: in lists, joins, group keys and DISTINCT alike.
``folded`` gives every source of a refresh one spelling a value, so that all
operators after it compare plain text and agree:

- a value that a parameter list names is spelled as it is there;
- other values of columns that marts show are spelled as most rows of the
  source spell them (of equally frequent spellings the first in byte order),
  without blanks at the end;
- any other text, and text keys, are lower case without blanks at the end.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kpimart.operators.scope import text_key
from kpimart.plans import params as P
from kpimart.plans.inputs import Inputs, Lazy
from kpimart.sources.schemas import KEYS, SOURCES

# Which lists a column's values are compared with.
LISTED = {
    "violations": {"grp": P.VIOLATION_GROUPS, "response_level": P.RESPONSE_LEVELS, "cap_status": P.CANCELLED_CASE_STATUSES,
                   "abatement_status": P.ABATED_STATUSES},
    "class_notice": {"workflow_status": P.OCCUPIED_WORKFLOW_STATUSES, "update_status": (P.UPDATE_SUCCESS,),
                     "class_id_from": P.VACANT_FROM_CLASSES + P.VACANT_TO_CLASSES,
                     "class_id_to": P.VACANT_FROM_CLASSES + P.VACANT_TO_CLASSES},
    "owner_points": {"delcode": (P.OWNER_EXCLUDED_CODE,)},
    "permits": {"permit_type": (P.PERMIT_TYPE_CONSTRUCTION,), "job_class": P.LCC_JOB_CLASSES + P.DANGER_CLOSE_JOB_CLASSES,
                "permit_types": P.LCC_PERMIT_TYPES + P.DANGER_CLOSE_PERMIT_TYPES},
    "uploads": {"group_name": (P.UPLOAD_GROUP,), "task_name": (P.UPLOAD_TASK,), "task_status": (P.UPLOAD_STATUS,),
                "job_class": P.LCC_JOB_CLASSES + P.DANGER_CLOSE_JOB_CLASSES,
                "permit_types": P.LCC_PERMIT_TYPES + P.DANGER_CLOSE_PERMIT_TYPES},
    "inspections": {"status_des": P.INSPECTION_DONE_STATUSES, "division_code": P.EXCLUDED_DIVISIONS,
                    "inspector_group": P.EXCLUDED_INSPECTOR_GROUPS, "grp": (P.HOUSING,),
                    "action_type": tuple(P.FOLLOW_UP_SPELLINGS)},
}
# Columns that marts show.
SHOWN = {"address": ("ward",), "permits": ("job_class", "permit_types"), "uploads": ("job_class", "permit_types"),
         "inspections": ("grp", "action_type", "ward")}


def listed_spelling(c: Column, values: Iterable[str], other: Column) -> Column:
    """The listed spelling of ``c``, or ``other``."""
    spelled = {v.rstrip(" ").lower(): v for v in values}
    out = None
    for key, value in spelled.items():
        cond = text_key(c) == key
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return other if out is None else out.otherwise(other)


def usual_spellings(df: DataFrame, column: str) -> DataFrame:
    """(__key, __usual): the spelling that most rows of ``df`` have, by what the column compares by."""
    counted = df.groupBy(F.rtrim(column).alias("s")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("s").isNotNull())
    usual = counted.groupBy(F.lower("s").alias("__key")).agg(F.min(F.struct((-F.col("n")).alias("n"), "s")).alias("m"))
    return usual.select("__key", F.col("m.s").alias("__usual"))


def fold_source(name: str, df: DataFrame) -> DataFrame:
    """One spelling a value in every text column of a source.

    The spellings of a shown column are counted over the source (partial on
    every task) and joined back; Spark broadcasts them where they measure
    small.
    """
    listed, shown, columns = LISTED.get(name, {}), SHOWN.get(name, ()), df.columns
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)
            and (f.name in KEYS or f.name in SOURCES[name].fieldNames())]
    out = df
    for c in text:
        if c in shown:
            usual = usual_spellings(df, c).withColumnRenamed("__usual", f"__usual_{c}").withColumnRenamed("__key", f"__key_{c}")
            out = out.join(usual, text_key(F.col(c)) == F.col(f"__key_{c}"), "left")
    spelled = {c: listed_spelling(F.col(c), listed.get(c, ()), F.col(f"__usual_{c}") if c in shown else text_key(F.col(c)))
               for c in text}
    return out.select(*[spelled[c].alias(c) if c in spelled else F.col(c) for c in columns])


def folded(inputs: Inputs) -> Inputs:
    """The same inputs with one spelling a value; sources are folded when first asked for."""
    makers = {name: (lambda n=name: fold_source(n, inputs[n]) if n in SOURCES else inputs[n]) for name in inputs.tables}
    return Inputs(Lazy(makers), lambda: (inputs.calendar, inputs.cal_rows))
