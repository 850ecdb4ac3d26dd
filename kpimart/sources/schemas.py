"""The declared columns of each source table; loaders and adapters end in them."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

_TYPES = {"long": LongType(), "string": StringType(), "timestamp_ntz": TimestampNTZType()}
SOURCES = {name: StructType([StructField(c, _TYPES[t]) for c, t in (f.split() for f in fields.split(", "))])
           for name, fields in {
    "address": "b1_alt_id long, address_id long, ward string",
    "violations": "cap_id long, grp string, response_level string, service_status string, "
                  "cap_status string, abatement_status string, service_date timestamp_ntz, abated_date timestamp_ntz",
    "class_notice": "ssl_info long, otr_address long, record_date timestamp_ntz, update_date_time timestamp_ntz, "
                    "workflow_status string, update_status string, class_id_from string, class_id_to string",
    "owner_points": "ssl_key long, delcode string",
    "permits": "cap_id long, issued_date timestamp_ntz, permit_type string, job_class string, permit_types string, "
               "review_cycles long, business_days long",
    "cap_apo": "b1_alt_id long",
    "uploads": "task_date timestamp_ntz, upload_id long, group_name string, task_name string, task_status string, "
               "job_class string, permit_types string",
    "inspections": "cap_id long, completed_date timestamp_ntz, created_date timestamp_ntz, grp string, "
                   "action_type string, cap_status string, status_des string, division_code string, "
                   "inspector_group string, ward string",
}.items()}
# Keys are whatever the source has: they are joined and grouped by, never computed with.
KEYS = {"cap_id", "b1_alt_id", "address_id", "otr_address", "ssl_info", "ssl_key", "upload_id"}


# What a source may hold where a type is declared: nothing is lost on the way. Narrower whole numbers widen,
# a date is its midnight, whole numbers have one text.
WIDENS = {
    "bigint": ("tinyint", "smallint", "int", "bigint"),
    "string": ("string", "tinyint", "smallint", "int", "bigint"),
    "timestamp_ntz": ("timestamp_ntz", "date", "timestamp"),
}


def refused(name: str, df: DataFrame) -> dict[str, tuple[str, str]]:
    """Declared columns of a source whose type does not widen to the declared one: (held, declared) by column."""
    held = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = {}
    for f in SOURCES[name].fields:
        kind = held.get(f.name)
        kind = "string" if kind and kind.startswith(("varchar", "char", "string")) else kind
        declared = f.dataType.simpleString()
        if kind is not None and f.name not in KEYS and kind not in WIDENS[declared]:
            out[f.name] = (kind, declared)
    return out


def as_declared(name: str, df: DataFrame, parse: Collection[str] = (), rejects: Observation | None = None) -> DataFrame:
    """The declared columns first and in their types (keys keep theirs), then any others.

    A column that does not widen to its type (text for a number, a number with
    digits behind the point for a whole one, ..) raises before any job,
    unless ``parse`` names it: then each value is converted, and a row with a
    value that has no exact conversion is left out. ``rejects`` counts these
    rows when a job runs: ``rows`` and, by column, ``bad_<column>``.
    """
    fields = SOURCES[name].fields
    declared = {f.name for f in fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(declared - set(have))
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    wrong = refused(name, df)
    unknown = sorted(set(parse) - set(wrong))
    if unknown:
        raise ValueError(f"{name}: {unknown} need no parsing")
    strict = [f"{c} holds {held}, declared is {want}" for c, (held, want) in wrong.items() if c not in parse]
    if strict:
        raise TypeError(f"{name}: {'; '.join(strict)}")
    bad = {c: _converted(F.col(c), *wrong[c]).isNull() & F.col(c).isNotNull() for c in parse}
    if bad:
        any_bad = reduce(Column.__or__, bad.values())
        if rejects is not None:
            df = df.observe(rejects, F.count_if(any_bad).alias("rows"), *[F.count_if(b).alias(f"bad_{c}") for c, b in bad.items()])
        df = df.filter(~any_bad)
    cols = []
    for f in fields:
        c = F.col(f.name)
        if f.name in parse:
            c = _converted(c, *wrong[f.name])
        elif f.name not in KEYS and have[f.name] != f.dataType:
            c = c.cast(f.dataType.simpleString())
        cols.append(c.alias(f.name))
    return df.select(*cols, *[c for c in df.columns if c not in declared])


def _converted(c: Column, held: str, declared: str) -> Column:
    """The value in the declared type, NULL where that would not be the same value."""
    value = (F.trim(c) if held == "string" else c).try_cast(declared)
    if held == "string" or declared == "string":
        return value
    return F.when(value.cast(held) == c, value)
