"""Business parameters of the marts.

The lists and labels below are fixed values: they must equal the
reference's for the same results, so they are stated as text, in the
reference's order.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# ---- fixed values (must equal the reference) -------------------------------

# Violations: abatement statuses that count as resolved.
ABATED_STATUSES = (
    "Abated", "Abatement Post IR (INSP)", "Abatement Post IR (NO INSP)", "Abatement Post NOI-ART",
    "Abatement Post NOI-By DCRA", "Abatement Post NOI-ICA (INSP)", "Abatement Post NOI-ICA (NO INSP)",
    "Abatement Post NOI-OCI", "Abatement Post NOI-OGC", "Abated - Post NOI", "No Violations Found",
)
VIOLATION_GROUPS = ("Housing", "Proactive")
RESPONSE_LEVELS = ("Emergency", "Routine")
CANCELLED_CASE_STATUSES = (
    "Cancelled", "Cancelled - Error", "Cancelled - Refusing Entry", "Cancelled-Administrative Error",
    "Case Canceled", "Case Cancelled",
)
EMERGENCY = "Emergency"
ROUTINE = "Routine"
DEADLINE_DAYS = {"Emergency": 30}
DEFAULT_DEADLINE_DAYS = 90

# Vacant properties returned to use.
OCCUPIED_WORKFLOW_STATUSES = ("Occupied per Inspection", "Occupied Designation Approved", "Occupied",
                              "Closed - Occupied")
UPDATE_SUCCESS = "Success"
VACANT_FROM_CLASSES = ("Class 3", "Class 4")
VACANT_TO_CLASSES = ("Class 2", "Class 1")
VACANT_CLASS_LABELS = {"Class 3": "Buildings", "Class 4": "Blighted"}
OWNER_EXCLUDED_CODE = "Y"

# Permits.
PERMIT_TYPE_CONSTRUCTION = "Construction"
UPLOAD_GROUP = "Applicant"
UPLOAD_TASK = "ApplicantUpload"
UPLOAD_STATUS = "Complete"
LCC_JOB_CLASSES = ("AA-C", "A-C", "V-C")
LCC_PERMIT_TYPES = ("Addition Alteration Repair Permit", "Alteration and Repair Permit", "New Building Permit")
DANGER_CLOSE_JOB_CLASSES = ("AA-C", "A-C", "V-C")
DANGER_CLOSE_PERMIT_TYPES = (
    "Alteration and Repair Permit", "Addition Alteration Repair Permit", "New Building Permit",
    "Demolition Permit", "Excavation Only Permit", "Civil Plans", "Historic Property - Special Permit",
    "Raze Permit", "Retaining Wall Permit", "Garage Permit", "Foundation Only Permit",
)
REVIEW_CYCLE_LIMIT = 2

# Inspections.
INSPECTION_DONE_STATUSES = ("Completed",)
EXCLUDED_DIVISIONS = ("3RDPARTY",)
EXCLUDED_INSPECTOR_GROUPS = ("Historical", "OIS", "Third Party")
NO_ACCESS_PREFIX = "NO ACCESS"
SLA_BUSINESS_DAYS = 10
HOUSING = "Housing"
FOLLOW_UP_SPELLINGS = {"Follow Up Inspection": "Follow-Up Inspection",
                       "Follow-Up Inspection": "Follow-Up Inspection"}
PERCENTILE = 0.9
# Days between two dates of the years 1 to 9999, weekends left out, are fewer than 2 ** 22 either way.
DAY_BITS = 23

# Labels of the long-format rows.
SEC_HOUSING_VIOLATIONS = "Housing Code Violations"
SEC_ABATEMENT_SPEED = "Abatement Speed"
SUMMARY = "Summary"
M_VIOLATIONS_ABATED = "Violations Abated"
M_NOIE_30 = "NOI-E Abated within 30 Days"
M_NOIR_90 = "NOI-R Abated within 90 Days"
M_VACANT_REUSE = "Vacant Properties Returned to Productive Use"

SEC_PERMIT_VOLUME = "Permit Volume"
SEC_PERMIT_SPEED = "Permit Speed"
SUB_LCC = "Large Commercial Construction"
SUB_DANGER_CLOSE = "Danger Close"
M_PERMITS_ISSUED = "No of Permits Issued"
M_APPLICATIONS = "No of Permit Applications"
M_TWO_CYCLES = "Issued in 2 Review Cycles or Fewer"
M_TOTAL_DAYS = "Total Business Days"
M_P90_ISSUED = "90% Permits Issued Within"

SEC_INSPECTION_VOLUME = "Inspection Volume"
SEC_INSPECTION_SPEED = "Inspection Speed"
SUB_COMPLETED = "Number of Inspections Completed"
M_COMPLETED = "Number of Inspections Completed"
SUB_NO_ACCESS = "Percent No Access Result"
M_NO_ACCESS = "Percent No Access"
SUB_TEN_DAYS = "Taking Place in 10 Business Days"
M_TEN_DAYS = "Number of 10 Day Completion Inspections"
SUB_P90 = "90th Percentile"
M_P90 = "90th Percentile"

# ---- per-refresh parameters -------------------------------------------------


@dataclass(frozen=True)
class MartParams:
    """One refresh: ``as_of`` replaces every "now" of the reference."""

    as_of: dt.datetime
    calendar_start: dt.date = dt.date(2024, 10, 1)
    min_fiscal_year: int = 2024
    permit_lower_bound: dt.datetime = dt.datetime(2022, 10, 1)   # exclusive
    inspection_lower_bound: dt.datetime = dt.datetime(2022, 10, 1)  # inclusive
    fy_start_month: int = 10
    keep_latest_notice: bool = False   # the reference leaves this filter off
    value_type: str = "decimal(9,2)"
    # Text compares without case and blanks at the end, in lists, joins and group keys.
    ignore_case: bool = False
    # Days off besides weekends; days outside the list are judged by their weekday.
    holidays: tuple[dt.date, ...] = ()
    # One-pass plan: reliably checkpoint each (small) histogram into
    # spark.checkpoint.dir, so a lost executor in a later stage never
    # rescans the base tables.
    checkpoint_histograms: bool = False

    def with_(self, **kw) -> MartParams:
        return replace(self, **kw)


# Some days off within the span of the adapters' inspections.
TEST_HOLIDAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 1, 16), dt.date(2024, 2, 19), dt.date(2024, 5, 27))

# Parameters of the test adapters (FIXTURES.md): the synthetic data spans
# 1995-2001 for orders and January 2024 onward for events.
TEST_PARAMS = MartParams(
    as_of=dt.datetime(2001, 8, 15, 0, 0, 0),
    calendar_start=dt.date(1996, 10, 1),
    min_fiscal_year=1997,
    permit_lower_bound=dt.datetime(1996, 10, 1),
    inspection_lower_bound=dt.datetime(2024, 1, 10),
)
