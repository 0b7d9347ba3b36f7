from evenframe.plans.comparison import (
    LatestBy,
    compare,
    compare_profiles,
    compare_totals,
)
from evenframe.plans.reports import NOT_FOUND, REPORT_COLUMNS, failure_row
from evenframe.plans.session import session_settings, shuffle_partitions
from evenframe.plans.suite import ProfileSpec, TableSpec, profile_suite, run_suite

__all__ = [
    "LatestBy", "compare", "compare_profiles", "compare_totals",
    "NOT_FOUND", "REPORT_COLUMNS", "failure_row",
    "session_settings", "shuffle_partitions",
    "ProfileSpec", "TableSpec", "profile_suite", "run_suite",
]
