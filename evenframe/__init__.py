"""Data reconciliation on Spark: compare, profile, stage and check tables."""

from evenframe import functions, operators, plans, sources
from evenframe.operators import (
    align,
    column_count_check,
    diff_rows,
    distinct_key_count,
    duplicate_keys,
    labelled_diff,
    latest_by,
    latest_cdc,
    mismatch_counts,
    mismatching_columns,
    profile,
    profile_table,
    row_count_check,
    run_profile_sql,
    stage,
    stage_table,
    staged_diff,
)
from evenframe.plans import LatestBy, TableSpec, compare, compare_profiles, run_suite

__all__ = [
    "functions", "operators", "plans", "sources",
    "align", "column_count_check", "diff_rows", "distinct_key_count",
    "duplicate_keys", "labelled_diff", "latest_by", "latest_cdc",
    "mismatch_counts", "mismatching_columns", "profile", "profile_table",
    "row_count_check", "run_profile_sql", "stage", "stage_table", "staged_diff",
    "LatestBy", "TableSpec", "compare", "compare_profiles", "run_suite",
]
