from evenframe.operators.alignment import STRUCTURE_ERROR, Aligned, StructureError, align, project
from evenframe.operators.checks import (
    column_count_check,
    duplicate_keys,
    row_count_check,
    staged_diff,
)
from evenframe.operators.latest import (
    OPERATION_PRIORITY,
    distinct_key_count,
    latest_by,
    latest_cdc,
)
from evenframe.operators.mismatch import mismatch_counts, mismatching_columns
from evenframe.operators.profiles import profile, profile_table, run_profile_sql
from evenframe.operators.staging import (
    choose_area,
    has_pii,
    header_frame,
    key_fields,
    latest_staged,
    map_header,
    stage,
    stage_table,
    target_fields,
)
from evenframe.operators.counting import diff_rows, labelled_diff, tally, totals

__all__ = [
    "STRUCTURE_ERROR", "Aligned", "StructureError", "align", "project",
    "column_count_check", "duplicate_keys", "row_count_check", "staged_diff",
    "OPERATION_PRIORITY", "distinct_key_count", "latest_by", "latest_cdc",
    "mismatch_counts", "mismatching_columns",
    "profile", "profile_table", "run_profile_sql",
    "choose_area", "has_pii", "header_frame", "key_fields", "latest_staged",
    "map_header", "stage", "stage_table", "target_fields",
    "diff_rows", "labelled_diff", "tally", "totals",
]
