from evenframe.functions.columns import named, row_tie_break
from evenframe.functions.statistics import (
    decimal_sum,
    distinct_count,
    flag_sum,
    text_length,
    plain_sum,
)

__all__ = [
    "named",
    "row_tie_break",
    "decimal_sum",
    "distinct_count",
    "flag_sum",
    "text_length",
    "plain_sum",
]
