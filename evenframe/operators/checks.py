"""Checks on a loaded table; an empty result means passed where noted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenframe.functions.columns import actual_name, named
from evenframe.operators.alignment import Aligned, align
from evenframe.operators.staging import latest_staged
from evenframe.operators.counting import labelled_diff

DUPLICATES = "Duplicates"
SYSTEM_COLUMN = "SRC_SYS_COD"


def duplicate_keys(
    df: DataFrame, keys: Sequence[str], copies: str | None = None
) -> DataFrame:
    """Keys that occur more than once, labelled; empty means passed.

    ``copies`` names a column for the number of rows of the key.
    """
    names = [actual_name(df, k) for k in dict.fromkeys(keys)]
    grouped = df.groupBy(*[named(k) for k in names]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    columns = [F.lit(DUPLICATES).alias("check"), *[named(k) for k in names]]
    if copies:
        columns.append(F.col("__copies").alias(copies))
    return grouped.where(F.col("__copies") > 1).select(*columns)


def column_count_check(
    metadata: DataFrame,
    table: str,
    header: DataFrame,
    table_column: str = "SOURCE_TABLE",
    field_column: str = "SOURCE_FIELD",
) -> DataFrame:
    """The registered column count where it differs from the file's; empty passes."""
    registered = metadata.where(named(table_column) == F.upper(F.lit(table))).agg(
        F.count_distinct(named(field_column)).alias("actual_col_cnt")
    )
    in_file = header.agg(F.count(F.lit(1)).alias("expected_col_cnt"))
    return registered.subtract(in_file)


def row_count_check(staged: DataFrame, target: DataFrame) -> DataFrame:
    """The staged row count where it differs from the target's; empty passes."""
    rows = F.count(F.lit(1)).alias("counts")
    return latest_staged(staged).agg(rows).subtract(target.agg(rows))


def staged_diff(
    staged: DataFrame, target: DataFrame, columns: Sequence[str], side: str = "side"
) -> DataFrame:
    """Distinct rows of the target (ACTUAL) or of the latest staged rows (EXPECTED)
    that the other one lacks; empty passes."""
    sides: Aligned = align(latest_staged(staged), target, columns=columns)
    return labelled_diff(sides, side)
