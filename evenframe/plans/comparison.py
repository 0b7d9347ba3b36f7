"""Reconciliation of an expected and an actual frame into one report row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenframe.functions.columns import actual_name, named, one_row, position_of
from evenframe.operators.alignment import (
    STRUCTURE_ERROR,
    Aligned,
    StructureError,
    align,
    project,
)
from evenframe.operators.latest import SALTS, distinct_key_count, latest_by
from evenframe.operators.mismatch import (
    internal_keys,
    mismatching_columns,
    one_row_mismatches,
)
from evenframe.operators.counting import (
    N_ACTUAL,
    N_EXPECTED,
    of_side,
    row_totals,
    surplus,
    tally,
    total,
    totals,
)
from evenframe.plans import reports as R

MODES = ("two_way", "one_way")
ROW_COUNT = "TOTAL_ROW_COUNT"


@dataclass(frozen=True)
class LatestBy:
    """Keep the rows of the greatest ``order`` per key, all ties included.

    ``salts`` spreads a key with very many tied rows over so many tasks.
    """

    keys: Sequence[str]
    order: str
    salts: int = SALTS


def compare(
    expected: DataFrame,
    actual: DataFrame,
    table: str = "",
    mode: str = "two_way",
    keys: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    latest: LatestBy | None = None,
    by: str = "position",
    decimals: int | None = None,
) -> DataFrame:
    """Compare two frames as multisets of rows; the result is one report row.

    ``two_way`` counts the differences in both directions. With ``keys`` it
    also counts the distinct keys of each side, for information only.
    ``one_way`` says whether the actual side lacks expected rows and names the
    mismatching columns, per key where ``keys`` are given.

    ``columns`` projects both sides to a fixed list; sides of unequal column
    counts still fail. ``latest`` drops older
    versions from the actual side first, for sources that keep only the newest.
    Nothing runs before the result is used, and both sides are read once.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    counts = len(expected.columns), len(actual.columns)
    try:
        if latest is not None:
            if columns is not None:
                actual = project(actual, columns)
            actual = latest_by(actual, latest.keys, latest.order, ties="all", salts=latest.salts)
        sides = align(expected, actual, columns, by, decimals, maps="entries")
    except StructureError as error:
        return _structure_error(expected, actual, table, mode, keys, str(error), counts)
    if mode == "one_way":
        return _one_way(sides, table, keys, counts)
    return _two_way(sides, table, keys, counts)


def compare_totals(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    by: str = "position",
    decimals: int | None = None,
) -> DataFrame:
    """The numbers behind a two-way report as one typed row."""
    sides = align(expected, actual, columns, by, decimals, maps="entries")
    return totals(tally(sides), internal_keys(sides, keys))


def _column_counts(counts: tuple[int, int]) -> dict[str, Column]:
    """Columns of both sides before any projection."""
    return {"Expected columns": F.lit(counts[0]), "Actual columns": F.lit(counts[1])}


def _details(sides: Aligned, counts: tuple[int, int]) -> list[str]:
    if counts[0] == counts[1]:
        return sides.notes
    return [f"{counts[0]} and {counts[1]} columns before the projection", *sides.notes]


def _two_way(
    sides: Aligned, table: str, keys: Sequence[str] | None, counts: tuple[int, int]
) -> DataFrame:
    numbers = totals(tally(sides), internal_keys(sides, keys))
    passed = (
        R.same(("expected_rows", "actual_rows"))
        & (F.col("expected_minus_actual") == 0)
        & (F.col("actual_minus_expected") == 0)
        & F.lit(counts[0] == counts[1])
    )
    values = {
        "Table": F.lit(table),
        "Status": R.status(passed),
        "Details": F.lit("; ".join(_details(sides, counts))),
        "Expected rows": F.col("expected_rows"),
        "Actual rows": F.col("actual_rows"),
        "Expected minus Actual count": F.col("expected_minus_actual"),
        "Actual minus Expected count": F.col("actual_minus_expected"),
        **_column_counts(counts),
    }
    if not keys:
        return R.report_row(numbers, "rows", values)
    values["Latest Distinct Expected Count"] = F.col("expected_keys")
    values["Latest Distinct Actual Count"] = F.col("actual_keys")
    return R.report_row(numbers, "keys", values)


def _one_way(
    sides: Aligned, table: str, keys: Sequence[str] | None, counts: tuple[int, int]
) -> DataFrame:
    counted = tally(sides)
    row = one_row(
        [
            totals(counted),
            mismatching_columns(sides, keys, name="mismatching", counted=counted),
        ]
    )
    return _one_way_report(row, sides, table, counts)


NO_ROW_COUNT = "a profile has no row count"


def _one_way_report(
    row: DataFrame,
    sides: Aligned,
    table: str,
    counts: tuple[int, int],
    uncounted: Column | None = None,
) -> DataFrame:
    """``uncounted`` tells that a row count is missing, which fails whatever else agrees."""
    lacks_nothing = F.col("expected_minus_actual") == 0
    uncounted = F.lit(False) if uncounted is None else uncounted
    equal_counts = F.lit(counts[0] == counts[1])
    notes = F.lit("; ".join(_details(sides, counts)))
    why = F.lit("; ".join([NO_ROW_COUNT, *_details(sides, counts)]))
    values = {
        "Table": F.lit(table),
        "Status": R.status(
            R.same(("expected_rows", "actual_rows"))
            & lacks_nothing
            & equal_counts
            & ~uncounted
        ),
        "Details": F.when(uncounted, why).otherwise(notes),
        "Expected rows": F.col("expected_rows"),
        "Actual rows": F.col("actual_rows"),
        "Data Comparison": F.when(lacks_nothing, R.MATCHING).otherwise(R.MISMATCHING),
        "Mismatching columns": F.when(
            ~lacks_nothing, F.col("mismatching")
        ).otherwise("NA"),
        **_column_counts(counts),
    }
    return R.report_row(row, "profile", values)


def _structure_error(
    expected: DataFrame,
    actual: DataFrame,
    table: str,
    mode: str,
    keys: Sequence[str] | None,
    problem: str,
    counts: tuple[int, int],
) -> DataFrame:
    """Rows and columns are still counted, the differences are not."""
    values = {
        "Table": F.lit(table),
        "Status": F.lit(R.FAILED),
        "Details": F.lit(f"{STRUCTURE_ERROR}: {problem}"),
        "Expected rows": F.col("expected_rows"),
        "Actual rows": F.col("actual_rows"),
        **_column_counts(counts),
    }
    parts = [row_totals(expected, actual)]
    if mode == "one_way":
        return R.report_row(parts[0], "profile", values)
    if not keys:
        return R.report_row(parts[0], "rows", values)
    for side, name, shown in (
        (expected, "expected_keys", "Latest Distinct Expected Count"),
        (actual, "actual_keys", "Latest Distinct Actual Count"),
    ):
        try:
            counted = distinct_key_count(side, keys)
        except ValueError:  # this side lacks a key column
            continue
        parts.append(counted.select(F.col("distinct_key_count").alias(name)))
        values[shown] = F.col(name)
    return R.report_row(one_row(parts), "keys", values)


def compare_profiles(
    expected: DataFrame, actual: DataFrame, table: str = "", by: str = "position"
) -> DataFrame:
    """Compare two one-row profiles; row counts come from the profiles."""
    missing = []
    for side, df in (("expected", expected), ("actual", actual)):
        try:
            actual_name(df, ROW_COUNT)
        except ValueError:
            missing.append(side)
    if missing:
        return _no_row_count(expected, actual, table, missing)
    try:
        sides = align(expected, actual, by=by)
    except StructureError as error:
        row = one_row([_row_count(expected, "expected"), _row_count(actual, "actual")])
        return R.report_row(
            row,
            "profile",
            {
                "Table": F.lit(table),
                "Status": F.lit(R.FAILED),
                "Details": F.lit(f"{STRUCTURE_ERROR}: {error}"),
                "Expected rows": F.col("expected_rows"),
                "Actual rows": F.col("actual_rows"),
                "Expected columns": F.lit(len(expected.columns)),
                "Actual columns": F.lit(len(actual.columns)),
            },
        )
    rows_e = position_of(expected, ROW_COUNT)
    rows_a = rows_e if by == "name" else position_of(actual, ROW_COUNT)
    row = tally(sides).agg(
        total(surplus(N_EXPECTED, N_ACTUAL)).alias("expected_minus_actual"),
        one_row_mismatches(sides).alias("mismatching"),
        of_side(N_EXPECTED, f"c{rows_e}").cast("string").alias("expected_rows"),
        of_side(N_ACTUAL, f"c{rows_a}").cast("string").alias("actual_rows"),
    )
    uncounted = F.col("expected_rows").isNull() | F.col("actual_rows").isNull()
    counts = len(expected.columns), len(actual.columns)
    return _one_way_report(row, sides, table, counts, uncounted)


def _row_count(df: DataFrame, side: str) -> DataFrame:
    name = actual_name(df, ROW_COUNT)
    return df.agg(F.max(named(name)).cast("string").alias(f"{side}_rows"))


def _no_row_count(
    expected: DataFrame, actual: DataFrame, table: str, missing: list[str]
) -> DataFrame:
    details = f"{ROW_COUNT} not found on the {' and '.join(missing)} side"
    row = R.failure_row(expected.sparkSession, "profile", table, R.FAILED, details)
    return row.withColumns(
        {
            "Expected columns": F.lit(str(len(expected.columns))),
            "Actual columns": F.lit(str(len(actual.columns))),
        }
    )
