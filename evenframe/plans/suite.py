"""Many tables, one report row each."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from evenframe.operators.profiles import profile_table
from evenframe.plans import reports as R
from evenframe.plans.comparison import compare, compare_profiles
from evenframe.sources.sinks import write_profile

log = logging.getLogger(__name__)

Reader = Callable[[], DataFrame]
TABLES_AT_ONCE = 4


@dataclass(frozen=True)
class TableSpec:
    """One table of a suite: how to read both sides and how to compare them.

    ``options`` are those of :func:`evenframe.plans.comparison.compare`; with
    ``profiles`` the sides are one-row profiles.
    """

    table: str
    expected: Reader
    actual: Reader
    options: Mapping = field(default_factory=dict)
    profiles: bool = False

    @property
    def layout(self) -> str:
        if self.profiles or self.options.get("mode") == "one_way":
            return "profile"
        return "keys" if self.options.get("keys") else "rows"


def run_suite(
    spark: SparkSession, specs: Sequence[TableSpec], at_once: int = TABLES_AT_ONCE
) -> DataFrame:
    """Report over all tables, in the given order.

    Each table is its own Spark job, so a table that fails leaves the others
    alone; some run side by side to keep the cluster busy. The driver holds
    one short text row per table.
    """
    layouts = {spec.layout for spec in specs}
    if len(layouts) != 1:
        raise ValueError(f"a suite needs one report layout, not {sorted(layouts)}")
    layout = layouts.pop()
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        rows = list(pool.map(lambda spec: _report_row(spark, spec), specs))
    return spark.createDataFrame(rows, R.report_schema(layout))


def _report_row(spark: SparkSession, spec: TableSpec):
    def failure(status: str, error: Exception):
        message = _message(error)
        log.warning("table %s: %s", spec.table, message)
        return R.failure_row(spark, spec.layout, spec.table, status, message).first()

    try:
        expected, actual = spec.expected(), spec.actual()
    except Exception as error:  # missing path, unreachable database
        return failure(R.NOT_FOUND, error)
    try:
        if spec.profiles:
            report = compare_profiles(expected, actual, spec.table, **spec.options)
        else:
            report = compare(expected, actual, spec.table, **spec.options)
        return report.first()
    except Exception as error:
        return failure(R.FAILED, error)


def _message(error: Exception) -> str:
    """The whole text of the error, or its kind where it has none."""
    return str(error).strip() or type(error).__name__


@dataclass(frozen=True)
class ProfileSpec:
    """One table to profile: how to read it and its dictionary rows.

    ``options`` are those of
    :func:`evenframe.operators.profiles.profile_table`.
    """

    table: str
    frame: Reader
    dictionary: DataFrame
    options: Mapping = field(default_factory=dict)


def profile_suite(
    spark: SparkSession,
    specs: Sequence[ProfileSpec],
    path_of: Callable[[str], str],
    at_once: int = TABLES_AT_ONCE,
) -> DataFrame:
    """Profile each table and write it to ``path_of(table)``.

    A table that fails is logged and passed over. The result has one row per
    table: ``Table, Status, Details``.
    """

    def write(spec: ProfileSpec) -> tuple[str, str, str]:
        try:
            profile = profile_table(spec.frame(), spec.dictionary, **spec.options)
            write_profile(profile, path_of(spec.table))
        except Exception as error:
            log.warning("table %s: %s", spec.table, _message(error))
            return spec.table, R.FAILED, _message(error)
        return spec.table, R.PASSED, ""

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        rows = list(pool.map(write, specs))
    return spark.createDataFrame(rows, "Table string, Status string, Details string")
