"""Report layouts: one row per table, every column text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions.columns import named

# Verdicts and texts of the reports.
PASSED, FAILED = "Passed", "Failed"
NOT_FOUND = "Actual or expected data not found"
MATCHING, MISMATCHING = "Data matching", "Data mismatching"

# Report columns, and the marks of values that were not computed.
REPORT_COLUMNS = {
    "keys": {
        "Status": None,
        "Details": "",
        "Expected rows": "-1",
        "Actual rows": "-2",
        "Expected minus Actual count": "-3",
        "Actual minus Expected count": "-3",
        "Expected columns": "-4",
        "Actual columns": "-5",
        "Latest Distinct Expected Count": "-6",
        "Latest Distinct Actual Count": "-6",
    },
    "rows": {
        "Table": None,
        "Status": None,
        "Details": "",
        "Expected rows": "-1",
        "Actual rows": "-2",
        "Expected columns": "-5",
        "Actual columns": "-6",
        "Expected minus Actual count": "-3",
        "Actual minus Expected count": "-4",
    },
    "profile": {
        "Table": None,
        "Status": None,
        "Details": "",
        "Expected rows": "-1",
        "Actual rows": "-2",
        "Expected columns": "-4",
        "Actual columns": "-5",
        "Data Comparison": "-3",
        "Mismatching columns": "NA",
    },
}


def report_schema(layout: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in REPORT_COLUMNS[layout]]
    )


def report_row(df: DataFrame, layout: str, values: Mapping[str, Column]) -> DataFrame:
    """Select the report columns as text; values not given show their mark."""
    return df.select(
        *[
            values.get(name, F.lit(mark)).cast("string").alias(name)
            for name, mark in REPORT_COLUMNS[layout].items()
        ]
    )


def failure_row(
    spark: SparkSession, layout: str, table: str, status: str, details: str
) -> DataFrame:
    """The report row of a table that could not be compared."""
    known = {"Table": table, "Status": status, "Details": details}
    row = tuple(known.get(n, mark) for n, mark in REPORT_COLUMNS[layout].items())
    return spark.createDataFrame([row], report_schema(layout))


def same(*pairs: tuple[str, str]) -> Column:
    verdict = F.lit(True)
    for left, right in pairs:
        verdict = verdict & named(left).eqNullSafe(named(right))
    return verdict


def status(passed: Column) -> Column:
    return F.when(passed, PASSED).otherwise(FAILED)
