"""Writers for reports, profiles, texts and staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenframe.sources.delimited import ENCODING, ESCAPE

NO_SUCCESS_FILE = ("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")


def write_report(report: DataFrame, path: str) -> None:
    """Append the report rows, one per table, as one CSV file with header."""
    (
        report.coalesce(1)
        .write.mode("append")
        .option(*NO_SUCCESS_FILE)
        .option("header", True)
        .csv(path)
    )


def write_profile(profile: DataFrame, path: str) -> None:
    """Replace the profile row: one CSV file, header, every field quoted."""
    (
        profile.coalesce(1)
        .write.mode("overwrite")
        .option(*NO_SUCCESS_FILE)
        .option("header", True)
        .option("quote", '"')
        .option("quoteAll", True)
        .csv(path)
    )


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Replace the folder by one text file holding ``text``."""
    (
        spark.createDataFrame([(text,)], "text string")
        .coalesce(1)
        .write.mode("overwrite")
        .option(*NO_SUCCESS_FILE)
        .text(path)
    )


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", line_sep: str | None = None
) -> None:
    """Replace a tree of delimited files with header, one file per task."""
    write = (
        df.write.mode("overwrite")
        .option(*NO_SUCCESS_FILE)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", ESCAPE)
        .option("encoding", ENCODING)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if line_sep is not None:
        write = write.option("lineSep", line_sep)
    write.csv(path)


def write_staged(staged: DataFrame, path: str) -> DataFrame:
    """Replace a staged table, written by all tasks, and return it as stored."""
    staged.write.mode("overwrite").option(*NO_SUCCESS_FILE).parquet(path)
    return staged.sparkSession.read.schema(staged.schema).parquet(path)
