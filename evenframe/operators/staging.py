"""Normalised staging table driven by a data dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions.columns import actual_name, named
from evenframe.operators.latest import latest_by

# Target types and the text that stands for a missing value.
TEXT_TYPES = ("VARCHAR", "STRING")
FLAG_TYPES = ("BOOLEAN",)
NUMBER_TYPES = ("DECIMAL", "SMALLINT", "NUMBER", "INTEGER", "BIGINT", "DOUBLE")
DATE_TYPES = ("DATE",)
TIMESTAMP_TYPES = ("TIMESTAMP",)
NO_TEXT = "#"
NO_FLAG = "false"
NO_NUMBER = 0
NO_DATE = "1000-01-01"
NO_TIMESTAMP = "1000-01-01 00:00:00.000"
UNKNOWN_COLUMN = "Unknown_Column_"
PRIMARY = "primary"
PII = "PII"
CHANGE_COLUMN = "SYS_MST_DAT"
FILE_COLUMN = "filename"
RANK_COLUMN = "cnt"

KNOWN_TYPES = TEXT_TYPES + FLAG_TYPES + NUMBER_TYPES + DATE_TYPES + TIMESTAMP_TYPES


def header_frame(df: DataFrame) -> DataFrame:
    """The columns of a frame in their order: ``ordinal`` (from 1), ``name``."""
    return header_of(df.sparkSession, df.columns)


def header_of(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("ordinal", T.IntegerType(), False),
            T.StructField("name", T.StringType(), False),
        ]
    )
    return spark.createDataFrame(list(enumerate(columns, start=1)), schema)


def map_header(header: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Header names with their dictionary entry; unknown columns are kept.

    Both sides have one row per column of a table. The ordinal of the header
    travels along, so the order of the file survives the join.
    """
    entries = dictionary.select(
        named("source field name").alias("source_field"),
        named("target field name").alias("target_field"),
        named("target data type").alias("target_type"),
        named("source primary key").alias("primary_key"),
        named("PII mark").alias("pii_mark"),
    )
    return header.join(
        entries, F.col("name") == F.col("source_field"), "left"
    ).select("ordinal", "name", "target_field", "target_type", "primary_key", "pii_mark")


def has_pii(mapping: DataFrame) -> DataFrame:
    """One row: whether any mapped column is marked as personal data."""
    marked = F.coalesce(F.bool_or(F.col("pii_mark") == PII), F.lit(False))
    return mapping.agg(marked.alias("has_pii"))


def choose_area(mapping: DataFrame, area: str, restricted_area: str) -> DataFrame:
    """One row: the restricted area if any column is personal data."""
    return has_pii(mapping).select(
        "has_pii",
        F.when(F.col("has_pii"), restricted_area).otherwise(area).alias("area"),
    )


def mapped_columns(mapping: DataFrame) -> list:
    """The mapping as driver rows in file order: one row per file column."""
    rows = sorted(mapping.collect(), key=lambda r: (r["ordinal"], r["target_field"] or ""))
    ordinals = [r["ordinal"] for r in rows]
    twice = sorted({r["name"] for r in rows if ordinals.count(r["ordinal"]) > 1})
    if twice:
        raise ValueError(f"the dictionary maps file columns twice: {twice}")
    return rows


def key_fields(mapping: DataFrame) -> list[str]:
    """Target names of the primary key, in file order, each once."""
    rows = mapped_columns(mapping)
    return [r["target_field"] for r in rows if r["primary_key"] == PRIMARY]


def target_fields(mapping: DataFrame) -> list[str]:
    """Target names the dictionary knows, in file order."""
    return [r["target_field"] for r in mapped_columns(mapping) if r["target_field"]]


def stage(df: DataFrame, mapping: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename file columns to target names and normalise them by target type.

    Columns without a known target type become ``Unknown_Column_<ordinal>``.
    ``keep`` names columns taken over as they are, before the others.
    """
    columns = [named(c) for c in keep]
    for row in mapped_columns(mapping):
        column = named(row["name"])
        field = df.schema[actual_name(df, row["name"])]
        target = row["target_type"]
        name = row["target_field"] if target in KNOWN_TYPES else None
        columns.append(
            _normalise(column, field.dataType, target).alias(
                name or f"{UNKNOWN_COLUMN}{row['ordinal']}"
            )
        )
    return df.select(*columns)


def _normalise(column: Column, source: T.DataType, target: str | None) -> Column:
    if target in NUMBER_TYPES:
        return F.coalesce(column, F.lit(NO_NUMBER).cast(source))
    trimmed = F.trim(column.cast("string"))
    if target in FLAG_TYPES:
        return F.coalesce(F.lower(trimmed), F.lit(NO_FLAG))
    if target in DATE_TYPES:
        return F.coalesce(trimmed, F.lit(NO_DATE))
    if target in TIMESTAMP_TYPES:
        return F.coalesce(trimmed, F.lit(NO_TIMESTAMP))
    return F.coalesce(trimmed, F.lit(NO_TEXT))


def stage_table(
    df: DataFrame,
    mapping: DataFrame,
    change_column: str = CHANGE_COLUMN,
    file_column: str = FILE_COLUMN,
    latest_only: bool = False,
) -> DataFrame:
    """Staged rows with their file and ``cnt``, 1 being the latest of its key.

    Later changes come first; among equal changes the greater file name does.
    ``latest_only`` leaves out the rows beyond ``cnt`` 1, which the checks do
    not look at and which need not be shuffled then.
    """
    staged = stage(df, mapping, keep=[file_column])
    latest = latest_by(
        staged,
        key_fields(mapping),
        change_column,
        tie_break=[file_column],
        keep_rank=None if latest_only else RANK_COLUMN,
    )
    return latest.withColumn(RANK_COLUMN, F.lit(1)) if latest_only else latest


def latest_staged(staged: DataFrame) -> DataFrame:
    """The rows of a staged table the checks look at."""
    return staged.where(F.col(RANK_COLUMN) == 1)
