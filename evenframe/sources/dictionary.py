"""Data dictionaries: one row per column of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions.columns import actual_name, named

# Dictionary layouts.
ERP_SCHEMA = T.StructType(
    [
        T.StructField("TABNAME", T.StringType()),
        T.StructField("FIELDNAME", T.StringType()),
        T.StructField("DATATYPE", T.StringType()),
        T.StructField("DECIMALS", T.IntegerType()),
    ]
)
CRM_SCHEMA = T.StructType(
    [
        T.StructField("table name", T.StringType()),
        T.StructField("field name", T.StringType()),
        T.StructField("data type", T.StringType()),
    ]
)
STAGING_SCHEMA = T.StructType(
    [
        T.StructField("source table name", T.StringType()),
        T.StructField("source field name", T.StringType()),
        T.StructField("source data type", T.StringType()),
        T.StructField("source primary key", T.StringType()),
        T.StructField("target table name", T.StringType()),
        T.StructField("target field name", T.StringType()),
        T.StructField("target data type", T.StringType()),
        T.StructField("PII mark", T.StringType()),
    ]
)
TABLE_COLUMN = {
    "erp": "TABNAME",
    "crm": "table name",
    "staging": "target table name",
}


def read_dictionary(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Read a dictionary from a CSV file or, for any other path, from Parquet."""
    schema = {"erp": ERP_SCHEMA, "crm": CRM_SCHEMA, "staging": STAGING_SCHEMA}[kind]
    if path.endswith(".csv"):
        texts = spark.read.csv(path, header=True)
        return texts.select(
            *[
                named(actual_name(texts, f.name)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )
    return spark.read.parquet(path).select(*[named(f.name) for f in schema.fields])


def load_dictionary(
    dictionary: DataFrame, table: str, table_column: str | None = None
) -> DataFrame:
    """The rows of one table; the layout is told by its table name column."""
    if table_column is None:
        known = [c for c in TABLE_COLUMN.values() if c in dictionary.columns]
        if not known:
            raise ValueError("no known table name column, give table_column")
        table_column = known[0]
    return dictionary.where(named(table_column) == table)


def source_table(dictionary: DataFrame, table: str) -> str:
    """Source table name of a target table in a staging dictionary."""
    row = (
        load_dictionary(dictionary, table, "target table name")
        .agg(F.min(named("source table name")).alias("name"))
        .first()
    )
    if row["name"] is None:
        raise ValueError(f"table {table} is not in the dictionary")
    return row["name"]
