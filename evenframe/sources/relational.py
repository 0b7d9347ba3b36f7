"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


def jdbc_options(
    url: str,
    table: str,
    schema: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    where: str | None = None,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    partitions: int | None = None,
    fetch_size: int = FETCH_SIZE,
) -> dict[str, str]:
    """Reader options for ``schema.table``.

    One connection reads the whole table unless ``partition_column`` with its
    bounds and the number of ``partitions`` split it into ranges. ``where``
    restricts the table inside the database.
    """
    split = (partition_column, lower_bound, upper_bound, partitions)
    if any(s is not None for s in split) and any(s is None for s in split):
        raise ValueError(
            "partition_column, lower_bound, upper_bound and partitions go together"
        )
    name = f"{schema}.{table}" if schema else table
    source = f"(SELECT * FROM {name} WHERE {where}) filtered" if where else name
    options: Mapping[str, object | None] = {
        "url": url,
        "dbtable": source,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": fetch_size,
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": partitions,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """Read ``schema.table``; settings are those of :func:`jdbc_options`."""
    return (
        spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()
    )
