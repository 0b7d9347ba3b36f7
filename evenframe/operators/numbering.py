"""Row numbers within keys that may be too big for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenframe.functions.columns import named
from evenframe.functions.durable import durable

ROWS_PER_TASK = 5_000_000


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    ranking: Sequence[Column],
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``name``: 1, 2, 3 ... within each key along ``ranking``.

    Key sizes are counted first. Keys of up to ``rows_per_task`` rows take a
    plain window. Bigger ones are sorted over many tasks and numbered there.
    """
    sizes = df.groupBy(*[named(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    hot = sizes.where(F.col("__rows") > rows_per_task)
    biggest = hot.agg(
        F.count(F.lit(1)).alias("keys"), F.sum("__rows").alias("rows")
    ).first()
    if not biggest["keys"]:
        return _window_numbers(df, keys, ranking, name)
    same_key = F.lit(True)
    for i, k in enumerate(keys):
        same_key = same_key & named(k).eqNullSafe(F.col(f"__k{i}"))
    hot = durable(hot.drop("__rows"))
    cold_rows = df.join(hot, same_key, "left_anti")
    hot_rows = df.join(hot, same_key, "left_semi")
    tasks = 1 + 2 * int(biggest["rows"]) // rows_per_task
    return _window_numbers(cold_rows, keys, ranking, name).unionByName(
        _sorted_numbers(hot_rows, keys, ranking, name, tasks)
    )


def _window_numbers(
    df: DataFrame, keys: Sequence[str], ranking: Sequence[Column], name: str
) -> DataFrame:
    window = Window.partitionBy(*[named(k) for k in keys]).orderBy(*ranking)
    return df.withColumn(name, F.row_number().over(window))


def _sorted_numbers(
    df: DataFrame,
    keys: Sequence[str],
    ranking: Sequence[Column],
    name: str,
    tasks: int,
) -> DataFrame:
    """Numbers from a range partitioned sort.

    A key's rows lie in consecutive partitions; the number of a row is its
    place within its partition plus the key's rows in the partitions before.
    Rows equal in every column are told apart by a stored id, so copies of one
    row spread as well. Both steps are stored, because the places must not
    change when a task runs again.
    """
    row_id, part = "__row_id", "__part"
    key_columns = [named(k) for k in keys]
    stored = durable(df.withColumn(row_id, F.monotonically_increasing_id()))
    placed = durable(
        stored.repartitionByRange(tasks, *key_columns, *ranking, F.col(row_id)).withColumn(
            part, F.spark_partition_id()
        )
    )
    before = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy("__p")
    offsets = (
        placed.groupBy(
            *[named(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col(part).alias("__p"),
        )
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn(
            "__before",
            F.coalesce(
                F.sum("__rows").over(
                    before.rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
    )
    within = Window.partitionBy(part, *key_columns).orderBy(*ranking, F.col(row_id))
    same_place = F.col(part) == F.col("__p")
    for i, k in enumerate(keys):
        same_place = same_place & named(k).eqNullSafe(F.col(f"__k{i}"))
    return (
        placed.withColumn(name, F.row_number().over(within))
        .join(offsets, same_place)
        .withColumn(name, (named(name) + F.col("__before")).cast("int"))
        .select(*[named(c) for c in df.columns], named(name))
    )
