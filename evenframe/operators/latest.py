"""Latest version per key on change-captured rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenframe.functions.columns import (
    actual_name,
    fresh_name,
    named,
    row_tie_break,
    shared_shuffle,
)
from evenframe.operators.numbering import number_rows

# Priority of the operation codes, lower wins; any other code,
# and no code, comes after them.
OPERATION_PRIORITY = {"D": 1, "U": 2, "I": 3}

SALTS = 8  # tasks that the tied rows of one key spread over


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    ties: str = "one",
    tie_break: Sequence[str] = (),
    keep_rank: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Rows with the greatest ``order`` per key, nulls last.

    ``ties="all"`` keeps every row that shares the greatest order. Those of one
    key spread over ``salts`` tasks. With 1 they meet in one, which saves a join
    where no key has very many.
    ``ties="one"`` keeps one: the greatest by ``tie_break``, then the first by
    the remaining columns. ``keep_rank`` names a column for the number of each
    row within its key and keeps all rows instead.
    """
    if not keys:
        raise ValueError("keys are needed: one group of all rows does not scale")
    orders = [order] if isinstance(order, str) else list(order)
    keys = [actual_name(df, k) for k in keys]
    orders = [actual_name(df, o) for o in orders]
    if ties == "all":
        if keep_rank or tie_break:
            raise ValueError("ties='all' takes neither tie_break nor keep_rank")
        return _all_latest(df, keys, orders, salts)
    if ties != "one":
        raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")
    breaks = [actual_name(df, t) for t in tie_break]
    ranking = [named(c).desc() for c in orders + breaks]
    ranking += row_tie_break(df, [*keys, *orders, *breaks])
    if keep_rank:
        if keep_rank.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"there is a column {keep_rank!r} already")
        return number_rows(df, keys, ranking, keep_rank)
    return _first_per_key(df, keys, ranking)


def latest_cdc(
    df: DataFrame,
    keys: Sequence[str],
    operation: str,
    changed_at: str,
    priority: Mapping[str, int] = OPERATION_PRIORITY,
) -> DataFrame:
    """One row per key: best operation priority first, then latest change.

    Priority outranks recency, so an old delete wins over a newer update.
    """
    if not keys:
        raise ValueError("keys are needed: one group of all rows does not scale")
    keys = [actual_name(df, k) for k in keys]
    operation, changed_at = actual_name(df, operation), actual_name(df, changed_at)
    rank = F.lit(max(priority.values()) + 1)
    for code, value in priority.items():
        rank = F.when(named(operation) == code, value).otherwise(rank)
    ranking = [rank.asc(), named(changed_at).desc()]
    ranking += row_tie_break(df, [*keys, changed_at])
    return _first_per_key(df, keys, ranking)


def distinct_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of distinct key tuples, nulls included."""
    columns = [named(actual_name(df, k)) for k in keys]
    return df.select(*columns).distinct().agg(
        F.count(F.lit(1)).alias("distinct_key_count")
    )


def _first_per_key(df: DataFrame, keys: list[str], ranking: list[Column]) -> DataFrame:
    """Row number 1 per key.

    Spark turns the filter into a group limit that runs before the shuffle:
    every map task sends at most one row per key, however hot the key is.
    """
    number = fresh_name(df.columns, "__row_number")
    window = Window.partitionBy(*[named(k) for k in keys]).orderBy(*ranking)
    return (
        df.withColumn(number, F.row_number().over(window))
        .where(named(number) == 1)
        .drop(number)
    )


def _all_latest(df: DataFrame, keys: list[str], orders: list[str], salts: int) -> DataFrame:
    """Rank 1 per key with all ties, from one read of ``df``.

    Spark turns the filter on the rank into a group limit that runs before the
    shuffle: a read task sends the rows that share the newest order it saw of a
    key, so old versions of a hot key never travel.

    Tied rows of a hot key do. With ``salts`` each read task sends all its
    rows to one of so many places per key; what is left there is compared with the
    greatest order per key. Both sides of that comparison read the same
    shuffle, and the adaptive skew join keeps splitting the tied rows.
    """
    salt = fresh_name(df.columns, "__salt")
    rank = fresh_name([*df.columns, salt], "__rank")
    within = [named(k) for k in keys]
    if salts > 1:
        df = df.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(salts)))
        within.append(named(salt))
    window = Window.partitionBy(*within).orderBy(*[named(o).desc() for o in orders])
    first = df.withColumn(rank, F.rank().over(window)).where(named(rank) == 1).drop(rank)
    if salts <= 1:
        return first
    first = shared_shuffle(first)
    newest = F.struct(*[named(o) for o in orders]) if len(orders) > 1 else named(orders[0])
    greatest = first.groupBy(
        *[named(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    ).agg(F.max(newest).alias("__newest"))
    match = newest.eqNullSafe(F.col("__newest"))
    for i, k in enumerate(keys):
        match = match & named(k).eqNullSafe(F.col(f"__k{i}"))
    return first.join(greatest, match, "left_semi").drop(salt)
