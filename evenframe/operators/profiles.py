"""Column profile: one row of statistics over a whole table."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions import statistics as S
from evenframe.functions.columns import actual_name, distinct_text, named, one_row, shared_shuffle
from evenframe.operators import rules as R
from evenframe.operators.latest import latest_by

COLUMNS_PER_SCAN = 2
MOST_SCANS = 8
DISTINCT_COUNTS_TOGETHER = 12
READ_AS = ("files", "columnar", "computed", "shuffled")


def statistics_for(
    dictionary: DataFrame, rules: str = "erp", side: str = "target"
) -> list[R.Statistic]:
    """Statistics for the dictionary rows of one table, in dictionary order.

    Only the dictionary is read here: one short row per column of the table.
    """
    if side not in R.SIDES:
        raise ValueError(f"side must be one of {R.SIDES}, not {side!r}")
    found: list[R.Statistic] = []
    if rules == "erp":
        for row in dictionary.select("FIELDNAME", "DATATYPE", "DECIMALS").collect():
            found += R.erp_statistics(row[0], row[1], row[2], side)
    elif rules == "crm":
        for row in dictionary.select("field name", "data type").collect():
            found += R.crm_statistics(row[0], row[1], side)
    else:
        raise ValueError(f"rules must be 'erp' or 'crm', not {rules!r}")
    names = [s.name.lower() for s in found]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"the dictionary states fields twice: {twice}")
    return found


def profile(
    df: DataFrame,
    dictionary: DataFrame,
    rules: str = "erp",
    side: str = "target",
    change_column: str | None = None,
    read_as: str = "files",
) -> DataFrame:
    """One row: row count, latest change and the statistics of every field.

    Distinct counts are exact. Taken in the same aggregate as the rest, Spark
    would copy each row, with all its columns, once per counted column; they
    are kept apart instead. ``read_as`` says what reading ``df`` costs:

    ``files``     delimited files, JDBC: one pass for all distinct counts
    ``columnar``  a plain read of a columnar table: a few columns per pass, each
                  pass reads only its own
    ``computed``  a frame with costly steps before: nothing is read twice as
                  long as there are few distinct counts
    ``shuffled``  a frame that a shuffle ends in: one pass for all distinct counts,
                  from the output of that shuffle
    """
    if read_as not in READ_AS:
        raise ValueError(f"read_as must be one of {READ_AS}, not {read_as!r}")
    statistics = statistics_for(dictionary, rules, side)
    if read_as == "shuffled":
        df = shared_shuffle(df)
    changed = actual_name(df, change_column or R.CHANGE_COLUMN[rules])
    counts = [s for s in statistics if s.kind == R.COUNT_DISTINCT]
    if read_as == "columnar":
        apart = counts
    elif read_as == "computed" and len(counts) <= DISTINCT_COUNTS_TOGETHER:
        apart = []
    else:
        apart = [s for s in counts if distinct_text(*_field(df, s)) is not None]
    together = [
        F.count(F.lit(1)).alias("TOTAL_ROW_COUNT"),
        F.max(named(changed)).alias("MAX_MODIFICATION_DATE"),
        *[_aggregate(df, s).alias(s.name) for s in statistics if s not in apart],
    ]
    parts = [df.agg(*together)]
    if apart and read_as != "columnar":
        parts.append(_distinct_cells(df, apart))
    elif apart:
        step = max(COLUMNS_PER_SCAN, math.ceil(len(apart) / MOST_SCANS))
        for start in range(0, len(apart), step):
            some = apart[start : start + step]
            parts.append(df.agg(*[_aggregate(df, s).alias(s.name) for s in some]))
    return one_row(parts).select(
        F.lit("Profile").alias("Profile"),
        "TOTAL_ROW_COUNT",
        "MAX_MODIFICATION_DATE",
        *[named(s.name) for s in statistics],
    )


def _distinct_cells(df: DataFrame, counts: list[R.Statistic]) -> DataFrame:
    """Distinct counts of many columns in one pass.

    Each row becomes one small (column, value) cell per column. Equal cells
    fold before the shuffle, so a value shared by many rows costs nothing.
    """
    texts = F.array(*[distinct_text(*_field(df, s)) for s in counts])
    per_column = (
        df.select(F.posexplode(texts).alias("__which", "__value"))
        .where(F.col("__value").isNotNull())
        .distinct()
        .groupBy("__which")
        .agg(F.count(F.lit(1)).alias("__values"))
    )
    return per_column.agg(
        *[
            F.coalesce(
                F.max(F.when(F.col("__which") == i, F.col("__values"))),
                F.lit(0).cast("bigint"),
            ).alias(s.name)
            for i, s in enumerate(counts)
        ]
    )


def _field(df: DataFrame, statistic: R.Statistic) -> tuple[Column, T.DataType]:
    field = actual_name(df, statistic.field)
    return named(field), df.schema[field].dataType


def _aggregate(df: DataFrame, statistic: R.Statistic) -> Column:
    column, data_type = _field(df, statistic)
    if statistic.kind == R.SUM_LEN:
        return S.text_length(column, statistic.first)
    if statistic.kind == R.COUNT_DISTINCT:
        return S.distinct_count(column)
    if statistic.flag:
        return S.flag_sum(column, data_type)
    if statistic.decimal:
        return S.decimal_sum(column, data_type, *statistic.decimal)
    return S.plain_sum(column, data_type)


def profile_table(
    df: DataFrame,
    dictionary: DataFrame,
    rules: str = "erp",
    side: str = "target",
    change_column: str | None = None,
    latest_keys: Iterable[str] | None = None,
    read_as: str = "files",
) -> DataFrame:
    """Profile of a table as read, or of its latest row per ``latest_keys``."""
    changed = change_column or R.CHANGE_COLUMN[rules]
    if latest_keys:
        fields = [s.field for s in statistics_for(dictionary, rules, side)]
        keys = list(latest_keys)
        used = {actual_name(df, c): None for c in [*keys, changed, *fields]}
        df = latest_by(df.select(*[named(c) for c in used]), keys, changed)
        read_as = "shuffled"
    return profile(df, dictionary, rules, side, changed, read_as)


def run_profile_sql(
    df: DataFrame,
    select_list: str,
    table: str,
    latest_key: str | None = None,
    change_column: str = R.CHANGE_COLUMN["crm"],
) -> DataFrame:
    """Run a stored SELECT, written without FROM, over ``df``.

    The frame is registered as ``my_<table>``. With ``latest_key`` the SELECT
    sees only the latest row of each key.
    """
    view = f"my_{table}"
    if latest_key:
        df = latest_by(df, [latest_key], change_column)
    df.createOrReplaceTempView("`" + view.replace("`", "``") + "`")
    return df.sparkSession.sql(f"{select_list} FROM `{view.replace('`', '``')}`")
