"""One-pass multiset comparison of two aligned frames.

Both sides are united with a mark of their origin and grouped by all columns,
so each distinct row meets its copies of both sides once. Copies are added up
before the shuffle, which spreads the rest by the hash of the whole row: a row
repeated any number of times, or a key shared by many rows, loads no task more
than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenframe.functions.columns import named
from evenframe.operators.alignment import Aligned

N_EXPECTED = "__expected"
N_ACTUAL = "__actual"
COPIES_PER_CHUNK = 100_000


def tally(sides: Aligned) -> DataFrame:
    """One row per distinct row of either side, with its copies on each side."""
    names = sides.expected.columns
    return (
        _marked(sides.expected, 1, 0)
        .union(_marked(sides.actual, 0, 1))
        .groupBy(*names)
        .agg(F.sum(N_EXPECTED).alias(N_EXPECTED), F.sum(N_ACTUAL).alias(N_ACTUAL))
    )


def _marked(df: DataFrame, expected: int, actual: int) -> DataFrame:
    return df.select(
        "*",
        F.lit(expected).cast("bigint").alias(N_EXPECTED),
        F.lit(actual).cast("bigint").alias(N_ACTUAL),
    )


def surplus(of: str, over: str) -> Column:
    return F.greatest(F.col(of) - F.col(over), F.lit(0).cast("bigint"))


def total(column: Column) -> Column:
    """Sum that is 0 over no rows."""
    return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))


def of_side(copies: str, column: str) -> Column:
    """Aggregate over a tally: the greatest value of ``column`` on one side."""
    return F.max(F.when(F.col(copies) > 0, F.col(column)))


def row_totals(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Row counts of both sides only, for frames that cannot be aligned."""

    def rows(df: DataFrame, e: int, a: int) -> DataFrame:
        return _marked(df.select(), e, a)

    return rows(expected, 1, 0).union(rows(actual, 0, 1)).agg(
        total(F.col(N_EXPECTED)).alias("expected_rows"),
        total(F.col(N_ACTUAL)).alias("actual_rows"),
    )


def totals(counted: DataFrame, key_columns: Sequence[str] | None = None) -> DataFrame:
    """Row counts and both differences, with distinct key counts where asked.

    The key counts are taken from the counted rows of the same pass. Rows of
    one key are folded on the map side first, so a hot key stays cheap.
    """
    measures = {
        "expected_rows": F.col(N_EXPECTED),
        "actual_rows": F.col(N_ACTUAL),
        "expected_minus_actual": surplus(N_EXPECTED, N_ACTUAL),
        "actual_minus_expected": surplus(N_ACTUAL, N_EXPECTED),
    }
    if not key_columns:
        return counted.agg(*[total(c).alias(n) for n, c in measures.items()])
    per_key = counted.groupBy(*key_columns).agg(
        *[F.sum(c).alias(n) for n, c in measures.items()]
    )
    return per_key.agg(
        *[total(F.col(n)).alias(n) for n in measures],
        F.count_if(F.col("expected_rows") > 0).alias("expected_keys"),
        F.count_if(F.col("actual_rows") > 0).alias("actual_keys"),
    )


def differing(counted: DataFrame) -> DataFrame:
    """The counted rows whose number of copies differs between the sides."""
    return counted.where(F.col(N_EXPECTED) != F.col(N_ACTUAL))


def diff_rows(
    sides: Aligned,
    side: str = "side",
    labels: tuple[str, str] = ("EXPECTED", "ACTUAL"),
    copies_per_chunk: int = COPIES_PER_CHUNK,
) -> DataFrame:
    """The rows one side has more often than the other, once per extra copy.

    Extra copies of one row are written out in chunks. Rows with more copies
    than one chunk holds get their chunks spread over all tasks before, by row
    and chunk.
    """
    copies, chunk = "__copies", "__chunk"
    more_expected = F.col(N_EXPECTED) > F.col(N_ACTUAL)
    extra = differing(tally(sides)).select(
        F.when(more_expected, labels[0]).otherwise(labels[1]).alias(side),
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(sides.expected.columns)],
        F.abs(F.col(N_EXPECTED) - F.col(N_ACTUAL)).alias(copies),
    )
    size = F.lit(copies_per_chunk).cast("bigint")
    few = extra.where(F.col(copies) <= size)
    partitions = int(extra.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        extra.where(F.col(copies) > size)
        .withColumn(
            chunk,
            F.explode(
                F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(copies) / size) - 1)
            ),
        )
        .withColumn(copies, F.least(size, F.col(copies) - F.col(chunk) * size))
        .repartition(partitions, chunk, *[c for c in extra.columns if c != copies])
        .drop(chunk)
    )
    written = few.union(many).withColumn(
        copies, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))
    )
    return written.drop(copies).toDF(side, *sides.columns)


def labelled_diff(
    sides: Aligned,
    side: str = "side",
    labels: tuple[str, str] = ("EXPECTED", "ACTUAL"),
) -> DataFrame:
    """Distinct rows that occur on one side only, with the name of that side."""
    single = tally(sides).where((F.col(N_EXPECTED) == 0) | (F.col(N_ACTUAL) == 0))
    return single.select(
        F.when(F.col(N_ACTUAL) == 0, labels[0]).otherwise(labels[1]).alias(side),
        *[named(c) for c in sides.expected.columns],
    ).toDF(side, *sides.columns)
