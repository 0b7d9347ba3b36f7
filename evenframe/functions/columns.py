"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """Column by its literal name; slashes, spaces and dots need no care."""
    return F.col("`" + name.replace("`", "``") + "`")


def actual_name(df: DataFrame, name: str) -> str:
    """The spelling of ``name`` in ``df``; names are matched without case."""
    for column in df.columns:
        if column == name:
            return column
    for column in df.columns:
        if column.lower() == name.lower():
            return column
    raise ValueError(f"column {name!r} not found among {df.columns}")


def position_of(df: DataFrame, name: str) -> int:
    return df.columns.index(actual_name(df, name))


def orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(orderable(field.dataType) for field in data_type.fields)
    return True


def row_tie_break(df: DataFrame, used: Iterable[str]) -> list[Column]:
    """Ascending order over the columns not yet ``used``.

    Appended to a window order it makes "any one of the tied rows" the same
    row in every run.
    """
    taken = {name.lower() for name in used}
    return [
        named(field.name).asc()
        for field in df.schema.fields
        if field.name.lower() not in taken and orderable(field.dataType)
    ]


def distinct_text(column: Column, data_type: T.DataType) -> Column | None:
    """Text that is equal for equal values only; None where there is none."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0)).cast("string")  # -0.0 becomes 0.0
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    plain = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)
    if data_type == T.StringType() or isinstance(data_type, plain):
        return column.cast("string")
    return None


def shared_shuffle(df: DataFrame) -> DataFrame:
    """The same rows; wherever they are used, Spark reads all their columns.

    Two uses of one frame are planned apart. When each needs other columns,
    each reads and shuffles its own; when both need all of them, the shuffles
    are equal and the second use takes the output of the first. The condition
    holds for every row. Columns with maps have no hash and stay apart.
    """
    hashed = [named(f.name) for f in df.schema.fields if orderable(f.dataType)]
    return df.where(F.xxhash64(*hashed) >= F.lit(-(2**63))) if hashed else df


def fresh_name(columns: Iterable[str], stem: str) -> str:
    """A name starting with ``stem`` that no column carries yet."""
    taken = {name.lower() for name in columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Merge one-row frames with different columns into one row.

    A union followed by a global ``max`` keeps every value as it is, because
    each column is filled by exactly one of the rows.
    """
    first, *others = frames
    if not others:
        return first
    merged = first
    for frame in others:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.agg(*[F.max(named(c)).alias(c) for c in merged.columns])
