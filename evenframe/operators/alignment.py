"""Bring two frames to one column list before they are compared."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions.columns import actual_name, named

STRUCTURE_ERROR = "File Structure error"
FLOATING = (T.FloatType, T.DoubleType)
MAPS = ("native", "entries")
MAX_PRECISION = 38
DOUBLE_DIGITS = 15  # decimals of so many digits differ as doubles too
#: Digits of whole number types.
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class StructureError(ValueError):
    """The two sides cannot be lined up column by column."""


class Aligned(NamedTuple):
    expected: DataFrame
    actual: DataFrame
    columns: list[str]  # names to show, in order; the frames carry c0, c1, ...
    notes: list[str]  # type changes made on the way


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order; names are matched without case, kept as asked for."""
    try:
        return df.select(*[named(actual_name(df, c)).alias(c) for c in columns])
    except ValueError as missing:
        raise StructureError(str(missing)) from missing


def align(
    expected: DataFrame,
    actual: DataFrame,
    columns: Sequence[str] | None = None,
    by: str = "position",
    decimals: int | None = None,
    maps: str = "native",
) -> Aligned:
    """Line up both sides, by position or by name.

    ``columns`` projects both sides to that list first. ``decimals`` rounds
    floating point columns on both sides. Sides that disagree on the type of a
    column meet at a common time type or a number type that holds both,
    otherwise at text. ``maps`` says what becomes of map columns: they stay
    (``native``), or they are taken as arrays of ``entries`` in the order of
    their keys, which can be compared and sorted wherever a map cannot. Maps that
    hold the same entries in another order are equal either way.
    """
    if maps not in MAPS:
        raise ValueError(f"maps must be one of {MAPS}, not {maps!r}")
    if by not in ("position", "name"):
        raise ValueError(f"by must be 'position' or 'name', not {by!r}")
    if columns is not None:
        expected, actual = project(expected, columns), project(actual, columns)
    elif by == "name":
        _require_equal_names(expected, actual)
        actual = project(actual, expected.columns)
    if len(expected.columns) != len(actual.columns):
        raise StructureError(_difference(expected.columns, actual.columns))

    shown = list(expected.columns)
    internal = [f"c{i}" for i in range(len(shown))]
    expected, actual = expected.toDF(*internal), actual.toDF(*internal)
    if maps == "entries":
        expected, actual = with_map_entries(expected), with_map_entries(actual)
    left, right, notes = [], [], []
    for name, shown_name, e, a in zip(
        internal, shown, expected.schema.fields, actual.schema.fields
    ):
        exact_scale = _exact_scale(e.dataType, a.dataType)
        target = T.StringType() if exact_scale is not None else _common_type(e.dataType, a.dataType)
        if e.dataType != a.dataType:
            meeting = "wider type"
            if target is not None:
                meeting = "exact text" if exact_scale is not None else target.simpleString()
            notes.append(
                f"{shown_name}: {e.dataType.simpleString()} and "
                f"{a.dataType.simpleString()} compared as {meeting}"
            )
        left.append(_fit(F.col(name), e.dataType, target, decimals, exact_scale).alias(name))
        right.append(_fit(F.col(name), a.dataType, target, decimals, exact_scale).alias(name))
    return Aligned(expected.select(*left), actual.select(*right), shown, notes)


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.MapType)


def _map_entries(column: Column, data_type: T.DataType) -> Column:
    """The value with every map in it, however deep, as entries in the order of their keys."""
    if not _holds_map(data_type):
        return column
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: _map_entries(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [_map_entries(column.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    entries = F.map_entries(column)
    if _holds_map(data_type.valueType):
        entries = F.transform(
            entries,
            lambda e: F.struct(
                e.getField("key").alias("key"),
                _map_entries(e.getField("value"), data_type.valueType).alias("value"),
            ),
        )
    return F.array_sort(entries)


def with_map_entries(df: DataFrame) -> DataFrame:
    """The frame with its maps, nested ones too, as sorted arrays of entries."""
    if not _holds_map(df.schema):
        return df
    return df.select(*[_map_entries(named(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _require_equal_names(expected: DataFrame, actual: DataFrame) -> None:
    def names(df: DataFrame) -> list[str]:
        return sorted(c.lower() for c in df.columns)

    if names(expected) != names(actual):
        raise StructureError(_difference(expected.columns, actual.columns))


def _difference(expected: Sequence[str], actual: Sequence[str]) -> str:
    have_e = {c.lower() for c in expected}
    have_a = {c.lower() for c in actual}
    missing = [c for c in expected if c.lower() not in have_a]
    extra = [c for c in actual if c.lower() not in have_e]
    return (
        f"{len(expected)} and {len(actual)} columns, "
        f"missing [{', '.join(missing)}], extra [{', '.join(extra)}]"
    )


def _common_type(e: T.DataType, a: T.DataType) -> T.DataType | None:
    """Type both sides are cast to; None leaves it to the union."""
    if e == a:
        return None
    void = T.NullType
    if isinstance(e, void) or isinstance(a, void):
        return None
    if isinstance(e, T.NumericType) and isinstance(a, T.NumericType):
        floating = isinstance(e, FLOATING) or isinstance(a, FLOATING)
        return T.DoubleType() if floating else None
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(e, times) and isinstance(a, times):
        return None
    nested = (T.ArrayType, T.StructType, T.MapType)
    if isinstance(e, nested) or isinstance(a, nested):
        return None
    return T.StringType()


def _as_decimal(data_type: T.DataType) -> T.DecimalType | None:
    for kind, precision in WHOLE_DIGITS.items():
        if isinstance(data_type, kind):
            return T.DecimalType(precision, 0)
    return data_type if isinstance(data_type, T.DecimalType) else None


def _exact_scale(e: T.DataType, a: T.DataType) -> int | None:
    """Scale for a comparison as text, where no number type holds both sides."""
    if e == a:
        return None
    left, right = _as_decimal(e), _as_decimal(a)
    if left and right:
        whole = max(left.precision - left.scale, right.precision - right.scale)
        scale = max(left.scale, right.scale)
        return scale if whole + scale > MAX_PRECISION else None
    exact = left or right
    if exact and (isinstance(e, FLOATING) or isinstance(a, FLOATING)):
        return exact.scale if exact.precision > DOUBLE_DIGITS else None
    return None


def _exact_text(column: Column, source: T.DataType, scale: int) -> Column:
    """Equal for equal numbers: no point where nothing but zeros follows it.

    A double that is a decimal of that scale is written as the decimal, any
    other as the double.
    """
    if not isinstance(source, FLOATING):
        return _without_zeros(column.cast(_as_decimal(source)))
    value = column.cast("double")
    exact = value.try_cast(T.DecimalType(MAX_PRECISION, scale))
    same = F.coalesce(exact.cast("double") == value, F.lit(False))
    return F.when(same, _without_zeros(exact)).otherwise(value.cast("string"))


def _without_zeros(column: Column) -> Column:
    text = F.regexp_replace(column.cast("string"), r"(\.\d*?)0+(?=E|$)", "$1")
    text = F.regexp_replace(text, r"\.(?=E|$)", "")
    return F.when(column == 0, F.lit("0")).otherwise(text)


def _fit(
    column: Column,
    source: T.DataType,
    target: T.DataType | None,
    decimals: int | None,
    exact_scale: int | None,
) -> Column:
    if decimals is not None and isinstance(source, FLOATING):
        column = F.round(column, decimals)
    if exact_scale is not None:
        return _exact_text(column, source, exact_scale)
    return column if target is None else column.cast(target)
