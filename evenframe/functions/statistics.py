"""Aggregate expressions used by the column profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PRECISION = 38
GUARD_DIGITS = 6
MOST_GUARDED_DIGITS = 9
PLAIN_DIGITS = 10
EXACT_UNITS = 2**53  # whole numbers below have no gaps as doubles
PART_BITS = 22  # numbers of so many bits can be added 2^41 times as a bigint
REST_DIGITS = 24  # digits that are kept of a rest, which is below one unit
ROUNDING = 2.0**-51  # error of a decimal kept as a double and moved by some digits
TINY = 1e-18  # doubles below have digits that no limb of a plain sum holds

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)


def text_length(column: Column, first: int | None = None) -> Column:
    """Sum of text lengths, optionally of the first ``first`` characters."""
    text = column.cast("string")
    if first is not None:
        text = F.substring(text, 1, first)
    return F.sum(F.length(text).cast("bigint"))


def distinct_count(column: Column) -> Column:
    return F.count_distinct(column)


def _exact_total(column: Column, data_type: T.DataType, scale: int) -> Column:
    """Sum that does not depend on the order in which rows are added.

    Floating point and text values are added as decimals with some digits to
    spare, and what those digits leave of each value is added beside them, so
    that only the total is rounded. Text that is no number is skipped. A
    number that is not finite or too big for any decimal makes the sum null.
    """
    if isinstance(data_type, T.BooleanType):
        return F.sum(column.cast("bigint"))
    if isinstance(data_type, T.LongType):
        return _whole_total(column)
    if isinstance(data_type, INTEGRAL):
        return F.sum(column.cast("bigint")).cast(T.DecimalType(20, 0))
    if isinstance(data_type, T.DecimalType):
        return F.try_sum(column)
    digits = max(scale, min(scale + GUARD_DIGITS, MOST_GUARDED_DIGITS))
    if isinstance(data_type, FLOATING):
        column = column.cast("double")
        total, rest = _floating_total(column, digits), _floating_rest(column, digits)
        unit = _power(-digits, T.DecimalType(max(digits, 1), digits))
        carried = F.round(rest, 0).cast(T.DecimalType(20, 0)) * unit
    else:
        total, carried = _text_total(column, digits), F.round(_text_rest(column, digits), digits)
    same_type = T.DecimalType(MAX_PRECISION - 1, digits)
    return total.try_cast(same_type) + F.coalesce(
        carried.try_cast(same_type), F.lit(0).cast(same_type)
    )


def _whole_total(whole: Column) -> Column:
    """Sum of bigints as a decimal, from the sums of their three parts.

    Sums of bigints cost a small part of a sum of wide decimals.
    """
    mask, base = F.lit(2**PART_BITS - 1), F.lit(2**PART_BITS).cast(T.DecimalType(7, 0))
    upper, middle, lower = (
        F.sum(part).cast(T.DecimalType(19, 0))
        for part in (
            F.shiftright(whole, 2 * PART_BITS),
            F.shiftright(whole, PART_BITS).bitwiseAND(mask),
            whole.bitwiseAND(mask),
        )
    )
    return (upper * base + middle) * base + lower


def _power(exponent: int, data_type: T.DecimalType) -> Column:
    return F.lit(f"1e{exponent}").cast(data_type)


def _fits(column: Column, digits: int) -> tuple[Column, Column]:
    """A value in units of its last digit, and whether a double holds such a number."""
    units = column * F.lit(10.0**digits)
    return units, F.abs(units) < F.lit(float(EXACT_UNITS))


def _floating_total(column: Column, digits: int) -> Column:
    """Counts values in whole units of the last digit.

    Only values too big for that are turned into decimals, which is slow.
    """
    units, fits = _fits(column, digits)
    whole = F.when(fits, F.rint(units).cast("bigint"))
    beyond = F.when(~fits, column)
    exact = beyond.try_cast(T.DecimalType(MAX_PRECISION, digits))

    places = max(digits, 1)
    unit = _power(-digits, T.DecimalType(places, digits))
    room = T.DecimalType(MAX_PRECISION - 1 - places, 0)
    same_type = T.DecimalType(MAX_PRECISION - 1, digits)
    small = _whole_total(whole).try_cast(room) * unit
    big = F.try_sum(exact)
    both = F.coalesce(small.try_cast(same_type), F.lit(0).cast(same_type)) + big.try_cast(
        same_type
    )
    lost = exact.isNull() & beyond.isNotNull()
    return _unless(lost, F.when(big.isNull(), small).otherwise(both))


def _floating_rest(column: Column, digits: int) -> Column:
    """What ``_floating_total`` leaves of the values, in units, with REST_DIGITS digits.

    A rest within the rounding error of its own value is none: 1234.56 is no
    whole number of units as a double, yet has two digits. Sums of such values
    stay free of that error, and only the values that have a rest cost a
    decimal.
    """
    units, fits = _fits(column, digits)
    rest = units - F.rint(units)
    rest = F.when(fits & (F.abs(rest) > F.abs(units) * F.lit(ROUNDING)), rest)
    return F.sum(rest.cast(T.DecimalType(REST_DIGITS, REST_DIGITS)))


def _text_total(column: Column, digits: int) -> Column:
    exact = column.try_cast(T.DecimalType(MAX_PRECISION, digits))
    lost = exact.isNull() & column.try_cast("double").isNotNull()
    return _unless(lost, F.try_sum(exact))


def _text_rest(column: Column, digits: int) -> Column:
    """What ``digits`` leave of numbers in texts, to the 27th digit after the point.

    Numbers of more than ten digits before the point have 17 after it. Texts
    with no more than ``digits`` characters after the point, and no exponent,
    have no rest and are not read again.
    """
    ends = F.length(column) - F.instr(column, ".")
    deep = (F.instr(column, ".") > 0) & (ends > digits) | F.contains(F.lower(column), F.lit("e"))
    column = F.when(deep, column)
    exact = column.try_cast(T.DecimalType(MAX_PRECISION, digits))
    kind = T.DecimalType(MAX_PRECISION - 1, 27)
    wide = T.DecimalType(MAX_PRECISION - 1, 17)
    fine = column.try_cast(kind) - exact.try_cast(kind)
    coarse = column.try_cast(wide) - exact.try_cast(wide)
    rest = F.coalesce(fine, coarse.try_cast(kind), F.lit(0).cast(kind))
    return F.try_sum(rest)


def _unless(lost: Column, total: Column) -> Column:
    return F.when(~F.coalesce(F.bool_or(lost), F.lit(False)), total)


def decimal_sum(
    column: Column, data_type: T.DataType, precision: int, scale: int
) -> Column:
    """``CAST(SUM(c) AS DECIMAL(p, s))``; null where the sum does not fit."""
    return _exact_total(column, data_type, scale).try_cast(
        T.DecimalType(precision, scale)
    )


def plain_sum(column: Column, data_type: T.DataType) -> Column:
    """``SUM(c)`` in the natural result type of ``c``.

    Doubles nearer to zero than 1e-18 are added as doubles.
    """
    if isinstance(data_type, T.BooleanType):
        return F.sum(column.cast("bigint"))
    if isinstance(data_type, INTEGRAL + (T.DecimalType,)):
        return F.sum(column)
    if isinstance(data_type, FLOATING):
        column = column.cast("double")
        tiny = F.abs(column) < F.lit(TINY)
        near = F.sum(F.when(tiny, column))
        column = F.when(tiny, F.lit(0.0)).otherwise(column)
        total = _floating_total(column, PLAIN_DIGITS).cast("double")
        rest = _floating_rest(column, PLAIN_DIGITS).cast("double") * F.lit(10.0**-PLAIN_DIGITS)
        none = F.lit(0.0)
        return total + (F.coalesce(rest, none) + F.coalesce(near, none))
    rest = F.coalesce(_text_rest(column, PLAIN_DIGITS).cast("double"), F.lit(0.0))
    return _text_total(column, PLAIN_DIGITS).cast("double") + rest


def flag_sum(column: Column, data_type: T.DataType) -> Column:
    """Sum of flags: ``False`` is 0, ``True`` is 1, other values count as such.

    A double for texts, the natural type of a sum for anything else.
    """
    if not isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return plain_sum(column, data_type)
    number = F.when(column == "False", "0").when(column == "True", "1").otherwise(column)
    return plain_sum(number, T.StringType())
