"""Which columns differ between two frames.

Rows with equal copies on both sides cancel out, so only the differing rows of
the tally are looked at. A column mismatches at a key when the two sides hold
different values, or a different number of equal values, there. Without keys
the whole table counts as one key, which for one-row frames is a plain
comparison of the two rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenframe.functions.columns import distinct_text, named
from evenframe.operators.alignment import Aligned
from evenframe.operators.counting import N_ACTUAL, N_EXPECTED, differing, tally

ALL_MATCH = "NA"
NET = "__net"


def internal_keys(sides: Aligned, keys: Sequence[str] | None) -> list[str]:
    """Names the key columns carry inside the aligned frames."""
    position = {c.lower(): i for i, c in enumerate(sides.columns)}
    unknown = [k for k in keys or [] if k.lower() not in position]
    if unknown:
        raise ValueError(f"key columns {unknown} not found among {sides.columns}")
    return [f"c{position[k.lower()]}" for k in keys or []]


def _mismatch_row(
    counted: DataFrame, sides: Aligned, keys: Sequence[str] | None
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """One row with the number of mismatching keys per non-key column."""
    key_columns = internal_keys(sides, keys)
    value_columns = [c for c in sides.expected.columns if c not in key_columns]
    if not value_columns:
        raise ValueError("there is no column besides the keys")
    net = (F.col(N_EXPECTED) - F.col(N_ACTUAL)).alias(NET)
    rows = differing(counted).select(*key_columns, *value_columns, net)
    if key_columns:
        row = _by_key(rows, key_columns, value_columns)
    else:
        row = _by_cell(rows, [], value_columns)
    shown = dict(zip(sides.expected.columns, sides.columns))
    return row, [(c, shown[c]) for c in value_columns]


def _by_key(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mismatching keys per column, one key at a time where that is enough.

    If a key has more rows on one side, all its columns mismatch. If it has one
    differing row on each side, the two are compared directly. Only keys with
    several different rows on a side, which says the keys are not unique, are
    taken apart into cells.
    """
    expected, actual, balance = "__e", "__a", "__balance"
    per_key = rows.groupBy(*keys).agg(
        F.sum(NET).alias(balance),
        F.count_if(F.col(NET) > 0).alias("__n_e"),
        F.count_if(F.col(NET) < 0).alias("__n_a"),
        F.first(F.when(F.col(NET) > 0, F.struct(*values)), True).alias(expected),
        F.first(F.when(F.col(NET) < 0, F.struct(*values)), True).alias(actual),
    )
    unbalanced = F.col(balance) != 0
    clear = unbalanced | ((F.col("__n_e") == 1) & (F.col("__n_a") == 1))

    def unequal(c: str) -> Column:
        data_type = rows.schema[c].dataType
        e, a = (_sortable(F.col(f"{s}.{c}"), data_type) for s in (expected, actual))
        return unbalanced | ~e.eqNullSafe(a)

    direct = per_key.where(clear).agg(*[F.count_if(unequal(c)).alias(c) for c in values])
    tangled = per_key.where(~clear).select(
        *[F.col(k).alias(f"__{k}") for k in keys]
    )
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"__{k}"))
    apart = _by_cell(rows.join(tangled, same_key, "left_semi"), keys, values)
    return direct.union(apart).agg(*[F.sum(c).alias(c) for c in values])


def _sortable(column: Column, data_type: T.DataType) -> Column:
    """Maps cannot be compared, their sorted entries can."""
    if isinstance(data_type, T.MapType):
        return F.array_sort(F.map_entries(column))
    return column


def _by_cell(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mismatching keys per column from single cells (column, value, net copies).

    Equal cells fold before the shuffle. Columns whose values have no exact
    text travel in a column of their own, null in the cells of the others.
    """
    which, text = "__which", "__text"
    texts = [distinct_text(F.col(c), rows.schema[c].dataType) for c in values]
    nested = {c: i for i, (c, t) in enumerate(zip(values, texts)) if t is None}
    no_text = F.lit(None).cast("string")
    cells = rows.select(
        *keys,
        *nested,
        NET,
        F.posexplode(F.array(*[no_text if t is None else t for t in texts])).alias(
            which, text
        ),
    ).select(
        which,
        text,
        NET,
        *keys,
        *[F.when(F.col(which) == i, F.col(c)).alias(c) for c, i in nested.items()],
    )
    unequal = (
        cells.groupBy(which, text, *keys, *nested)
        .agg(F.sum(NET).alias(NET))
        .where(F.col(NET) != 0)
        .select(which, *keys)
        .distinct()
    )
    return unequal.agg(
        *[F.count_if(F.col(which) == i).alias(c) for i, c in enumerate(values)]
    )


def mismatch_counts(sides: Aligned, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per non-key column with the number of keys it mismatches at."""
    row, columns = _mismatch_row(tally(sides), sides, keys)
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(c).alias("mismatching_keys"))
            for c, name in columns
        ]
    )
    return row.select(F.inline(entries))


def one_row_mismatches(sides: Aligned) -> Column:
    """Aggregate over the tally of two one-row frames: mismatching names.

    Values are wrapped, so a null counts as a value of its own. Of a frame
    with more rows the greatest value of each column is looked at.
    """

    def value(copies: str, column: str) -> Column:
        return F.max(F.when(F.col(copies) > 0, F.struct(column)))

    names = [
        F.when(~value(N_EXPECTED, c).eqNullSafe(value(N_ACTUAL, c)), F.lit(shown))
        for c, shown in zip(sides.expected.columns, sides.columns)
    ]
    return F.concat_ws(",", *names)


def mismatching_columns(
    sides: Aligned,
    keys: Sequence[str] | None = None,
    name: str = "Mismatching columns",
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row: names of the mismatching columns joined by comma, or ``NA``."""
    row, columns = _mismatch_row(
        tally(sides) if counted is None else counted, sides, keys
    )
    names = F.concat_ws(",", *[F.when(named(c) > 0, F.lit(n)) for c, n in columns])
    return row.select(
        F.when(names == "", F.lit(ALL_MATCH)).otherwise(names).alias(name)
    )
