"""Left lookup join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot from this many rows on: below it, all its rows fit one task with ease.
HOT_ROWS = 100_000
# No more hot keys than this are set apart, which bounds what is broadcast. Every key
# outside the largest 1000 holds less than 1/1000 of the rows and needs no care.
HOT_KEYS = 1_000
# Up to this many (narrow) left rows, the right side is filtered to the keys in use.
SMALL_LEFT = 500_000
# Values of these types keep the picked right rows small as well; arrays and structs may not.
_NARROW = ("string", "int", "bigint", "boolean")


def _equal(left_keys: list[str], names: list[str]) -> Column:
    pairs = [F.col(l) == F.col(n) for l, n in zip(left_keys, names)]
    return reduce(lambda a, b: a & b, pairs)


def lookup_left(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[str],
    right_keys: list[str],
    values: list[str],
    left_rows: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``left`` with ``values`` of the matching ``right`` row, nulls where there is none.

    ``right`` must be unique on its keys. Rows of hot left keys are not shuffled: they meet
    at most ``HOT_KEYS`` right rows by broadcast. Rows with a null key skip the join.

    ``left_rows`` is the counted size of ``left``, if known. When it is small, its keys are
    broadcast to pick the few right rows in use, and nothing large is shuffled at all.
    """
    names = [f"_key{i}" for i in range(len(right_keys))]
    table = right.select(*[F.col(k).alias(n) for k, n in zip(right_keys, names)], *values)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in left_keys])
    on = _equal(left_keys, names)
    out = [*left.columns, *values]
    used = left.filter(keyed).select(*[F.col(k).alias(n) for k, n in zip(left_keys, names)])
    types = {f.name: f.dataType for f in right.schema.fields}

    if left_rows is not None and left_rows <= SMALL_LEFT:
        needed = table.join(F.broadcast(used), names, "left_semi")
        if all(types[v].simpleString() in _NARROW for v in values):
            needed = F.broadcast(needed)
        return left.join(needed, on, "left").select(*out)

    hot = (
        used.groupBy(*names).count()
        .filter(F.col("count") >= (HOT_ROWS if hot_rows is None else hot_rows))
        .orderBy(F.desc("count"), *names)
        .limit(HOT_KEYS)
        .select(*names)
    )
    hot_table = table.join(F.broadcast(hot), names, "left_semi")
    rows = left.filter(keyed)
    cold_part = rows.join(F.broadcast(hot), on, "left_anti").join(table, on, "left")
    hot_part = (
        rows.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(hot_table), on, "left")
    )
    unkeyed = left.filter(~keyed).select(
        *left.columns, *[F.lit(None).cast(types[v]).alias(v) for v in values]
    )
    return cold_part.select(*out).unionByName(hot_part.select(*out)).unionByName(unkeyed)
