"""Key joins in which a missing key matches a missing key.

No side is hinted: Catalyst broadcasts the right side when its files are below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where AQE
splits a hot key's rows on the left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]


def attach(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join right to left on one key; right must be unique on it."""
    match = f"{key}__right"
    right = right.withColumnRenamed(key, match)
    return left.join(right, F.col(key).eqNullSafe(F.col(match)), how).drop(match)


def largest_first(sizes: Sequence[int]) -> list[int]:
    """The order to attach tables of so many rows in.

    The largest are the ones that rows may have to be shuffled for, so they come while
    the rows do not carry what the others add. Columns and values do not depend on it.
    """
    return sorted(range(len(sizes)), key=lambda i: -sizes[i])


def attach_aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """attach() where both sides lie apart by the key already, so that neither is moved.

    Only a plain equality keeps that layout. So the one row of right without a key,
    if there is one, is put in by value.
    """
    match = f"{key}__right"
    values = [c for c in right.columns if c != key]
    none = right.filter(F.col(key).isNull()).first()
    known = right.filter(F.col(key).isNotNull()).withColumnRenamed(key, match)
    joined = left.join(known, F.col(key) == F.col(match), "left").drop(match)
    if none is None:
        return joined
    return joined.withColumns(
        {c: F.when(F.col(key).isNull(), F.lit(none[c])).otherwise(F.col(c)) for c in values}
    )


def rows_not_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left that agree with no row of right on all shared columns.

    Every copy of a matching row goes, unlike with ``exceptAll``.
    """
    shared = [c for c in left.columns if c in right.columns]
    match = {c: f"{c}__right" for c in shared}
    right = right.select(*shared).withColumnsRenamed(match)
    same = [F.col(c).eqNullSafe(F.col(r)) for c, r in match.items()]
    return left.join(right, same, "left_anti")


def seen_only(
    test: DataFrame, train: DataFrame, keys: Sequence[str], keep: Keep, name: str
) -> DataFrame:
    """Rows of test whose every key also occurs in train (cold-start filter)."""
    for key in keys:
        seen = keep(f"{name}_{key}", lambda key=key: train.select(key).distinct())
        test = attach(test, seen, key, "left_semi")
    return test
