"""Column expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Row hashes keep 60 of 64 bits, so that any two differ by less than a long.
HASH_BITS = 60
HASH_MAX = 2**HASH_BITS - 1


def rmse(actual: Column, estimate: Column) -> Column:
    """Root mean squared error; NULL as soon as one row has no error.

    ``avg`` alone would skip rows without a prediction and so hide them.
    """
    error = actual - estimate
    return F.when(
        F.count(F.lit(1)) == F.count(error), F.sqrt(F.avg(error * error))
    )


def whole_number(x: Column) -> Column:
    """True where x is integral; halves round to even."""
    return F.bround(x, 0) == x


def share(predicate: Column) -> Column:
    """Fraction of rows for which the predicate holds."""
    return F.avg(predicate.cast("double"))


def count_equal(x: Column, value: float) -> Column:
    return F.count_if(x == F.lit(value))


def count_missing(x: Column) -> Column:
    return F.count_if(x.isNull())


def distinct_with_null(x: Column) -> Column:
    """Exact distinct count in which a missing value counts as one value."""
    any_null = F.coalesce(F.max(x.isNull().cast("long")), F.lit(0))
    return F.count_distinct(x) + any_null


def residual(mu: float, effects: Iterable[str]) -> Column:
    """What is left of the rating after the mean and the named effects."""
    return reduce(lambda e, b: e - F.col(b), effects, F.col("rating") - F.lit(mu))


def level_effect(total: Column, n: Column, lam: Column | float) -> Column:
    """Group effect shrunk by the penalty; a penalty of zero is the plain mean."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    return total / (n + lam)


def row_hash(seed: int, key: Sequence[str]) -> Column:
    """A 60-bit number drawn from the row's own content and a seed.

    It does not depend on partitioning, row order or retries.
    """
    hashed = F.xxhash64(F.lit(seed).cast("long"), *key)
    return F.shiftrightunsigned(hashed, 64 - HASH_BITS)
