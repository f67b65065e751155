"""Exploratory summaries of a rating table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biasloom.functions import count_equal, count_missing, share, whole_number

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Neighbouring whole numbers that share a bitmap, and the rows that make one worth it.
BITMAP = 32_768
ROWS_A_BITMAP = 512


def preview(df: DataFrame, order: Sequence[str], n: int = 6) -> DataFrame:
    return df.orderBy(*order).limit(n)


def dimensions(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
    )


def equal_counts(df: DataFrame, column: str, named: Mapping[str, float]) -> DataFrame:
    return df.agg(*[count_equal(F.col(column), v).alias(k) for k, v in named.items()])


def match_counts(df: DataFrame, column: str, named: Mapping[str, str]) -> DataFrame:
    """Rows whose string contains a match, one count per named pattern.

    Patterns run once per distinct string, not once per row.
    """
    strings = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = []
    for name, pattern in named.items():
        hit = F.when(F.col(column).rlike(pattern), F.col("n")).otherwise(0)
        counts.append(F.coalesce(F.sum(hit), F.lit(0)).alias(name))
    return strings.agg(*counts)


def whole_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(share(whole_number(F.col(column))).alias("whole_share"))


def _dense(df: DataFrame, columns: Iterable[str]) -> set[str]:
    """Columns of whole numbers that lie close enough together for bitmaps."""
    whole = sorted({c for c in columns if isinstance(df.schema[c].dataType, WHOLE)})
    if not whole:
        return set()
    ends = [f(F.col(c).cast("long")) for c in whole for f in (F.min, F.max)]
    rows, *found = df.agg(F.count(F.lit(1)), *ends).first()
    dense = set()
    for column, low, high in zip(whole, found[::2], found[1::2], strict=True):
        bitmaps = 0 if low is None else (high - low) // BITMAP + 1
        if bitmaps * ROWS_A_BITMAP <= max(rows, ROWS_A_BITMAP):
            dense.add(column)
    return dense


def _distinct(df: DataFrame, column: str, dense: bool) -> DataFrame:
    """One row (n): the exact number of distinct values, a missing value being one.

    Dense whole numbers are marked in bitmaps, one for BITMAP neighbouring ones, so a
    task sends a bit for a value, however often it has it. Others are grouped by.
    """
    if not dense:
        grouped = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
        return grouped.agg(F.count(F.lit(1)).alias("n"))
    value = F.col(column).cast("long")
    # Missing values have a bucket of their own, without a bit.
    marked = df.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"),
        F.max(value.isNull().cast("long")).alias("missing"),
    )
    held = F.bitmap_count("bits") + F.col("missing")
    return marked.agg(F.coalesce(F.sum(held), F.lit(0)).cast("long").alias("n"))


def _side_by_side(parts: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """One row of the one-row results, each of which has some of the columns."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*(F.first(name, ignorenulls=True).alias(name) for name in names))


def distinct_counts(df: DataFrame, named: Mapping[str, str]) -> DataFrame:
    """One row with the exact number of distinct values of each column.

    Each column is read on its own, so no row is multiplied by the number of columns.
    """
    dense = _dense(df, named.values())
    parts = [
        _distinct(df.select(column), column, column in dense).select(F.col("n").alias(name))
        for name, column in named.items()
    ]
    return _side_by_side(parts, list(named))


def missing_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing values, in one pass."""
    counts = df.agg(*[count_missing(F.col(c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "n_missing")


def summary(df: DataFrame) -> DataFrame:
    named = {"n_users": "user_id", "n_items": "item_id"}
    extent = df.agg(F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"))
    names = [*named, "min_rating", "max_rating"]
    return _side_by_side([distinct_counts(df, named), extent], names)


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def most_frequent(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return frequency(df, *columns).orderBy(F.desc("n"), *columns).limit(k)
