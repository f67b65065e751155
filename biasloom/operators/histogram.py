"""Histogram counts: the data behind a bar chart, without the chart.

NaN counts as missing and falls into no bin; infinite values raise an error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.operators.joins import attach

# Width used when all values are equal.
FLAT_WIDTH = 0.1
# Bins that one group holds at most while runs of empty bins are looked for.
PAGE = 4096


def _present(df: DataFrame, column: str) -> tuple[DataFrame, Column]:
    """The rows with a value, and the value as a double."""
    value = F.col(column).cast("double")
    return df.filter(value.isNotNull() & ~F.isnan(value)), value


def _check(column: str, *ends: float) -> None:
    if any(math.isinf(end) for end in ends):
        raise ValueError(f"{column} has infinite values")


def _counts(df: DataFrame, bin_: Column, bins: int, center: Column) -> DataFrame:
    """Rows per bin, empty bins too; ``center`` is in terms of the column bin."""
    counted = df.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return attach(every, counted, "bin").select(
        "bin", center.alias("center"), F.coalesce("n", F.lit(0)).alias("n")
    )


def fixed_width(df: DataFrame, column: str, width: float, expand: bool = False) -> DataFrame:
    """Right-closed bins centred on multiples of width, from first to last value.

    Rows (bin, center, n, bins): one for each bin that holds a value (``bins`` is 1),
    and one for each run of empty bins, with its first bin and their number. So a
    result is never larger than twice the occupied bins, however far apart values
    lie. With ``expand``, rows (bin, center, n) with a row for every empty bin.

    The extent and every row's bin come from one expression, so that rounding
    puts no row outside.
    """
    rows, value = _present(df, column)
    finite = F.when(F.abs(value) < F.lit(math.inf), value)
    slot = F.ceil(finite / F.lit(float(width)) - 0.5)
    low, high, *ends = rows.agg(
        F.min(slot), F.max(slot), F.min(value), F.max(value)
    ).first()
    if ends[0] is None:
        none = _counts(rows, F.lit(0).cast("long"), 0, F.lit(0.0))
        return none if expand else none.withColumn("bins", F.lit(1).cast("long"))
    _check(column, *ends)
    center = (F.col("bin") + F.lit(low)) * F.lit(float(width))
    if expand:
        return _counts(rows, slot - F.lit(low), high - low + 1, center)
    counted = rows.groupBy((slot - F.lit(low)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return _with_gaps(counted, high - low + 1).select("bin", center.alias("center"), "n", "bins")


def _with_gaps(counted: DataFrame, span: int) -> DataFrame:
    """Rows (bin, n, bins) from rows (bin, n) with 0 <= bin < span: gaps are rows too."""
    before = _before(counted.select("bin", F.col("bin").alias("last"), "n"), span)
    gap = F.col("bin") - F.col("before") - 1
    own = F.struct("bin", "n", F.lit(1).cast("long").alias("bins"))
    empty = F.struct(
        (F.col("before") + 1).alias("bin"), F.lit(0).cast("long").alias("n"), gap.alias("bins")
    )
    both = F.when(gap > 0, F.array(empty, own)).otherwise(F.array(own))
    return before.select(F.inline(both))


def _before(rows: DataFrame, span: int) -> DataFrame:
    """Rows (bin, n, before) from rows (bin, last, n): ``last`` of the bin before.

    Bins are looked at in pages of PAGE; where a page begins, the pages themselves
    are looked at in the same way, so no task ever holds more than one page.
    """
    held = F.array_sort(F.collect_list(F.struct("bin", "last", "n")))
    pages = rows.groupBy(F.floor(F.col("bin") / PAGE).alias("page")).agg(held.alias("held"))
    shifted = F.concat(
        F.array(F.lit(None).cast("long")), F.transform("held", lambda h: h["last"])
    )
    inside = F.zip_with(
        "held",
        F.slice(shifted, F.lit(1), F.size("held")),
        lambda h, b: F.struct(h["bin"].alias("bin"), h["n"].alias("n"), b.alias("before")),
    )
    out = pages.select("page", F.inline(inside))
    if span > PAGE:
        firsts = pages.select(
            F.col("page").alias("bin"),
            F.element_at("held", -1)["last"].alias("last"),
            F.lit(0).cast("long").alias("n"),
        )
        above = _before(firsts, -(-span // PAGE)).select(
            "bin", F.col("before").alias("earlier")
        )
        out = attach(out, above.withColumnRenamed("bin", "page"), "page")
        out = out.withColumn("before", F.coalesce("before", "earlier"))
    return out.select("bin", "n", "before")


def fixed_count(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bins`` bins, the first centred on the minimum, the last on the maximum.

    Right-closed, the first one closed on both sides. Equal values give one bin.
    """
    rows, value = _present(df, column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if low is None:
        return _counts(rows, F.lit(0).cast("long"), 0, F.lit(0.0))
    _check(column, low, high)
    if low == high:
        bins, width, origin = 1, FLAT_WIDTH, low - FLAT_WIDTH / 2
    elif bins < 2:
        width, origin = high - low, low
    else:
        width = (high - low) / (bins - 1)
        origin = low - width / 2
    place = F.ceil((value - F.lit(origin)) / F.lit(width)) - 1
    bin_ = F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).cast("long")
    center = F.lit(origin) + (F.col("bin") + 0.5) * F.lit(width)
    return _counts(rows, bin_, bins, center)
