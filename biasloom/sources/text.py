"""Scans of ``::``-delimited text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from biasloom import schemas

Keep = Callable[..., DataFrame]

DELIMITER = "::"
MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")


def _rating_fields() -> tuple[dict[str, tuple[Column, DataType]], Column]:
    """Text and type of each field of a line, and what is wrong with it (else NULL).

    The reason is the wrong number of fields, or the names of those that can't be
    read. A field that is empty is NULL and no error.
    """
    parts = F.split(F.col("value"), DELIMITER)
    fields = {
        f.name: (F.get(parts, F.lit(i)), f.dataType) for i, f in enumerate(schemas.RATINGS)
    }
    unread = [
        F.when((text != "") & text.try_cast(kind).isNull(), F.lit(name))
        for name, (text, kind) in fields.items()
    ]
    named = F.concat_ws(", ", *unread)
    count = F.concat(F.size(parts).cast("string"), F.lit(" fields"))
    reason = F.when(F.size(parts) != len(fields), count).when(
        named != "", F.concat(F.lit("unreadable: "), named)
    )
    return fields, reason


def read_ratings(
    spark: SparkSession, path: str, mode: str = "FAILFAST"
) -> DataFrame:
    """Ratings, one ``user::item::rating::ts`` per line; empty lines are skipped.

    A line with missing, surplus or unreadable fields raises an error when it is
    read. "DROPMALFORMED" leaves such lines out and "PERMISSIVE" makes what
    can't be read NULL. A field that is empty is NULL and no error. Lines are
    split here, so that every line is looked at, whichever columns are used.
    ``split_ratings`` keeps such lines apart.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    fields, reason = _rating_fields()
    lines = spark.read.text(path).filter("value <> ''")
    if mode == "DROPMALFORMED":
        lines = lines.filter(reason.isNull())
    elif mode == "FAILFAST":
        error = F.raise_error(F.concat(F.lit("malformed line: "), "value"))
        lines = lines.filter(
            F.when(reason.isNotNull(), error.cast("boolean")).otherwise(True)
        )
    return lines.select(
        *(text.try_cast(kind).alias(name) for name, (text, kind) in fields.items())
    )


@dataclass(frozen=True)
class Split:
    """What one scan made of lines: rows, and the lines that are none.

    ``rejected`` has the line, the reason, the file, and the byte its split of the
    file begins at.
    """

    rows: DataFrame
    rejected: DataFrame


def split_ratings(spark: SparkSession, path: str, keep: Keep, name: str) -> Split:
    """Ratings, and the malformed lines with reason and place, from one read.

    Both are parts of one prepared table, so the text is split once, and every line
    that is not empty is in one of them.
    """
    fields, reason = _rating_fields()
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    judged = lines.filter("value <> ''").withColumn("reason", reason)
    bad = F.col("reason").isNotNull()
    placed = judged.select(
        *(F.when(~bad, text.try_cast(kind)).alias(n) for n, (text, kind) in fields.items()),
        F.when(bad, F.col("value")).alias("line"),
        "reason",
        F.when(bad, F.col("file")).alias("file"),
        F.when(bad, F.col("block")).alias("block"),
        bad.alias("is_rejected"),
    )
    whole = keep(name, lambda: placed, partition_by=["is_rejected"])
    return Split(
        whole.filter("NOT is_rejected").select(*fields),
        whole.filter("is_rejected").select("line", "reason", "file", "block"),
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items, one ``item::title::genres`` per line, in exactly three parts.

    The third part keeps any further delimiters and a missing part is empty.
    The CSV reader would drop the surplus, so lines are split here. An id that
    is no number becomes NULL.
    """
    parts = F.split(F.col("value"), DELIMITER, 3)
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).try_cast("long").alias("item_id"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("title"),
        F.coalesce(F.get(parts, F.lit(2)), F.lit("")).alias("genres"),
    )
