"""Column names and types used across the package."""

from __future__ import annotations

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)

# The order in which effects are taken out of the rating: each level is fitted
# on what the levels before it leave over.
LEVELS = ("item_id", "user_id", "genres")

# What identifies one rating row of the bound tables.
ROW_KEY = ("order_id", "line_no", "item_id", "supplier_id")
