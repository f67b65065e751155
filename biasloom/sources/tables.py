"""The driver's tables seen as ratings and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.operators.joins import attach

RATERS = ("customer", "basket")
INPUTS = ("lineitem", "orders", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(column: str) -> Column:
    """Seconds since 1970 of a zoneless timestamp, whatever the session's zone."""
    days = F.unix_date(F.to_date(column)).cast("long")
    return days * 86400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)


def bind_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat(
            F.col("p_type"), F.lit("|"), F.replace("p_name", F.lit(" "), F.lit("|"))
        ).alias("genres"),
    )


def bind_ratings(
    spark: SparkSession, sf_dir: str, rater: str = "customer"
) -> DataFrame:
    """Every order line as a rating of a part, with the part's attributes.

    The rater is the ordering customer, or the order itself ("basket"), which
    gives many raters with few ratings each.
    """
    if rater not in RATERS:
        raise ValueError(f"rater must be one of {RATERS}")
    lines = table(spark, sf_dir, "lineitem")
    if rater == "customer":
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        user = F.col("o_custkey")
    else:
        user = F.col("l_orderkey")
    ratings = lines.select(
        user.alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
        epoch_seconds("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
    )
    return attach(ratings, bind_items(spark, sf_dir), "item_id")
