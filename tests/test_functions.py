from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from biasloom.functions import (
    count_missing,
    distinct_with_null,
    rmse,
    row_hash,
    share,
    whole_number,
)


def one(df, column):
    return df.agg(column.alias("x")).first()["x"]


def test_rmse_is_null_when_a_prediction_is_missing(spark):
    good = spark.createDataFrame([(5.0, 4.0), (3.0, 1.0)], "a double, b double")
    assert one(good, rmse(F.col("a"), F.col("b"))) == math.sqrt(2.5)
    bad = good.unionByName(spark.createDataFrame([(3.0, None)], good.schema))
    assert one(bad, rmse(F.col("a"), F.col("b"))) is None


def test_rmse_against_a_constant(spark):
    df = spark.createDataFrame([(5.0,), (3.0,)], "a double")
    assert one(df, rmse(F.col("a"), F.lit(4.0))) == 1.0


def test_whole_number_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 2.5, 3.0)], "x double")
    flags = df.select("x", whole_number(F.col("x")).alias("w")).collect()
    assert {r["x"]: r["w"] for r in flags} == {0.5: False, 1: True, 2.5: False, 3: True}
    assert one(df, share(whole_number(F.col("x")))) == 0.5


def test_distinct_counts_a_missing_value_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "x int")
    assert one(df, distinct_with_null(F.col("x"))) == 2
    assert one(df.filter("x = 1"), distinct_with_null(F.col("x"))) == 1
    assert one(df.limit(0), distinct_with_null(F.col("x"))) == 0


def test_nan_is_not_missing(spark):
    df = spark.createDataFrame([(math.nan,), (None,)], "x double")
    assert one(df, count_missing(F.col("x"))) == 1


def test_row_hash_depends_on_content_and_seed_only(spark):
    df = spark.range(1000).withColumn("b", F.col("id") % 7)
    hashed = df.select("id", row_hash(1, ["id", "b"]).alias("h"))
    again = df.repartition(13).select("id", row_hash(1, ["id", "b"]).alias("h"))
    assert sorted(hashed.collect()) == sorted(again.collect())
    values = [r["h"] for r in hashed.collect()]
    assert len(set(values)) == 1000
    assert 0 <= min(values) and max(values) < 2**60
    other = df.select("id", row_hash(2, ["id", "b"]).alias("h"))
    assert sorted(hashed.collect()) != sorted(other.collect())


@pytest.mark.parametrize("seed", [1, 50])
def test_row_hash_matches_its_sql_form(spark, seed):
    import duckdb

    from biasloom.plans.oracles import _row_hash

    df = spark.range(200).select("id", (F.col("id") * 97 + 3).alias("b"))
    ours = df.select("id", row_hash(seed, ["id", "b"]).alias("h")).collect()
    sql = f"""SELECT id, CAST({_row_hash(seed, 'id, b')} >> 4 AS BIGINT) AS h
              FROM (SELECT range AS id, range * 97 + 3 AS b FROM range(200))"""
    assert sorted(map(tuple, ours)) == sorted(duckdb.sql(sql).fetchall())
