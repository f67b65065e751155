from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from biasloom.functions import residual
from biasloom.operators.effects import (
    effect_table,
    fit,
    global_mean,
    group_mean_on_rows,
    group_means_on_rows,
)
from biasloom.operators.scoring import Model, improvement, predict, score

SCHEMA = "user_id string, item_id string, rating double, genres string"
TRAIN = [
    ("u1", "i1", 5.0, "D"),
    ("u1", "i2", 3.0, "C"),
    ("u2", "i1", 4.0, "D"),
    ("u2", "i2", 2.0, "C"),
]
TEST = [("u1", "i1", 4.0, "D"), ("u2", "i2", 3.0, "C")]
COLD = [("u9", "i1", 3.0, "D"), ("u1", "i9", 3.0, "C")]
SETTINGS = {"plain": (0, 0, 0), "one": (1, 1, 1), "huge": (1e15, 1e15, 1e15)}


@pytest.fixture
def train(spark):
    return spark.createDataFrame(TRAIN, SCHEMA)


@pytest.fixture
def effects(train, keep):
    return fit(train, SETTINGS, keep, "fit")


def values(effects, level, setting):
    rows = effect_table(effects, level, setting, "b").collect()
    return {r[level]: r["b"] for r in rows}


def test_global_mean(train):
    assert global_mean(train).first()["mu"] == 3.5


@pytest.mark.parametrize(
    "level, plain, one",
    [
        ("item_id", {"i1": 1, "i2": -1}, {"i1": 2 / 3, "i2": -2 / 3}),
        ("user_id", {"u1": 0.5, "u2": -0.5}, {"u1": 1 / 3, "u2": -1 / 3}),
        ("genres", {"D": 0, "C": 0}, {"D": 2 / 9, "C": -2 / 9}),
    ],
)
def test_hand_computed_effects(effects, level, plain, one):
    assert values(effects, level, "plain") == pytest.approx(plain)
    assert values(effects, level, "one") == pytest.approx(one)
    small = values(effects, level, "huge").values()
    assert all(abs(b) < 1e-12 for b in small)


def test_counts_cover_every_row(effects):
    n = effect_table(effects, "genres", "one", "b").agg(F.sum("n")).first()[0]
    assert n == 4


def test_plain_model_on_seen_rows(spark, effects):
    test = spark.createDataFrame(TEST, SCHEMA)
    model = Model("m", 3, "plain")
    rows = predict(test, effects, model).collect()
    assert {r["item_id"]: r["r_hat"] for r in rows} == pytest.approx({"i1": 5, "i2": 2})
    assert score(test, effects, [model]).first()["rmse"] == pytest.approx(1.0)


@pytest.mark.parametrize("row", COLD)
def test_a_cold_row_makes_the_error_missing(spark, effects, row):
    test = spark.createDataFrame([*TEST, row], SCHEMA)
    models = [Model("mean", 0, "plain"), Model("full", 3, "plain")]
    rmse = {r["model"]: r["rmse"] for r in score(test, effects, models).collect()}
    assert rmse["full"] is None
    assert rmse["mean"] is not None


def test_missing_keys_get_their_own_effect(spark, keep):
    rows = [("u1", None, 5.0, None), ("u1", "i2", 2.0, "C"), (None, "i2", 2.0, "C")]
    df = spark.createDataFrame(rows, SCHEMA)
    effects = fit(df, {"plain": (0, 0, 0)}, keep, "nulls")
    assert values(effects, "item_id", "plain") == pytest.approx({None: 2.0, "i2": -1.0})
    model = Model("m", 3, "plain")
    hats = predict(df, effects, model).collect()
    assert len(hats) == 3 and all(r["r_hat"] is not None for r in hats)
    assert score(df, effects, [model]).first()["rmse"] == pytest.approx(0.0)


def test_group_mean_on_rows_equals_a_window(spark, keep):
    df = spark.range(500).select(
        "id",
        (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("item_id"),
        ((F.col("id") * 37 % 10 + 1) / 2).alias("rating"),
    )
    e = residual(2.5, [])
    ours = group_mean_on_rows(df, "item_id", e, "bi", keep, "w")
    window = df.withColumn("bi", F.avg(e).over(Window.partitionBy("item_id")))
    pairs = ours.join(window.withColumnRenamed("bi", "w"), "id")
    assert pairs.count() == 500
    assert pairs.filter("abs(bi - w) > 1e-12").count() == 0


def test_improvement_over_the_naive_model(spark):
    ladder = spark.createDataFrame([("a", 2.0), ("b", 1.5)], "model string, rmse double")
    rows = {r["model"]: r["improvement"] for r in improvement(ladder, "a").collect()}
    assert rows == {"a": 0.0, "b": 0.25}


def test_group_means_on_rows_equal_means_by_turns(spark, keep):
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 5 > 0, F.col("id") % 90).alias("user_id"),
        (F.col("id") % 11).alias("item_id"),
        ((F.col("id") * 37 % 10 + 1) / 2).alias("rating"),
    )
    first, second = residual(2.5, []), residual(2.5, ["bi"])
    rows = group_mean_on_rows(df, "item_id", first, "bi", keep, "t")
    turns = group_mean_on_rows(rows, "user_id", second, "bu", keep, "t")
    means = [("item_id", first, "bi"), ("user_id", second, "bu")]
    ours = group_means_on_rows(df, means, keep, "m")
    assert ours.columns == turns.columns
    pairs = ours.join(turns.select("id", *(F.col(c).alias(f"w_{c}") for c in ("bi", "bu"))), "id")
    assert pairs.filter("abs(bi - w_bi) <= 1e-12 AND abs(bu - w_bu) <= 1e-12").count() == 300


@pytest.mark.parametrize("many", ["user_id", "item_id"])
def test_the_largest_level_is_attached_first(spark, keep, many):
    few = "item_id" if many == "user_id" else "user_id"
    df = spark.range(60).select(
        F.col("id").alias(many),
        (F.col("id") % 3).alias(few),
        (F.col("id") % 5 + 0.5).alias("rating"),
        F.lit("g").alias("genres"),
    )
    fitted = fit(df, {"plain": (0.0, 0.0, 0.0)}, keep, "order")
    assert dict(zip(fitted.levels, fitted.sizes, strict=True)) == {many: 60, few: 3, "genres": 1}
    joined = fitted.join(df, 3, ["plain"])
    added = [c for c in joined.columns if c.startswith("effect_")]
    assert added == [f"effect_{level}_plain" for level in (many, few, "genres")]
