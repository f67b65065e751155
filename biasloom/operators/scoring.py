"""Predictions and their error."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biasloom.functions import rmse
from biasloom.operators.effects import Effects


@dataclass(frozen=True)
class Model:
    """A named model: how many levels it uses, and under which setting."""

    name: str
    depth: int
    setting: str


def predict(df: DataFrame, effects: Effects, model: Model) -> DataFrame:
    """df with ``r_hat``, NULL where a key was never seen."""
    joined = effects.join(df, model.depth, [model.setting])
    estimate = effects.prediction(model.depth, model.setting).alias("r_hat")
    return joined.select(*df.columns, estimate)


def score(test: DataFrame, effects: Effects, models: Sequence[Model]) -> DataFrame:
    """(model, rmse) for all models from one scan of test."""
    depth = max(m.depth for m in models)
    used = sorted({m.setting for m in models if m.depth})
    rows = test.select("rating", *effects.levels[:depth])
    joined = effects.join(rows, depth, used)
    errors = joined.agg(
        *[
            rmse(F.col("rating"), effects.prediction(m.depth, m.setting)).alias(m.name)
            for m in models
        ]
    )
    return errors.unpivot([], [m.name for m in models], "model", "rmse")


def improvement(ladder: DataFrame, naive: str) -> DataFrame:
    """Ladder with the share of the naive model's error that each one saves."""
    base = F.max(F.when(F.col("model") == naive, F.col("rmse")))
    rows = F.collect_list(F.struct("model", "rmse"))  # one entry per model
    return (
        ladder.agg(base.alias("base"), rows.alias("rows"))
        .select("base", F.inline("rows"))
        .select("model", "rmse", (1 - F.col("rmse") / F.col("base")).alias("improvement"))
    )
