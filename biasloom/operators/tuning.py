"""Penalty tuning without refits.

For one level, with e the residual before it, a group's squared error after
subtracting b(lam) = S / (N + lam) is  Q - 2 b E + M b^2,  where S, N are train
sums and E, Q, M the test sums of e, e^2, 1. So a whole grid costs one scan of
test and then grid x groups arithmetic on the fitted level's own table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.functions import level_effect, residual
from biasloom.operators.effects import Effects, add_level, total_column
from biasloom.operators.joins import Keep, attach


@dataclass(frozen=True)
class Axis:
    """Values first, first + step, ... up to last."""

    first: float
    last: float
    step: float = 1.0

    @property
    def size(self) -> int:
        return math.floor((self.last - self.first) / self.step + 1e-10) + 1

    def at(self, i: Column) -> Column:
        return F.round(F.lit(float(self.first)) + i * F.lit(float(self.step)), 10)

    @classmethod
    def fixed(cls, value: float) -> Axis:
        return cls(value, value)


def _grid_rows(axes: Mapping[str, Axis]) -> Column:
    """All combinations of the axes, the first varying fastest."""
    total = math.prod(a.size for a in axes.values())

    def point(i: Column) -> Column:
        fields, stride = [i.cast("long").alias("grid_id")], 1
        for name, axis in axes.items():
            fields.append(axis.at(F.floor(i / stride) % axis.size).alias(name))
            stride *= axis.size
        return F.struct(*fields)

    return F.transform(F.sequence(F.lit(0), F.lit(total - 1)), point)


def param_grid(spark: SparkSession, axes: Mapping[str, Axis]) -> DataFrame:
    return spark.range(1).select(F.inline(_grid_rows(axes)))


def lam_column(level: str) -> str:
    return {"item_id": "lam_item", "user_id": "lam_user", "genres": "lam_genre"}[level]


def tuning_curve(
    effects: Effects, test: DataFrame, depth: int, setting: str, axis: Axis
) -> DataFrame:
    """(grid_id, penalties, rmse) of level ``depth`` over an axis of penalties.

    Earlier levels keep the setting's penalties. RMSE is NULL when a test
    group was never seen in train.
    """
    key = effects.levels[depth]
    rows = test.select("rating", *effects.levels[: depth + 1])
    e = residual(effects.mu, effects.effect_names(depth, setting))
    seen = (
        effects.join(rows, depth, [setting])
        .select(key, e.alias("e"))
        .groupBy(key)
        .agg(
            F.count("e").alias("M"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("e").alias("E"),
            F.sum(F.col("e") * F.col("e")).alias("Q"),
        )
    )
    fitted = effects.stats[depth].select(
        key, "n", F.col(total_column(setting)).alias("S")
    )
    axes = {
        lam_column(k): Axis.fixed(effects.settings[setting][i])
        for i, k in enumerate(effects.levels[:depth])
    }
    axes[lam_column(key)] = axis
    b = level_effect(F.col("S"), F.col("n"), F.col(lam_column(key)))
    sse = F.col("Q") - 2 * b * F.col("E") + F.col("M") * b * b
    complete = (F.count(F.lit(1)) == F.count("S")) & (F.sum("M") == F.sum("rows"))
    return (
        attach(seen, fitted, key)
        .select("M", "rows", "E", "Q", "S", "n", F.inline(_grid_rows(axes)))
        .groupBy("grid_id", *axes)
        .agg(F.when(complete, F.sqrt(F.sum(sse) / F.sum("M"))).alias("rmse"))
    )


def best_point(curve: DataFrame) -> DataFrame:
    """The grid row of least error, the first one on ties."""
    lams = [c for c in curve.columns if c.startswith("lam_")]
    best = F.min(F.struct("rmse", "grid_id", *lams)).alias("best")
    return curve.filter(F.col("rmse").isNotNull()).agg(best).select("best.*")


def tune(
    effects: Effects,
    train: DataFrame,
    test: DataFrame,
    axes: Sequence[Axis],
    keep: Keep,
    name: str,
) -> DataFrame:
    """Tune level after level, each with the best penalties before it.

    ``effects`` is a model fitted on train. Its first level is reused: residuals
    from the mean depend on no penalty. Returns the last level's best grid row,
    that is every penalty and the error.
    """
    key, setting = effects.levels[0], next(iter(effects.settings))
    total = F.col(total_column(setting)).alias(total_column("tuned"))
    first = effects.stats[0].select(key, "n", total)
    tuned = replace(effects, settings={"tuned": ()}, stats=(first,), sizes=effects.sizes[:1])
    for depth, axis in enumerate(axes):
        curve = tuning_curve(tuned, test, depth, "tuned", axis)
        if depth == len(axes) - 1:
            return best_point(curve)
        best = best_point(curve).first()
        lams = (*tuned.settings["tuned"], best[lam_column(effects.levels[depth])])
        tuned = replace(tuned, settings={"tuned": lams})
        tuned = add_level(tuned, train, keep, name)
    raise ValueError("no axis to tune over")
