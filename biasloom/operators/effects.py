"""Additive effects: the mean, then one shrunk group mean per level.

Levels are fitted in order on what the earlier ones leave over, in a single
sequential pass. Several penalty settings (say plain and shrunk) share the
scans: each level keeps one residual sum per setting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.functions import level_effect, residual
from biasloom.operators.joins import Keep, attach, attach_aligned, largest_first
from biasloom.schemas import LEVELS
from biasloom.sources.store import Buckets

Settings = Mapping[str, Sequence[float]]


def total_column(setting: str) -> str:
    return f"total_{setting}"


def effect_column(level: str, setting: str) -> str:
    return f"effect_{level}_{setting}"


@dataclass(frozen=True)
class Effects:
    """A fitted model.

    ``stats`` holds one table per fitted level: the key, the row count ``n``
    and per setting the sum of residuals. Effects follow from them for any
    penalty, so changing the last level's penalty needs no refit.
    """

    mu: float
    settings: Settings
    stats: tuple[DataFrame, ...] = ()
    levels: Sequence[str] = LEVELS
    #: How the train rows and one level's table lie apart alike, if they do.
    buckets: Buckets | None = None
    #: Row counts of ``stats``.
    sizes: tuple[int, ...] = ()

    def level_table(self, i: int, settings: Sequence[str]) -> DataFrame:
        """Key and one effect column per setting."""
        key = self.levels[i]
        effects = []
        for s in settings:
            lam = self.settings[s][i]
            effect = level_effect(F.col(total_column(s)), F.col("n"), lam)
            effects.append(effect.alias(effect_column(key, s)))
        return self.stats[i].select(key, *effects)

    def join(self, df: DataFrame, depth: int, settings: Sequence[str]) -> DataFrame:
        """df with the effects of the first ``depth`` levels attached.

        The level that rows lie apart by comes first, while they still do, then the
        largest, while the rows are narrow.
        """
        aligned = self.buckets.key if self.buckets else None
        order = largest_first(self.sizes[:depth])
        for i in sorted(order, key=lambda i: self.levels[i] != aligned):
            join = attach_aligned if self.levels[i] == aligned else attach
            df = join(df, self.level_table(i, settings), self.levels[i])
        return df

    def effect_names(self, depth: int, setting: str) -> list[str]:
        return [effect_column(key, setting) for key in self.levels[:depth]]

    def prediction(self, depth: int, setting: str) -> Column:
        estimate = F.lit(self.mu)
        for name in self.effect_names(depth, setting):
            estimate = estimate + F.col(name)
        return estimate


def global_mean(train: DataFrame) -> DataFrame:
    return train.agg(F.avg("rating").alias("mu"))


def add_level(
    effects: Effects, train: DataFrame, keep: Keep, name: str
) -> Effects:
    """Fit the next level on the residuals of the levels so far.

    One scan of train: joins to the earlier levels' small tables, map-side
    partial sums per key, one exchange of partial sums. A hot key arrives as
    one partial sum per task.
    """
    depth = len(effects.stats)
    key = effects.levels[depth]

    def build() -> DataFrame:
        sums = []
        for s in effects.settings:
            rest = residual(effects.mu, effects.effect_names(depth, s))
            sums.append(F.sum(rest).alias(total_column(s)))
        rows = train.select("rating", *effects.levels[: depth + 1])
        joined = effects.join(rows, depth, list(effects.settings))
        return joined.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *sums)

    alike = {}
    if effects.buckets and effects.buckets.key == key:
        alike = {"buckets": effects.buckets}
    table = keep(f"{name}_{key}", build, **alike)
    return replace(
        effects, stats=(*effects.stats, table), sizes=(*effects.sizes, table.count())
    )


def fit(
    train: DataFrame,
    settings: Settings,
    keep: Keep,
    name: str,
    levels: Sequence[str] = LEVELS,
) -> Effects:
    """Fit every level for every setting; levels are scanned once each."""
    effects = Effects(global_mean(train).first()["mu"], settings, (), levels)
    for _ in levels:
        effects = add_level(effects, train, keep, name)
    return effects


def fit_aligned(
    train: DataFrame,
    settings: Settings,
    keep: Keep,
    name: str,
    buckets: Buckets,
    levels: Sequence[str] = LEVELS,
) -> Effects:
    """fit() for effect tables beyond broadcast size.

    The needed columns of train are written once, apart by ``buckets``, and the table
    of the level with that key alike: fitting it shuffles nothing, and later levels
    join it without moving a row. Any other level's join moves the rows once.
    """
    columns = ["rating", *levels]
    rows = keep(f"{name}_rows", lambda: train.select(*columns), buckets=buckets)
    effects = Effects(global_mean(rows).first()["mu"], settings, (), levels, buckets)
    for _ in levels:
        effects = add_level(effects, rows, keep, name)
    return effects


def effect_table(effects: Effects, level: str, setting: str, alias: str) -> DataFrame:
    """One level's effects as (key, n, effect)."""
    i = list(effects.levels).index(level)
    lam = effects.settings[setting][i]
    effect = level_effect(F.col(total_column(setting)), F.col("n"), lam)
    return effects.stats[i].select(level, "n", effect.alias(alias))


def group_mean_on_rows(
    df: DataFrame, key: str, value: Column, alias: str, keep: Keep, name: str
) -> DataFrame:
    """Every row with the mean of its group.

    Equal to an unordered window over the key, but groups are reduced before
    the shuffle instead of being gathered and sorted whole.
    """
    mean = F.avg(value).alias(alias)
    means = keep(f"{name}_{alias}", lambda: df.groupBy(key).agg(mean))
    return attach(df, means, key)


def group_means_on_rows(
    df: DataFrame, means: Sequence[tuple[str, Column, str]], keep: Keep, name: str
) -> DataFrame:
    """Every row with the means of its groups, each a (key, value, alias).

    A value may use the means before it. The same as group_mean_on_rows() by turns, but
    the largest table of means is attached first in the end, while the rows are narrow.
    """
    rows, tables = df, []
    for key, value, alias in means:
        mean = F.avg(value).alias(alias)
        table = keep(f"{name}_{alias}", lambda rows=rows: rows.groupBy(key).agg(mean))
        tables.append((key, table))
        rows = attach(rows, table, key)
    attached = df
    for i in largest_first([table.count() for _, table in tables]):
        attached = attach(attached, tables[i][1], tables[i][0])
    return attached.select(*rows.columns)
