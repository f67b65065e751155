"""Joint penalty grids: every combination of penalties, without refits.

A level's residual sums depend on the penalties before it only. So every
combination of earlier penalties (a prefix) is one more sum of the same scan,
and a level's table holds an array of sums per group, one for each prefix. The
last level needs no sums per point: a group's squared error is a quadratic in its
effect, so the whole last axis is arithmetic on the groups. A grid of any shape
costs one scan per level and block of prefixes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import islice, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.functions import level_effect
from biasloom.operators.effects import Effects, total_column
from biasloom.operators.joins import Keep, attach, largest_first
from biasloom.operators.tuning import Axis, best_point, lam_column

#: Prefixes whose sums one scan of rows takes.
PREFIXES = 32
#: Grid points one aggregate over the groups sums up.
POINTS = 96

Prefix = tuple[int, ...]


@dataclass(frozen=True)
class Block:
    """Some prefixes, and a table with an array of their sums for each group."""

    prefixes: Sequence[Prefix]
    table: DataFrame
    size: int  # rows of the table


def _blocks(axes: Sequence[Axis]) -> list[list[Prefix]]:
    """All places in the axes, the last varying fastest, in blocks."""
    every = product(*(range(axis.size) for axis in axes))
    blocks = []
    while block := list(islice(every, PREFIXES)):
        blocks.append(block)
    return blocks


def _value(axis: Axis, place: int) -> float:
    return round(axis.first + place * axis.step, 10)


class _Rows:
    """Rows with the sums of earlier levels at hand, and their residual for a prefix."""

    def __init__(
        self,
        effects: Effects,
        rows: DataFrame,
        levels: Sequence[list[Block]],
        prefixes: Sequence[Prefix],
        axes: Sequence[Axis],
    ):
        self.effects, self.axes = effects, axes
        self.sums: list[dict[Prefix, Column]] = []
        tables: list[tuple[DataFrame, str, int]] = []
        for depth, blocks in enumerate(levels):
            key, wanted = effects.levels[depth], {p[:depth] for p in prefixes}
            found = {}
            for b, block in enumerate(blocks):
                if wanted.isdisjoint(block.prefixes):
                    continue
                n, totals = f"n_{depth}_{b}", f"totals_{depth}_{b}"
                renamed = block.table.withColumnsRenamed({"n": n, "totals": totals})
                tables.append((renamed, key, block.size))
                for place, prefix in enumerate(block.prefixes):
                    found[prefix] = (F.get(totals, F.lit(place)), F.col(n))
            self.sums.append(found)
        for i in largest_first([size for _, _, size in tables]):
            rows = attach(rows, *tables[i][:2])
        self.rows = rows

    def residual(self, prefix: Prefix) -> Column:
        rest = F.col("rating") - F.lit(self.effects.mu)
        for depth, place in enumerate(prefix):
            total, n = self.sums[depth][prefix[:depth]]
            rest = rest - level_effect(total, n, _value(self.axes[depth], place))
        return rest


def _level(
    effects: Effects,
    train: DataFrame,
    levels: Sequence[list[Block]],
    axes: Sequence[Axis],
    keep: Keep,
    name: str,
) -> list[Block]:
    """The next level's sums for every prefix, one scan of train per block."""
    depth = len(levels)
    key = effects.levels[depth]
    out = []
    for b, prefixes in enumerate(_blocks(axes[:depth])):

        def build(prefixes=prefixes) -> DataFrame:
            rows = train.select("rating", *effects.levels[: depth + 1])
            at = _Rows(effects, rows, levels, prefixes, axes)
            sums = [F.sum(at.residual(p)).alias(f"s{k}") for k, p in enumerate(prefixes)]
            grouped = at.rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *sums)
            totals = F.array(*(F.col(f"s{k}") for k in range(len(prefixes))))
            return grouped.select(key, "n", totals.alias("totals"))

        table = keep(f"{name}_{key}_{b}", build)
        out.append(Block(prefixes, table, table.count()))
    return out


def _errors(
    effects: Effects,
    test: DataFrame,
    levels: Sequence[list[Block]],
    block: Block,
    axes: Sequence[Axis],
) -> DataFrame:
    """Per group of the last level: its train sums, and test counts and residual sums."""
    depth = len(axes) - 1
    key = effects.levels[depth]
    rows = test.select("rating", *effects.levels[: depth + 1])
    at = _Rows(effects, rows, levels, block.prefixes, axes)
    sums = [F.count(at.residual(block.prefixes[0])).alias("M"), F.count(F.lit(1)).alias("rows")]
    for k, prefix in enumerate(block.prefixes):
        e = at.residual(prefix)
        sums += [F.sum(e).alias(f"e{k}"), F.sum(e * e).alias(f"q{k}")]
    seen = at.rows.groupBy(key).agg(*sums)
    places = range(len(block.prefixes))
    seen = seen.select(
        key,
        "M",
        "rows",
        F.array(*(F.col(f"e{k}") for k in places)).alias("E"),
        F.array(*(F.col(f"q{k}") for k in places)).alias("Q"),
    )
    return attach(seen, block.table, key)


def joint_curve(
    effects: Effects,
    train: DataFrame,
    test: DataFrame,
    axes: Sequence[Axis],
    keep: Keep,
    name: str,
) -> DataFrame:
    """(grid_id, penalties, rmse) of every combination of penalties.

    ``effects`` is a model fitted on train with as many levels as there are axes, or
    more; its first level is reused, as it depends on no penalty. The first axis
    varies fastest in grid_id. RMSE is NULL where a test group was never seen in train.
    """
    setting = next(iter(effects.settings))
    first = effects.stats[0].select(
        effects.levels[0], "n", F.array(F.col(total_column(setting))).alias("totals")
    )
    levels: list[list[Block]] = [[Block([()], first, effects.sizes[0])]]
    while len(levels) < len(axes):
        levels.append(_level(effects, train, levels, axes, keep, name))
    last, before = axes[-1], levels[:-1]
    names = [lam_column(level) for level in effects.levels[: len(axes)]]
    strides = [math.prod(a.size for a in axes[:i]) for i in range(len(axes))]
    parts = []
    for b, block in enumerate(levels[-1]):
        groups = keep(
            f"{name}_groups_{b}", lambda block=block: _errors(effects, test, before, block, axes)
        )
        points = [(k, p, g) for k, p in enumerate(block.prefixes) for g in range(last.size)]
        for at in range(0, len(points), POINTS):
            some = points[at : at + POINTS]
            sums = []
            for k, _, g in some:
                place = F.lit(k)
                effect = level_effect(F.get("totals", place), F.col("n"), _value(last, g))
                squared = (
                    F.get("Q", place)
                    - 2 * effect * F.get("E", place)
                    + F.col("M") * effect * effect
                )
                sums.append(F.sum(squared).alias(f"sse_{k}_{g}"))
            complete = (F.count(F.lit(1)) == F.count("n")) & (F.sum("M") == F.sum("rows"))
            whole = groups.agg(complete.alias("complete"), F.sum("M").alias("M"), *sums)
            rows = []
            for k, prefix, g in some:
                places = (*prefix, g)
                grid_id = sum(i * s for i, s in zip(places, strides, strict=True))
                lams = [
                    F.lit(_value(axis, i)).alias(lam)
                    for axis, i, lam in zip(axes, places, names, strict=True)
                ]
                rmse = F.when(F.col("complete"), F.sqrt(F.col(f"sse_{k}_{g}") / F.col("M")))
                id_ = F.lit(grid_id).cast("long").alias("grid_id")
                rows.append(F.struct(id_, *lams, rmse.alias("rmse")))
            parts.append(whole.select(F.inline(F.array(*rows))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def tune_jointly(
    effects: Effects,
    train: DataFrame,
    test: DataFrame,
    axes: Sequence[Axis],
    keep: Keep,
    name: str,
) -> DataFrame:
    """The combination of penalties with the least error, the first one on ties."""
    return best_point(joint_curve(effects, train, test, axes, keep, name))
