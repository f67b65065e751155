"""Mixing sources to target weights by the cube method (balanced sampling).

A source's target over its size is how often a document is taken on average:
the whole part for certain, the fraction by chance. The fractions are moved
within the null-space of the balancing constraints (number of words, number of
documents) until all but a few are 0 or 1, so both totals stay what they were.
Cells of bounded size do this at the same time; the few documents a cell leaves
open are put together with those of other cells of the source and moved on,
until each source has no more open documents than constraints. That last,
small landing problem is settled by the outcome closest to the totals.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, row_key

WEIGHTS = (5.0, 2.0, 1.0)
#: A source's target is at most so many times its size.
MOST = 3.0
#: Documents of one cell, and how many cells' remainders go into the next.
CELL_ROWS = 4096
CELLS_IN_ONE = 512
#: Exchanges that may follow the landing of a source.
EXCHANGES = 3
SEED = 20
TINY = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, scratch: Scratch, most: float = MOST) -> DataFrame:
    """Rows (source, rows, source_size, target) from rows (source, size), or n times that.

    Sources weigh 5, 2, 1, repeating, by code point with null last. Targets sum
    to the total size; one over ``most`` times its source's size stops there
    and the others share the rest by weight, again until none is above. Only
    the one row per source that is left after the reduction is ranked.
    """
    from pyspark.sql import Window

    times = F.col("n") if "n" in sizes.columns else F.lit(1)
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * times).alias("source_size"), F.count("*").alias("rows")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")
    )
    totals = scratch.keep(totals.withColumn("weight", weight), "sources")
    limit = F.col("source_size") * F.lit(most)
    everything = totals.agg(F.sum("source_size")).first()[0] or 0
    level, settled = 0.0, -1
    while True:
        # Sources whose limit lies under the level are settled; it only rises.
        full = F.col("weight") * F.lit(level) > limit
        rest, weights, count = totals.agg(
            F.sum(F.when(full, limit)),
            F.sum(F.when(~full, F.col("weight"))),
            F.count_if(full),
        ).first()
        if count == settled or not weights:
            break
        settled, level = count, (everything - (rest or 0.0)) / weights
    return totals.select(
        "source",
        "rows",
        "source_size",
        F.least(F.col("weight") * F.lit(level), limit).alias("target"),
    )


def flight(chances: np.ndarray, balance: np.ndarray, rng) -> np.ndarray:
    """Move chances along the null-space of balance until it offers no direction.

    balance has a row per constraint. Few chances stay open at a time: one more
    than there are constraints always leaves a direction.
    """
    chances = chances.copy()
    width = len(balance) + 1
    waiting = [i for i in range(len(chances)) if TINY < chances[i] < 1 - TINY]
    chances[(chances <= TINY)] = 0.0
    chances[(chances >= 1 - TINY)] = 1.0
    waiting.reverse()
    held: list[int] = []
    while True:
        while waiting and len(held) < width:
            held.append(waiting.pop())
        if not held:
            return chances
        part = balance[:, held]
        way = _direction(part)
        if way is None:
            return chances
        now = chances[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(way > 0, (1 - now) / way, np.where(way < 0, -now / way, np.inf))
            down = np.where(way > 0, now / way, np.where(way < 0, (now - 1) / way, np.inf))
        up, down = up.min(), down.min()
        step = up if rng.random() * (up + down) < down else -down
        now = np.clip(now + step * way, 0.0, 1.0)
        now[now <= TINY], now[now >= 1 - TINY] = 0.0, 1.0
        chances[held] = now
        held = [i for i, c in zip(held, now, strict=True) if 0.0 < c < 1.0]


def _direction(part: np.ndarray) -> np.ndarray | None:
    """A vector that every constraint maps to zero; None where there is none."""
    rows = len(part)
    if part.shape[1] == 3 and rows == 2:
        way = np.cross(part[0], part[1])
        if np.abs(way).max() > TINY * max(1.0, np.abs(part).max()):
            return way / np.abs(way).max()
    _, sizes, axes = np.linalg.svd(part, full_matrices=True)
    rank = int((sizes > 1e-10 * max(1.0, sizes.max(initial=0.0))).sum())
    if rank == part.shape[1]:
        return None
    way = axes[-1]
    way[np.abs(way) < 1e-12] = 0.0
    return way / np.abs(way).max()


def landing(chances: np.ndarray, balance: np.ndarray) -> np.ndarray:
    """The outcome of the open chances that comes closest to the totals."""
    chances = chances.copy()
    left = np.nonzero((chances > 0) & (chances < 1))[0]
    if not len(left):
        return chances
    part = balance[:, left]
    aim = part @ chances[left]
    outcomes = np.array(list(product((0.0, 1.0), repeat=len(left))))
    scale = np.maximum(np.abs(part).max(axis=1, keepdims=True), 1.0)
    miss = (np.abs(part @ outcomes.T - aim[:, None]) / scale)[0]
    docs = np.abs(outcomes.sum(1) - chances[left].sum())
    chances[left] = outcomes[np.lexsort((docs, miss))[0]]
    return chances


def exchanged(taken: np.ndarray, size: np.ndarray, aim: float) -> np.ndarray:
    """taken with up to EXCHANGES pairs exchanged, one in for one out, to meet aim.

    What landing leaves open can be one long document; an exchange of two whose
    sizes differ by about what is missing makes up for it and keeps their number.
    """
    taken = taken.copy()
    for _ in range(EXCHANGES):
        miss = float(size @ taken) - aim
        into, out = np.nonzero(taken == 1)[0], np.nonzero(taken == 0)[0]
        if abs(miss) < 1 or not len(into) or not len(out):
            break
        out = out[np.argsort(size[out], kind="stable")]
        near = np.searchsorted(size[out], size[into] - miss)
        best = (abs(miss), -1, -1)
        for shift in (-1, 0):
            at = np.clip(near + shift, 0, len(out) - 1)
            left = np.abs(miss - size[into] + size[out[at]])
            k = int(np.argmin(left))
            if left[k] < best[0] - TINY:
                best = (left[k], int(into[k]), int(out[at[k]]))
        if best[1] < 0:
            break
        taken[best[1]], taken[best[2]] = 0.0, 1.0
    return taken


def _settler(turn: int, last: bool):
    """What moves the chances of one cell; in the last turn it also lands them."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        # Large documents first, so that what stays open to the end is small.
        rows = rows.sort_values(["size", "order"], ascending=[False, True], kind="stable")
        first = abs(int(rows["order"].min()))
        rng = np.random.default_rng([SEED, turn, first, len(rows)])
        size = rows["size"].to_numpy(dtype=float)
        balance = np.vstack([size / max(1.0, size.mean()), np.ones(len(rows))])
        wanted = rows["chance"].to_numpy(dtype=float)
        chance = flight(wanted, balance, rng)
        if last:
            chance = exchanged(landing(chance, balance), size, float(size @ wanted))
        return rows.assign(chance=chance)

    return settle


def _settled(
    docs: DataFrame, scratch: Scratch, id: str, text: str, source: str, most: float, cell_rows: int
) -> DataFrame:
    """Rows (doc, key, n, size, source_size, target, copies), one for n rows that are alike.

    ``copies`` is how often the mix takes them, all n together.
    """
    # Rows that are alike are one from here on, so no cell holds many of them.
    base = scratch.keep(
        docs.select(
            F.col(id).cast("string").alias("doc"),
            row_key(docs, id, source, text).alias("key"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
        )
        .groupBy("doc", "key", "source", "size")
        .agg(F.count("*").alias("n")),
        "sizes",
    )
    targets = scratch.keep(source_targets(base, scratch, most), "targets").select(
        F.col("source").alias("of"), "rows", "source_size", "target"
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    wanted = F.round(F.coalesce(ratio, F.lit(0.0)), 12) * F.col("n")
    wanted = F.when(F.col("size") > 0, wanted).otherwise(0.0)
    cells = F.ceil(F.col("rows") / cell_rows).cast("long")
    open_ = base.join(targets, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "doc",
        "key",
        "source",
        "size",
        "n",
        "source_size",
        "target",
        F.floor(wanted).alias("whole"),
        (wanted - F.floor(wanted)).alias("chance"),
        F.xxhash64(F.lit(SEED), "key").alias("order"),
        F.pmod(F.xxhash64(F.lit(SEED + 1), "key"), cells).alias("cell"),
        cells.alias("cells"),
    )
    open_ = open_.withColumn("drawn", F.col("chance") > 0)
    done = open_.filter(~F.col("drawn")).withColumn("chance", F.lit(0.0))
    open_ = open_.filter("drawn")
    most_cells = targets.agg(F.max(F.ceil(F.col("rows") / cell_rows))).first()[0] or 1
    parts, turn = [done], 0
    while True:
        last = most_cells <= 1
        settle = _settler(turn, last)
        moved = open_.groupBy("source", "cell").applyInPandas(settle, open_.schema)
        moved = scratch.keep(moved, f"turn-{turn}")
        parts.append(moved.filter("chance IN (0.0, 1.0)"))
        if last:
            break
        open_ = moved.filter("chance > 0 AND chance < 1").withColumn(
            "cell", F.floor(F.col("cell") / CELLS_IN_ONE)
        )
        most_cells, turn = -(-most_cells // CELLS_IN_ONE), turn + 1
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(
        "doc",
        "key",
        "n",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("chance")).cast("long").alias("copies"),
    )


def mix(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    most: float = MOST,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows (id, key, size, source_size, target, copies), one for each row of docs.

    A document's size is its number of words; null texts have none. ``copies``
    is how often the mix takes the document: 0 to ``most``. ``key`` names rows
    alike in id, source and text, nulls included; such rows share their copies
    evenly. It decides the order of the draw, so the result depends neither on
    partitions nor on reruns. Documents without words and those of a source without
    words are never taken. A null source is a source of its own; a null id is an
    ordinary id; an empty table gives an empty result; other columns are ignored.
    """
    settled = _settled(docs, scratch, id, text, source, most, cell_rows)
    each = settled.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    share = F.floor(F.col("copies") / F.col("n")) + (
        F.col("k") <= F.col("copies") % F.col("n")
    ).cast("long")
    return each.select(
        F.col("doc").cast(docs.schema[id].dataType).alias(id),
        "key",
        "size",
        "source_size",
        "target",
        share.alias("copies"),
    )


def mixed(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    most: float = MOST,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """docs with every row as often as the mix takes it; columns as they are.

    Rows alike in id, source and text share their copies evenly, in no order.
    """
    from pyspark.sql import Window

    settled = _settled(docs, scratch, id, text, source, most, cell_rows)
    taken = settled.filter("copies > 0").select(
        F.col("key").alias("mix__of"),
        F.col("copies").alias("mix__copies"),
        F.col("n").alias("mix__rows"),
    )
    keyed = docs.withColumn("mix__key", row_key(docs, id, source, text))
    joined = keyed.join(taken, F.col("mix__key") == F.col("mix__of"))
    alike = Window.partitionBy("mix__key").orderBy("mix__key")
    share = F.floor(F.col("mix__copies") / F.col("mix__rows")) + (
        F.row_number().over(alike) <= F.col("mix__copies") % F.col("mix__rows")
    ).cast("long")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix__share")))
    return (
        joined.withColumn("mix__share", share)
        .filter("mix__share > 0")
        .withColumn("mix__time", times)
        .select(*docs.columns)
    )
