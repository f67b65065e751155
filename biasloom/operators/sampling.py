"""Stratified sampling without replacement, and the splits built on it.

A sample is a rule on a row's own content: a stratum (the quartile bin of a
numeric outcome) and a hash threshold per stratum chosen so that exactly
``ceil(p * n)`` rows fall below it. Finding the rule takes three scans: a sketch
of the outcome, one count by outcome and hash range, and the rows of the one
hash range per stratum that the threshold lies in. Applying it is a filter,
without shuffle, rank or row position.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from biasloom.functions import row_hash
from biasloom.functions.columns import HASH_BITS, HASH_MAX
from biasloom.operators.joins import Keep, attach
from biasloom.sources.store import TableStore

BUCKETS = 4096
RANGE_BITS = 12
COPY_CHUNK = 1_000_000
#: Rows around the thresholds that are looked at on the driver; more, on the executors.
EDGE_ROWS = 50_000
COPY = "_copy"
QUARTILES = (0.25, 0.5, 0.75)
# A wanted rank is looked for within so many shares of the rows around it, as
# a sketch of this accuracy places it; beyond them it is looked for everywhere.
BRACKET = 2e-4
ACCURACY = 10_000


def literal(x: float | int) -> str:
    """x as a SQL double or bigint, to the last bit."""
    return f"{x!r}D" if isinstance(x, float) else f"{x}L"


def case(branches: Iterable[tuple[str, object]]) -> str:
    """A SQL CASE over (condition, result) pairs, NULL when there are none."""
    whens = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches)
    return f"CASE {whens} END" if whens else "NULL"


@dataclass(frozen=True)
class OrderStatistic:
    value: float | int
    below: int  # rows of the stratum with a smaller value
    equal: int  # rows of the stratum with this value


def order_statistics(
    df: DataFrame,
    value: Column,
    spans: Mapping[tuple[int, int], tuple[float | int, float | int, int]],
    stratum: Column | None = None,
    weight: Column | None = None,
) -> dict[tuple[int, int], OrderStatistic]:
    """The value at each (stratum, rank), ranks counted from 0.

    A row of df stands for ``weight`` rows, for one by default.

    ``spans`` gives for each of them an interval that holds it and the number
    of rows below that interval. Every round counts the rows of an interval
    in BUCKETS equal buckets and narrows each rank to the bucket that holds it,
    until that bucket has one value. A round is one scan with map-side
    counting; no sort or window ever sees more than BUCKETS rows per rank,
    however many rows or copies exist.
    """
    stratum = F.lit(0) if stratum is None else stratum
    weight = F.lit(1) if weight is None else weight
    rows = df.select(
        stratum.alias("stratum"), value.alias("value"), weight.alias("weight")
    )
    found: dict[tuple[int, int], OrderStatistic] = {}
    while spans:
        cells = sorted({(s, lo, hi) for (s, _), (lo, hi, _) in spans.items()})
        cell_of = {cell: i for i, cell in enumerate(cells)}
        cell = case(
            (f"stratum = {s} AND value BETWEEN {literal(lo)} AND {literal(hi)}", i)
            for (s, lo, hi), i in cell_of.items()
        )
        start = case((f"cell = {i}", literal(lo)) for (_, lo, _), i in cell_of.items())
        width = case(
            (f"cell = {i}", literal(float(hi - lo) or 1.0))
            for (_, lo, hi), i in cell_of.items()
        )
        bucket = f"least(floor((value - {start}) / {width} * {BUCKETS}), {BUCKETS - 1})"
        # Rows of no interval share one group, which no rank asks for. Dropping
        # them first would evaluate the value once more per interval.
        counts = (
            rows.select(F.expr(cell).alias("cell"), "value", "weight")
            .groupBy("cell", F.expr(bucket).alias("bucket"))
            .agg(
                F.sum("weight").alias("n"),
                F.min("value").alias("lo"),
                F.max("value").alias("hi"),
            )
        )
        upto = F.sum("n").over(Window.partitionBy("cell").orderBy("bucket"))
        wanted = " OR ".join(
            f"(cell = {cell_of[s, lo, hi]} AND before <= {rank - offset}"
            f" AND {rank - offset} < before + n)"
            for (s, rank), (lo, hi, offset) in spans.items()
        )
        # At most one row per wanted rank reaches the driver.
        hits = (
            counts.withColumn("before", upto - F.col("n"))
            .filter(wanted)
            .collect()
        )
        narrowed = {}
        for (s, rank), (lo, hi, offset) in spans.items():
            hit = next(
                h
                for h in hits
                if h["cell"] == cell_of[s, lo, hi]
                and h["before"] <= rank - offset < h["before"] + h["n"]
            )
            below = offset + hit["before"]
            if hit["lo"] == hit["hi"]:
                found[s, rank] = OrderStatistic(hit["lo"], below, hit["n"])
            else:
                narrowed[s, rank] = (hit["lo"], hit["hi"], below)
        spans = narrowed
    return found


def _ordered(
    rows: Sequence[Row], spans: Mapping[tuple[int, int], tuple[int, int, int]]
) -> dict[tuple[int, int], OrderStatistic]:
    """order_statistics() of few rows (stratum, hash, count)."""
    found = {}
    for (s, rank), (lo, hi, below) in spans.items():
        for value, n in sorted((r["hash"], r["count"]) for r in rows if r["stratum"] == s):
            if lo <= value <= hi:
                if rank < below + n:
                    found[s, rank] = OrderStatistic(value, below, n)
                    break
                below += n
    return found


def outcome_value(column: str) -> Column:
    """The outcome as a double; NaN counts as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


@dataclass(frozen=True)
class Sketch:
    """Where the wanted quantiles lie, from one scan.

    ``inside`` are closed intervals, apart from one another, that hold the
    wanted ranks unless the sketch is off. Cell 2k is what lies before interval
    k (or behind the last one), cell 2k + 1 is interval k.
    """

    column: str
    low: float
    high: float
    n: int
    inside: Sequence[tuple[float, float]]

    def cell(self) -> Column:
        """The cell of a row; NULL where the outcome is missing."""
        value = outcome_value(self.column)
        over = [(value >= lo).cast("int") + (value > hi).cast("int") for lo, hi in self.inside]
        return sum(over, F.when(value.isNotNull(), 0))

    def gap(self, cell: int) -> tuple[float, float]:
        """The ends of an even cell: of the intervals beside it, or of all values."""
        k = cell // 2
        low = self.inside[k - 1][1] if k else self.low
        return low, self.inside[k][0] if k < len(self.inside) else self.high


def sketch(
    df: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES
) -> Sketch | None:
    """One scan: extent, size, and an interval around each quantile.

    Nothing when the column has no value. Infinite values have no quantiles to
    lie between and raise an error.
    """
    value = outcome_value(column)
    around = [
        min(1.0, max(0.0, p + d)) for p in probabilities for d in (-BRACKET, BRACKET)
    ]
    found = df.agg(
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.count(value).alias("n"),
        F.percentile_approx(value, around, ACCURACY).alias("around"),
    ).first()
    if not found["n"]:
        return None
    if math.isinf(found["low"]) or math.isinf(found["high"]):
        raise ValueError(f"{column} has infinite values")
    inside: list[tuple[float, float]] = []
    for lo, hi in zip(found["around"][::2], found["around"][1::2], strict=True):
        if inside and lo <= inside[-1][1]:
            inside[-1] = (inside[-1][0], max(hi, inside[-1][1]))
        else:
            inside.append((lo, hi))
    return Sketch(column, found["low"], found["high"], found["n"], inside)


def cell_counts(df: DataFrame, at: Sketch, *by: Column) -> DataFrame:
    """Rows (cell, value, ..., n): one scan that counts rows by cell and by ``by``.

    ``value`` is there within the sketch's intervals only, so what is left is
    small whatever the values are.
    """
    cell = at.cell()
    value = F.when(cell % 2 == 1, outcome_value(at.column))
    return df.groupBy(cell.alias("cell"), value.alias("value"), *by).agg(
        F.count(F.lit(1)).alias("n")
    )


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float] = QUARTILES,
    keep: Keep | None = None,
) -> list[float]:
    """Exact quantiles of a numeric column, interpolated between neighbours.

    Returns the minimum, one value per probability, and the maximum; nothing
    when the column has no value. Two scans, however the values are spread.
    """
    at = sketch(df, column, probabilities)
    if at is None:
        return []
    keep = keep or default_keep(df)
    counts = keep("quantile_counts", lambda: cell_counts(df, at))
    return exact_quantiles(df, at, counts, probabilities)


def exact_quantiles(
    df: DataFrame,
    at: Sketch,
    counts: DataFrame,
    probabilities: Sequence[float] = QUARTILES,
) -> list[float]:
    """The quantiles from cell_counts' result; df is scanned if the sketch is off."""
    sizes = counts.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n"))
    size = {r["cell"]: r["n"] for r in sizes.collect()}
    places = [(at.n - 1) * p for p in probabilities]
    ranks = sorted({r for h in places for r in (math.floor(h), math.ceil(h))})
    near, far = {}, {}
    for rank in ranks:
        below = 0
        for cell in sorted(size):
            if rank < below + size[cell]:
                break
            below += size[cell]
        ends = at.inside[cell // 2] if cell % 2 else at.gap(cell)
        (near if cell % 2 else far)[cell, rank - below] = (*ends, 0)
    value_at = {}
    stats = order_statistics(
        counts.filter("value IS NOT NULL"), F.col("value"), near, F.col("cell"), F.col("n")
    )
    if far:
        rows = df.withColumns({"_cell": at.cell(), "_value": outcome_value(at.column)})
        stats |= order_statistics(rows, F.col("_value"), far, F.col("_cell"))
    total = 0
    for cell in sorted(size):
        for (c, rank), found in stats.items():
            if c == cell:
                value_at[total + rank] = found.value
        total += size[cell]
    inner = []
    for h in places:
        a, b = value_at[math.floor(h)], value_at[math.ceil(h)]
        inner.append(a + (b - a) * (h - math.floor(h)))
    return [at.low, *inner, at.high]


def _breaks(breaks: Sequence[float]) -> list[float]:
    """The breaks that part something: inside the extent, each one once."""
    return sorted({b for b in breaks[1:-1] if breaks[0] < b < breaks[-1]})


def _bin(value: Column, breaks: Sequence[float]) -> Column:
    above = [(value > F.lit(b)).cast("int") for b in _breaks(breaks)]
    return F.when(value.isNull(), -1).otherwise(sum(above, F.lit(0)))


def quartile_bin(outcome: str, breaks: Sequence[float]) -> Column:
    """Right-closed quartile bin of the outcome, -1 where it is missing or NaN."""
    return _bin(outcome_value(outcome), breaks)


def default_keep(df: DataFrame) -> Keep:
    """Where intermediate counts go if the caller names no store."""
    return TableStore(df.sparkSession, "samples").keep


@dataclass(frozen=True)
class Sample:
    """A fitted sampling rule.

    ``thresholds`` maps a stratum to the largest hash that is sampled whole.
    Rows in ``groups``, each a (stratum, hash), follow ``ties`` instead, which
    takes a quota out of every group: the rows at a threshold of which only
    some fit. ``number``, where rows have no identifying key, gives copies of a
    row their numbers before anything else.
    """

    stratum: Column
    hash: Column
    thresholds: dict[int, int]
    groups: Sequence[tuple[int, int]] = ()
    group_column: str = "_group"
    ties: Sample | Copies | None = None
    number: Callable[[DataFrame], DataFrame] | None = None
    mark: tuple = field(default=(), compare=False)

    def flagged(self, df: DataFrame) -> DataFrame:
        """The rows of df with a Boolean column ``in_sample``."""
        if self.number is not None:
            flagged = self._flagged(self.number(df))
            return flagged.select(*df.columns, "in_sample")
        return self._flagged(df)

    def _flagged(self, df: DataFrame) -> DataFrame:
        placed = df.withColumns({"_stratum": self.stratum, "_hash": self.hash})
        limit = case((f"_stratum = {s}", literal(t)) for s, t in self.thresholds.items())
        flag = F.expr(f"coalesce(_hash <= {limit}, false)")
        if self.ties is None:
            return placed.select(*df.columns, flag.alias("in_sample"))
        group = self.group_column
        placed = placed.withColumn(group, F.expr(group_index(self.groups)))
        whole = placed.filter(F.col(group).isNull())
        tied = placed.filter(F.col(group).isNotNull()).select(*df.columns, group)
        tied = self.ties.flagged(tied).drop(group)
        return whole.select(*df.columns, flag.alias("in_sample")).unionByName(tied)

    def rows(self, df: DataFrame) -> DataFrame:
        """The sampled rows only."""
        return self.flagged(df).filter("in_sample").drop("in_sample")


def group_index(groups: Sequence[tuple[int, int]]) -> str:
    """The position of (_stratum, _hash) in groups, as SQL."""
    return case(
        (f"_stratum = {s} AND _hash = {literal(h)}", i)
        for i, (s, h) in enumerate(groups)
    )


def numbered(df: DataFrame, keep: Keep | None = None) -> DataFrame:
    """df with the copies of each row numbered from 0, in the column ``_copy``.

    Copies are counted, on the map side first, and laid out again from the
    counts, which ``keep`` prepares. A row of very many copies is laid out in
    chunks, in parallel, so that any number of them is no hot task.
    """

    def count() -> DataFrame:
        return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))

    groups = keep("copies", count) if keep else count()
    copies = F.col("_copies")
    few = groups.filter(copies <= COPY_CHUNK).withColumn(
        COPY, F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))
    )
    last_chunk = F.floor((copies - 1) / COPY_CHUNK)
    first = F.col("_chunk") * COPY_CHUNK
    last = F.least(first + COPY_CHUNK, "_copies") - 1
    # A fixed partition count: AQE would merge the few, tiny chunk rows.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        groups.filter(copies > COPY_CHUNK)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .repartition(tasks, "_chunk")
        .withColumn(COPY, F.explode(F.sequence(first, last)))
    )
    columns = [*df.columns, COPY]
    return few.select(*columns).unionByName(many.select(*columns))


@dataclass(frozen=True)
class Copies:
    """Groups of rows alike in every column, each with a number of them to sample."""

    group_column: str
    quotas: dict[int, int]

    def flagged(self, df: DataFrame) -> DataFrame:
        """The copies of a group numbered; those with the first numbers are in."""
        rows = numbered(df)
        group = self.group_column
        quota = F.expr(case((f"{group} = {g}", f"{n}L") for g, n in self.quotas.items()))
        # One content per group, unless two contents share a 60-bit hash.
        before = Window.partitionBy(group).orderBy(*df.columns)
        sizes = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        upto = F.sum("_copies").over(before) - F.col("_copies")
        offsets = sizes.select(*(F.col(c).alias(f"_of_{c}") for c in df.columns), upto.alias("_upto"))
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in df.columns]
        inside = (F.col(COPY) + F.col("_upto")) < quota
        return rows.join(offsets, same).select(*df.columns, inside.alias("in_sample"))


def _range(hashed: Column) -> Column:
    return F.shiftright(hashed, HASH_BITS - RANGE_BITS)


@dataclass(frozen=True)
class Stratum:
    quota: int
    span: tuple[int, int, int] | None  # the hash range of the quota's last row
    rows: int = 0  # rows in that range


def _strata(counts: DataFrame, quota: Column) -> dict[int, Stratum]:
    """Quota of every stratum and where it ends, from rows (stratum, range, n)."""
    ranges = counts.groupBy("stratum", "range").agg(F.sum("n").alias("n"))
    per_stratum = Window.partitionBy("stratum")
    upto = F.sum("n").over(per_stratum.orderBy("range"))
    holds = F.expr("before < quota AND quota <= before + n")
    # One row per stratum.
    rows = (
        ranges.withColumns(
            {"total": F.sum("n").over(per_stratum), "before": upto - F.col("n")}
        )
        .withColumn("quota", quota)
        .groupBy("stratum", "quota")
        .agg(F.max(F.when(holds, F.struct("range", "before", "n"))).alias("at"))
        .collect()
    )
    width = HASH_BITS - RANGE_BITS
    return {
        r["stratum"]: Stratum(
            r["quota"],
            r["at"]
            and (
                r["at"]["range"] << width,
                min(HASH_MAX, ((r["at"]["range"] + 1) << width) - 1),
                r["at"]["before"],
            ),
            r["at"]["n"] if r["at"] else 0,
        )
        for r in rows
    }


def _select(
    df: DataFrame,
    stratum: Column,
    quota: Column,
    seed: int,
    keys: Sequence[Sequence[str]],
    keep: Keep,
    counts: DataFrame | None = None,
) -> Sample:
    """The rule that takes exactly ``quota`` rows of each stratum.

    ``quota`` may refer to a stratum's number and to its row count, ``total``.
    ``counts`` has rows (stratum, range, n) where they are known already.
    """
    hashed = row_hash(seed, keys[0])
    rows = df.select(stratum.alias("stratum"), hashed.alias("hash"))
    if counts is None:
        ranges = rows.groupBy("stratum", _range(F.col("hash")).alias("range"))
        counts = ranges.agg(F.count(F.lit(1)).alias("n"))
    strata = _strata(counts, quota)
    spans = {
        (s, found.quota - 1): found.span
        for s, found in strata.items()
        if found.quota > 0
    }
    # Rows of the one hash range per stratum that matters are all that is left.
    near = " OR ".join(
        f"(stratum = {s} AND hash BETWEEN {literal(lo)} AND {literal(hi)})"
        for (s, _), (lo, hi, _) in spans.items()
    )
    stats = {}
    if spans:
        # Filtered after the projection, so that hashes are computed once.
        edge = rows.filter(near)
        if sum(found.rows for found in strata.values()) <= EDGE_ROWS:
            stats = _ordered(edge.groupBy("stratum", "hash").count().collect(), spans)
        else:
            edge = keep("sample_edge", lambda: edge)
            stats = order_statistics(edge, F.col("hash"), spans, F.col("stratum"))
    groups: dict[tuple[int, int], int] = {}
    thresholds = {}
    for (s, _), at in stats.items():
        fit = strata[s].quota - at.below
        whole = fit == at.equal
        thresholds[s] = at.value if whole else at.value - 1
        if not whole:
            groups[s, at.value] = fit
    if not groups:
        return Sample(stratum, hashed, thresholds)
    pairs, taken = list(groups), dict(enumerate(groups.values()))
    group = f"_group{len(keys)}"  # one name per level of keys
    if len(keys) > 1:
        tied = df.withColumns({"_stratum": stratum, "_hash": hashed})
        tied = tied.withColumn(group, F.expr(group_index(pairs)))
        tied = tied.filter(F.col(group).isNotNull()).select(*df.columns, group)
        quotas = F.expr(case((f"stratum = {g}", f"{n}L") for g, n in taken.items()))
        ties = _select(tied, F.col(group), quotas, seed, keys[1:], keep)
    else:
        ties = Copies(group, taken)
    return Sample(stratum, hashed, thresholds, pairs, group, ties)


def stratified_sample(
    df: DataFrame,
    outcome: str,
    p: float,
    seed: int,
    key: Sequence[str] | None = None,
    keep: Keep | None = None,
) -> Sample:
    """Fit a sample of ``ceil(p * n)`` rows of every quartile bin of outcome.

    ``key`` names columns that identify a row; rows are drawn in the order of a
    hash of it, and the sample is a filter. Rows that should share a key after
    all fall on the same side, but for those at the threshold.

    Without a key, copies of a row are numbered and the number goes into the
    hash, so every copy is drawn on its own, however many there are. That costs
    a shuffle of the table, reduced on the map side, here and in ``flagged``;
    with ``keep`` the numbered table is prepared once for both.
    """
    if not 0 <= p <= 1:
        raise ValueError("p must lie between 0 and 1")
    number, keys = None, [list(key or ()), df.columns]
    store = keep or default_keep(df)
    if key is None:

        def number(rows: DataFrame) -> DataFrame:
            return numbered(rows, store)

        df = number(df)
        keys = [df.columns]
    quota = F.ceil(F.lit(float(p)) * F.col("total").cast("double"))
    at = sketch(df, outcome)
    if at is None:
        breaks, counts = [], None
    else:
        hashed = row_hash(seed, keys[0])
        cells = store(
            "sample_counts", lambda: cell_counts(df, at, _range(hashed).alias("range"))
        )
        breaks = exact_quantiles(df, at, cells)
        counts = _stratum_counts(cells, at, breaks)
    stratum = quartile_bin(outcome, breaks)
    sample = _select(df, stratum, quota, seed, keys, store, counts)
    mark = (outcome, p, seed, key and tuple(key))
    return replace(sample, number=number, mark=mark)


def _stratum_counts(
    cells: DataFrame, at: Sketch, breaks: Sequence[float]
) -> DataFrame | None:
    """Rows (stratum, range, n) from counts by cell; None if a break parts a gap."""
    gaps = [at.gap(2 * k) for k in range(len(at.inside) + 1)]
    inner = _breaks(breaks)
    if any(lo < b < hi for b in inner for lo, hi in gaps):
        return None
    # All of a gap lies behind the breaks up to its lower end. The first one
    # holds its lower end, the least value, which no break lies before.
    of_gap = case(
        (f"cell = {2 * k}", sum(b <= lo for b in inner)) for k, (lo, _) in enumerate(gaps)
    )
    known = F.when(F.col("cell") % 2 == 1, _bin(F.col("value"), breaks))
    stratum = F.when(F.col("cell").isNull(), -1).otherwise(
        F.coalesce(known, F.expr(of_gap))
    )
    return cells.select(stratum.alias("stratum"), "range", "n")


def holdout_split(
    df: DataFrame,
    sample: Sample | Callable[[], Sample],
    keys: Sequence[str],
    keep: Keep,
    name: str,
    give_back: bool,
    of: Sequence[object] | None = None,
) -> DataFrame:
    """Rows of df with ``part`` = "train" or "test" and no unseen key in test.

    Sampled rows with a key that occurs in sampled rows only are ``cold``: the
    test part may not hold them. They go back to train (``give_back``) or are
    left out; the verdict depends on the row's own keys, so no anti-join over
    whole rows is needed, and one aggregate finds the cold values of all keys. The flagged rows are written once, apart by the flag,
    and the sampled ones once more with their verdict. ``sample`` may be a
    function that fits it; ``of`` says what it is made of, and it is called
    only if the flagged rows are not prepared yet.
    """
    if of is None:
        rule = sample() if callable(sample) else sample
        of = [df, rule.mark, *rule.thresholds.items()]
    else:
        rule = None

    def flag() -> DataFrame:
        made = rule or (sample() if callable(sample) else sample)
        return made.flagged(df)

    flagged = keep(f"{name}_flagged", flag, partition_by=["in_sample"], of=of)
    train = flagged.filter(~F.col("in_sample")).withColumn("cold", F.lit(False))
    test = flagged.filter("in_sample").withColumn("cold", F.lit(False))
    cold = keep(cold_table(name), lambda: cold_keys(flagged, keys))
    for place, key in enumerate(keys):
        of_key = cold.filter(F.col("of") == place).select(key, F.lit(True).alias("found"))
        test = attach(test, of_key, key)
        test = test.withColumn("cold", F.col("cold") | F.col("found").isNotNull()).drop("found")
    test = keep(f"{name}_sampled", lambda: test, of=[*of, tuple(keys)])
    train = train.withColumn("part", F.lit("train"))
    if give_back:
        part = F.when(F.col("cold"), "train").otherwise("test")
    else:
        # Literals, so that readers of one part skip the other part's files.
        test, part = test.filter(~F.col("cold")).withColumn("cold", F.lit(False)), F.lit("test")
    test = test.withColumn("part", part)
    columns = [*df.columns, "cold", "part"]
    return train.select(*columns).unionByName(test.select(*columns))


def cold_keys(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (of, keys): the values of each key that occur in sampled rows only.

    ``of`` is the place of the key the row is about; the others are NULL there. All
    keys are grouped by in one read of the rows.
    """
    if len(keys) == 1:
        grouped = flagged.groupBy(*keys).agg(F.bool_and("in_sample").alias("all_sampled"))
        return grouped.filter("all_sampled").select(F.lit(0).alias("of"), *keys)
    grouped = flagged.groupingSets([[key] for key in keys], *keys).agg(
        F.bool_and("in_sample").alias("all_sampled"), F.grouping_id().alias("id")
    )
    # A bit is set for each key that a row is not grouped by, the first key's highest.
    every = (1 << len(keys)) - 1
    ids = [every & ~(1 << (len(keys) - 1 - place)) for place in range(len(keys))]
    of = F.expr(case((f"id = {i}", place) for place, i in enumerate(ids)))
    return grouped.filter("all_sampled").select(of.cast("int").alias("of"), *keys)


def cold_table(name: str) -> str:
    """What a split calls its table of cold keys; only it reads it."""
    return f"{name}_cold"
