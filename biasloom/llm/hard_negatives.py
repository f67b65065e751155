"""Hard negatives by an inverted multi-index with certified windows.

Vectors are cut in two halves, and each half has a codebook; a pair of codes is
a cell. No row of a cell scores higher with an anchor than the sum over both
halves of ``anchor . code + |anchor| * radius``, where a code's radius is the
largest distance of any row to it. A heap hands an anchor its cells by falling
bounds (the multi-sequence walk over the two sorted lists of half-bounds), and
the walk stops where the next bound can no longer change the result.

The index is dealt into parts of whole cells, of bounded size; a cell too large
for one part has several. An anchor first walks the part it lies in, then only
those parts whose best bound still reaches what it has found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, lean, small_batches

#: Rows the codebooks are fitted on, as an expected number; all, if there are fewer.
TRAIN_ROWS = 16_384
TRAIN_ROUNDS = 8
#: Codes of a half: so many that a cell has CELL_ROWS rows on average, within limits.
CELL_ROWS = 256
MOST_CODES = 64
#: Bytes of vectors one part of the index has about.
PART_BYTES = 96 << 20
#: Rows a part has at least, where more parts would only keep more cores busy.
LEAST_PART_ROWS = 4096
#: Anchors that walk one copy of a part.
CHUNK_ANCHORS = 1 << 18
#: Anchors whose bounds are worked out at once.
ROUTED = 256
#: No row is longer (after scaling): scores of longer ones do not fit a long.
LONGEST = 3.0e9
#: What bounds are raised by for rounding.
SLACK = 1e-9

OUT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)
MOVED = "part int, chunk int, kind int, row long, id long, label long, v binary, cell int, wins array<long>, low double"
FOUND = "anchor long, win long, row long, id long, score long"


@dataclass
class Index:
    """What tasks know of the index: codebooks, radii, and the parts of each cell."""

    half: int
    width: int
    #: The type of stored components, and one in which scores are exact.
    stored: str
    exact: str
    codes: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None
    #: Cell and part, by rising part, for every part that has rows of a cell.
    cells: np.ndarray | None = None
    parts: np.ndarray | None = None

    def vectors(self, column: pa.Array) -> np.ndarray:
        data = b"".join(column.to_pylist())
        out = np.frombuffer(data, dtype=self.stored).reshape(len(column), self.width)
        return out.astype(self.exact)

    def bounds(self, v: np.ndarray, which: int, some=slice(None)) -> np.ndarray:
        """Upper bounds of the half-scores, a row for each vector, a column a code."""
        part = (v[:, : self.half], v[:, self.half :])[which].astype(np.float64)
        codes, radii = self.codes[which][some], self.radii[which][some]
        length = np.sqrt((part * part).sum(axis=1))
        reach = length[:, None] * (radii + np.sqrt((codes * codes).sum(axis=1)) * SLACK)
        return part @ codes.T + reach * (1 + SLACK) + SLACK


def codebook(sample: np.ndarray, codes: int) -> np.ndarray:
    """Centres of the sample's rows by Lloyd's rounds, begun on evenly spaced rows."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    order = np.lexsort(sample.T) if sample.shape[1] else np.arange(len(sample))
    centres = sample[order[np.linspace(0, len(sample) - 1, codes).astype(int)]].copy()
    for _ in range(TRAIN_ROUNDS):
        own = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=codes)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * (rows @ centres.T)).argmin(axis=1)


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of places in two falling lists, by falling sums (bound, i, j)."""
    heap = [(-(first[0] + second[0]), 0, 0)]
    while heap:
        low, i, j = heapq.heappop(heap)
        yield -low, i, j
        if j + 1 < len(second):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        if not j and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))


class Best:
    """The first rows by score, then id (null last), then row, among those added."""

    def __init__(self, most: int, low: float, high: float):
        self.most, self.low, self.high = most, low, high
        self.score = self.at = np.zeros(0, dtype=np.int64)

    def add(self, part: Part, begin: int, scores: np.ndarray, fits: np.ndarray) -> None:
        new = np.flatnonzero(fits & (scores >= self.low) & (scores <= self.high))
        if not len(new):
            return
        score = np.concatenate([self.score, scores[new].astype(np.int64)])
        at = np.concatenate([self.at, new + begin])
        order = np.lexsort((part.row[at], part.id[at], part.null[at], -score))[: self.most]
        self.score, self.at = score[order], at[order]
        if len(order) == self.most:
            self.low = max(self.low, int(self.score[-1]))


class Part:
    """One part of the index in memory: its rows, cell after cell."""

    def __init__(self, index: Index, pieces: list[tuple]):
        self.index = index
        self.v, self.row, self.id, self.null, self.label, cell = (
            np.concatenate(column) for column in zip(*pieces, strict=True)
        )
        self.begins = np.flatnonzero(np.diff(cell, prepend=-1))
        self.ends = np.append(self.begins[1:], len(cell))
        width = len(index.codes[1])
        left, right = cell[self.begins] // width, cell[self.begins] % width
        self.left, i = np.unique(left, return_inverse=True)
        self.right, j = np.unique(right, return_inverse=True)
        self.place = np.full((len(self.left), len(self.right)), -1)
        self.place[i, j] = np.arange(len(self.begins))

    def visit(self, v: np.ndarray, row: int, label: int, order, wanted: list[Best], same: bool):
        """Fill wanted from the cells that may change it, by falling bound."""
        (bounds1, left), (bounds2, right) = order
        for bound, i, j in walk(bounds1, bounds2):
            # Certified: no cell that is left reaches any list.
            if bound < min(w.low for w in wanted):
                return
            cell = self.place[left[i], right[j]]
            if cell >= 0:
                a, b = self.begins[cell], self.ends[cell]
                scores = self.v[a:b] @ v
                fits = self.label[a:b] == label
                fits = fits & (self.row[a:b] != row) if same else ~fits
                for best in wanted:
                    best.add(self, a, scores, fits)


def _falling(bounds: np.ndarray) -> list[tuple[list[float], np.ndarray]]:
    order = np.argsort(-bounds, axis=1, kind="stable")
    ranked = np.take_along_axis(bounds, order, axis=1)
    return [(r.tolist(), o) for r, o in zip(ranked, order, strict=True)]


def _finder(index: Index, most: int, low: int, high: int):
    """Streams parts, each followed by the anchors that walk it; yields what they find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part, key = [], None, None
        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("part", "chunk", "kind")]
            change = np.any([np.diff(c) != 0 for c in columns], axis=0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                piece = batch.slice(a, b - a)
                now = (columns[0][a], columns[1][a])
                if now != key:
                    pieces, part, key = [], None, now
                null = piece["id"].is_null().to_numpy(zero_copy_only=False)
                ids = piece["id"].fill_null(0).to_numpy()
                rows, labels = piece["row"].to_numpy(), piece["label"].to_numpy()
                v = index.vectors(piece["v"])
                if columns[2][a] == 0:
                    pieces.append((v, rows, ids, null, labels, piece["cell"].to_numpy()))
                elif pieces:
                    part = part or Part(index, pieces)
                    yield answers(part, v, rows, labels, piece)

    def answers(part: Part, v, rows, labels, piece) -> pa.RecordBatch:
        wins, lows = piece["wins"].to_pylist(), piece["low"].to_pylist()
        orders = zip(
            _falling(index.bounds(v, 0, part.left)),
            _falling(index.bounds(v, 1, part.right)),
            strict=True,
        )
        out = [[] for _ in range(5)]
        for k, order in enumerate(orders):
            same = wins[k] is None
            if same:
                wanted = [Best(most, lows[k], np.inf)]
            else:
                # A whole number p, so the window's ends are exact.
                wanted = [Best(most, -(-low * p // 100), high * p // 100) for p in wins[k]]
            part.visit(v[k], rows[k], labels[k], order, wanted, same)
            for at, best in enumerate(wanted):
                n = len(best.at)
                out[0].append(np.full(n, rows[k]))
                out[1].append(np.full(n, 0 if same else wins[k][at]))
                out[2].append(part.row[best.at])
                out[3].append(best.at)
                out[4].append(best.score)
        flat = [np.concatenate(c).astype(np.int64) for c in out]
        ids = pa.array(part.id[flat[3]], pa.int64(), mask=part.null[flat[3]])
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, flat[:3]), ids, pa.array(flat[4])],
            names=["anchor", "win", "row", "id", "score"],
        )

    return lean(run)


def _router(index: Index, home: bool | None):
    """Copies each anchor to the parts it has to walk.

    ``home`` True: the part it lies in; False: all others that may hold a row
    of its ``low`` or more; None: all such parts.
    """
    firsts = np.flatnonzero(np.diff(index.parts, prepend=-1))
    names = index.parts[firsts]
    width = len(index.codes[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROUTED):
                batch = whole.slice(a, ROUTED)
                own = batch["part"].to_numpy()
                if home:
                    yield batch
                    continue
                v = index.vectors(batch["v"])
                left, right = index.bounds(v, 0), index.bounds(v, 1)
                cells = left[:, index.cells // width] + right[:, index.cells % width]
                best = np.maximum.reduceat(cells, firsts, axis=1)
                fits = best >= batch["low"].to_numpy()[:, None]
                if home is False:
                    fits &= names != own[:, None]
                who, where = np.nonzero(fits)
                copies = batch.take(pa.array(who))
                part = pa.array(names[where].astype(np.int32))
                yield copies.set_column(0, "part", part)

    return run


def _usable(rows: DataFrame, id: str, vector: str, label: str, anchor: Column, scale: float):
    """Rows that take part, with whole components and their squared length."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    taken = rows.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    def whole(x: Column) -> Column:
        x = x.cast("double") * scale
        # Doubles of this size are whole, and might not fit the long that floor() gives.
        return F.when(F.abs(x) < 1e15, F.floor(x).cast("double")).otherwise(x)

    out = taken.select(
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(vector, whole).alias("x"),
    )
    square = F.aggregate("x", F.lit(0.0), lambda s, x: s + x * x)
    return out.withColumn("square", square).filter(F.col("square") <= LONGEST**2)


def _placed(rows: DataFrame, index: Index) -> DataFrame:
    """Each row with its number, its cell, and its distances to the two codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, index.width))
            sizes = batch["x"].value_lengths().to_numpy()
            # Shorter vectors count as filled up with zeros.
            x[np.arange(index.width) < sizes[:, None]] = batch["x"].flatten().to_numpy()
            halves = x[:, : index.half], x[:, index.half :]
            own = [nearest(h, c) for h, c in zip(halves, index.codes, strict=True)]
            far = [
                np.sqrt(((h - c[o]) ** 2).sum(axis=1))
                for h, c, o in zip(halves, index.codes, own, strict=True)
            ]
            packed = np.ascontiguousarray(x.astype(index.stored))
            size = packed.itemsize * index.width
            data = packed.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in ("row", "id", "label", "anchor")),
                    pa.array([data[k * size : (k + 1) * size] for k in range(len(x))], pa.binary()),
                    pa.array((own[0] * len(index.codes[1]) + own[1]).astype(np.int32)),
                    *map(pa.array, far),
                ],
                names=["row", "id", "label", "anchor", "v", "cell", "far1", "far2"],
            )

    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", "x"
    )
    schema = "row long, id long, label long, anchor boolean, v binary, cell int, far1 double, far2 double"
    return numbered.mapInArrow(lean(run), schema)


def _walked(anchors: DataFrame, rows: DataFrame, index: Index, home, chunks: int, finder):
    """What anchors find in the parts they are routed to (rows of FOUND)."""
    spark = rows.sparkSession
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")
    moving = anchors.select(
        "part", chunk.alias("chunk"), F.lit(1).alias("kind"), "row", "id", "label", "v", "cell",
        "wins", "low",
    ).mapInArrow(lean(_router(index, home)), MOVED)
    copies = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    still = rows.select(
        "part", copies.alias("chunk"), F.lit(0).alias("kind"), "row", "id", "label", "v", "cell",
        F.lit(None).cast("array<long>").alias("wins"), F.lit(0.0).alias("low"),
    )
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        4 * chunks * (int(index.parts[-1]) + 1),
    )
    together = still.unionByName(moving).repartition(tasks, "part", "chunk")
    ordered = together.sortWithinPartitions("part", "chunk", "kind", "cell")
    return ordered.mapInArrow(finder, FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first rows of each list, with their rank."""
    order = Window.partitionBy("anchor", "win").orderBy(
        F.desc("score"), F.asc_nulls_last("id"), "row"
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(
    rows: DataFrame,
    scratch: Scratch,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x), a score is the inner product of
    two rows. For every row where ``anchor`` holds, its first ``positives`` other
    rows of its label are its positives; for each of them, the first ``negatives``
    rows of another label with ``low`` to ``high`` per cent of its score are returned,
    all if there are fewer. Higher scores come first, ties by smaller id.

    A null label, a null vector, and a null or non-finite component take a row
    out, as does a length over LONGEST after scaling, whose scores do not fit a
    long. Shorter vectors count as filled up with zeros, an empty one scores 0.
    Rows are told apart even where alike: a repeated row is a candidate as often
    as it comes, and a repeated anchor gives its rows as often; rows with one
    score and id come in the order they were read. A row without an id comes
    last among ties. A positive with a negative score has an empty window. An
    empty table gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    small_batches(spark)
    usable = _usable(rows, id, vector, label, anchor, scale)
    extent = usable.agg(
        F.count("*"), F.max(F.size("x")), F.max("square"), F.count_if("anchor")
    ).first()
    n, width, square, n_anchors = extent
    if not n_anchors:
        return spark.createDataFrame([], OUT)
    # Sums over any part of two vectors stay below the product of their lengths.
    exact = "f4" if square < 1 << 24 else "f8" if square < 1 << 53 else "i8"
    largest = square**0.5
    stored = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
    codes = max(1, min(MOST_CODES, round((n / CELL_ROWS) ** 0.5)))
    sample = usable.filter(F.rand(5) < TRAIN_ROWS / n).select("x").collect()
    data = np.zeros((len(sample), width))
    for k, r in enumerate(sample):
        data[k, : len(r["x"])] = r["x"]
    half = width // 2
    books = codebook(data[:, :half], codes), codebook(data[:, half:], codes)
    index = Index(half, width, stored, exact, books)
    placed = scratch.keep(_placed(usable, index), "placed")

    # At most one row for each pair of codes.
    cells = (
        placed.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("far1").alias("far1"), F.max("far2").alias("far2"))
        .orderBy("cell")
        .collect()
    )
    index.radii = tuple(np.zeros(len(b)) for b in books)
    for r in cells:
        for k, code in enumerate(divmod(r["cell"], len(books[1]))):
            index.radii[k][code] = max(index.radii[k][code], r[f"far{k + 1}"])
    most_rows = max(LEAST_PART_ROWS, PART_BYTES // max(1, width * np.dtype(exact).itemsize))
    even = -(-n // (2 * spark.sparkContext.defaultParallelism))
    size = min(most_rows, max(LEAST_PART_ROWS, even))
    deal, begin = [], 0
    for r in cells:
        first, last = begin // size, (begin + r["n"] - 1) // size
        deal.append((r["cell"], first, last - first + 1))
        begin += r["n"]
    index.cells = np.array([c for c, _, span in deal for _ in range(span)])
    index.parts = np.array([first + k for _, first, span in deal for k in range(span)])
    dealt = F.broadcast(spark.createDataFrame(deal, "cell int, first int, span int"))
    rows = placed.join(dealt, "cell").withColumn(
        "part", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("span"))).cast("int")
    )

    chunks = -(-n_anchors // CHUNK_ANCHORS)
    finder = _finder(index, positives, low, high)
    none = F.lit(None).cast("array<long>")
    anchors = rows.filter("anchor")
    near = _walked(
        anchors.withColumn("wins", none).withColumn("low", F.lit(float("-inf"))),
        rows, index, True, chunks, finder,
    )
    near = scratch.keep(_first(near, positives).drop("rank"), "near")
    floors = near.groupBy(F.col("anchor").alias("row")).agg(
        F.when(F.count("*") == positives, F.min("score").cast("double")).alias("low")
    )
    searching = anchors.join(floors, "row", "left").withColumn("wins", none)
    searching = searching.withColumn("low", F.coalesce("low", F.lit(float("-inf"))))
    rest = _walked(searching, rows, index, False, chunks, finder)
    chosen = scratch.keep(_first(near.unionByName(rest), positives), "positives")

    # A window above a score below zero is empty.
    windows = chosen.filter("score >= 0").groupBy(F.col("anchor").alias("row")).agg(
        F.collect_set("score").alias("wins"),
        F.floor(F.min("score").cast("double") * low / 100).cast("double").alias("low"),
    )
    finder = _finder(index, negatives, low, high)
    found = _walked(anchors.join(windows, "row"), rows, index, None, chunks, finder)
    found = _first(found, negatives).select(
        F.col("anchor").alias("of"),
        "win",
        "rank",
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = chosen.select("anchor", F.col("id").alias("positive_id"), "score").join(
        anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor"
    )
    return named.join(
        found, (F.col("anchor") == F.col("of")) & (F.col("score") == F.col("win"))
    ).select(
        "anchor_id",
        "positive_id",
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )
