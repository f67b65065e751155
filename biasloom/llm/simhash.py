"""SimHash near-duplicates: a binary trie joined with itself.

Fingerprints are cut into the nodes of a binary trie at a depth that keeps nodes
small on average; a node that is crowded all the same is cut again on its own, by
bits that its rows do not share. A task holds one node, or part of one, and every
node whose path differs
from it in no more bits than the budget, and walks both sub-tries together: the
differing bits of a pair of nodes are taken from the budget, a pair without
budget left is pruned, and a pair of few fingerprints is compared at once. The
task returns a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, byte_texts, lean, small_batches, text_bytes
from biasloom.llm.components import components

BITS = 64
#: Fingerprints that one trie node may hold before it is cut again.
NODE_ROWS = 20_000
#: A pair of nodes is compared directly when it has this many pairs or fewer.
DIRECT_PAIRS = 1 << 13
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ONE = np.uint64(1)


def fingerprint(text: bytes, width: int) -> int:
    """Unsigned SimHash of the word shingles of a UTF-8 text; 0 without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype="<u8")
    total = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """docs without its text column, with ``fp`` (the fingerprint as a long)."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    source = docs.select(*others, text_bytes(text).alias("fp__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, width) for t in byte_texts(batch["fp__text"])]
            fps = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in others), fps], names=[*others, "fp"]
            )

    schema = docs.select(*others, F.lit(0).cast("long").alias("fp")).schema
    return source.mapInArrow(lean(run), schema)


def trie_links(
    a: np.ndarray, b: np.ndarray, budget: int, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within budget bits of two sorted arrays of distinct fingerprints.

    ``same``: a and b are the same node, and each pair comes once.
    """
    total = budget
    stack = [(a, b, BITS - 1, budget, same)]
    while stack:
        a, b, bit, budget, same = stack.pop()
        if not len(a) or not len(b) or (same and len(a) < 2):
            continue
        if budget == 0 or bit < 0:
            rest = np.uint64((1 << (bit + 1)) - 1)
            _, i, j = np.intersect1d(
                a & rest, b & rest, assume_unique=True, return_indices=True
            )
            if len(i) and not same:
                yield a[i], b[j]
            continue
        if len(a) * len(b) <= DIRECT_PAIRS:
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= total
            if same:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            if len(i):
                yield a[i], b[j]
            continue
        mask = ONE << np.uint64(bit)
        cut_a = int(np.searchsorted((a & mask) != 0, True))
        cut_b = int(np.searchsorted((b & mask) != 0, True))
        a0, a1, b0, b1 = a[:cut_a], a[cut_a:], b[:cut_b], b[cut_b:]
        stack += [(a0, b0, bit - 1, budget, same), (a1, b1, bit - 1, budget, same)]
        stack.append((a0, b1, bit - 1, budget - 1, False))
        if not same:
            stack.append((a1, b0, bit - 1, budget - 1, False))


def low_bits(values: np.ndarray, depth: int) -> np.ndarray:
    """The part of the fingerprints below the cut."""
    return values & np.uint64((1 << (BITS - depth)) - 1)


class Forest:
    """Union-find over the positions of a sorted array of fingerprints."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def node_links(own: int, home: int, rows: pd.DataFrame, depth: int, budget: int) -> pd.DataFrame:
    """A spanning forest of the links between some rows of node own and all beside them.

    Those are the rows of its part ``home``; where a node has several parts, rows of its
    others are beside them too.
    """
    fps = rows["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    parts = rows["part"].to_numpy(dtype=np.int64)
    places = rows["place"].to_numpy(dtype=np.int64)
    order = np.lexsort((fps, places, parts))
    fps, parts, places = fps[order], parts[order], places[order]
    everything = np.sort(fps)
    forest, left, right = Forest(len(everything)), [], []
    inside = (parts == own) & (places == home)
    here = fps[inside]
    groups = [(own, here, True)] if len(here) else []
    if len(here):
        beside = fps[(parts == own) & ~inside]
        if len(beside):
            groups.append((own, np.sort(beside), False))
        for part in np.unique(parts[parts > own]):
            groups.append((int(part), fps[parts == part], False))
    for part, there, same in groups:
        spent = int(part ^ own).bit_count()
        high_a = here[:1] & ~np.uint64((1 << (BITS - depth)) - 1)
        high_b = there[:1] & ~np.uint64((1 << (BITS - depth)) - 1)
        found = trie_links(
            low_bits(here, depth), low_bits(np.sort(there), depth), budget - spent, same
        )
        for a, b in found:
            a, b = a | high_a, b | high_b
            at_a, at_b = np.searchsorted(everything, a), np.searchsorted(everything, b)
            for x, y, u, v in zip(at_a.tolist(), at_b.tolist(), a, b, strict=True):
                if forest.join(x, y):
                    left.append(u)
                    right.append(v)
    return pd.DataFrame(
        {
            "u": np.array(left, dtype=np.uint64).view(np.int64),
            "v": np.array(right, dtype=np.uint64).view(np.int64),
        }
    )


def _node(depth: int):
    return F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")


def _bit(fp: Column, bit: Column) -> Column:
    return F.call_function("shiftrightunsigned", fp, bit).bitwiseAND(F.lit(1).cast("long"))


def _place(bits: Column) -> Column:
    """The bits of a fingerprint at some places, as a number."""
    nothing = F.lit(0).cast("long")
    return F.aggregate(bits, nothing, lambda done, bit: done * 2 + _bit(F.col("fp"), bit))


def crowded_nodes(distinct: DataFrame, depth: int, node_rows: int) -> dict[int, list[int]]:
    """Nodes with more than node_rows fingerprints, and the bits that part each of them.

    A node is parted by the bits below the cut that differ most among its own rows, as
    many as it takes; bits that it has in common part nothing and are passed over.
    There is at most one such node for each node_rows fingerprints.
    """
    noded = distinct.select("fp", _node(depth).alias("part"))
    sizes = noded.groupBy("part").count().filter(F.col("count") > node_rows)
    ones = [F.sum(_bit(F.col("fp"), F.lit(b))).alias(f"b{b}") for b in range(BITS - depth)]
    counted = noded.join(sizes, "part").groupBy("part", "count").agg(*ones).collect()
    ranked, taken = {}, {}
    for row in counted:
        even = [min(row[f"b{b}"], row["count"] - row[f"b{b}"]) for b in range(BITS - depth)]
        order = sorted((b for b in range(BITS - depth) if even[b]), key=lambda b: (-even[b], b))
        ranked[row["part"]] = order
        taken[row["part"]] = (row["count"] // node_rows).bit_length()
    while taken:
        now = {part: ranked[part][:n] for part, n in taken.items()}
        parted = _parted(noded, now).groupBy("part", "place").count()
        most = parted.groupBy("part").agg(F.max("count").alias("most"))
        again = {
            r["part"]: taken[r["part"]] + max(1, (r["most"] // node_rows).bit_length())
            for r in most.filter(F.col("most") > node_rows).collect()
            if taken[r["part"]] < len(ranked[r["part"]])
        }
        if not again:
            break
        taken |= again
    return {part: ranked[part][:n] for part, n in taken.items()}


def _cuts(spark: SparkSession, cuts: dict[int, list[int]]) -> DataFrame:
    return spark.createDataFrame(list(cuts.items()), "cut long, bits array<int>")


def _parted(noded: DataFrame, cuts: dict[int, list[int]]) -> DataFrame:
    """Rows (fp, part, place) of the nodes that are cut."""
    joined = noded.join(_cuts(noded.sparkSession, cuts), F.col("part") == F.col("cut"))
    return joined.select("fp", "part", _place(F.col("bits")).alias("place"))


def _flips(bits: Column, left: Column) -> Column:
    """Masks that change up to ``left`` (two at most) of some bits of a place."""
    n = F.size(bits)
    none = F.array(F.lit(0).cast("long"))
    ones = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    )
    twos = F.flatten(
        F.transform(
            ones,
            lambda a: F.transform(F.filter(ones, lambda b: b < a), lambda b: a.bitwiseOR(b)),
        )
    )
    return (
        F.when((n == 0) | (left == 0), none)
        .when(left == 1, F.concat(none, ones))
        .otherwise(F.concat(none, ones, twos))
    )


def copies(distinct: DataFrame, budget: int = 2, node_rows: int = NODE_ROWS):
    """Rows (fp, part, place, own, home): each fingerprint at every group it may link in.

    Nodes are cut where they hold a quarter of node_rows on average. A node beside a
    fingerprint's own is one whose path differs in up to ``budget`` bits; a crowded node
    has a group for each of its parts, of which a fingerprint goes to those that its
    budget still reaches. Also the depth of the cut.
    """
    if budget > 2:
        raise ValueError("the budget is two bits at most")
    total = distinct.count()
    depth = max(0, -(-4 * total // node_rows) - 1).bit_length()
    cuts = crowded_nodes(distinct, depth, node_rows)
    masks = [
        (sum(1 << b for b in bits), n)
        for n in range(min(budget, depth) + 1)
        for bits in combinations(range(depth), n)
    ]
    beside = F.array(
        *(
            F.struct(
                F.col("part").bitwiseXOR(F.lit(m).cast("long")).alias("own"),
                F.lit(budget - n).alias("left"),
            )
            for m, n in masks
        )
    )
    # Each pair of nodes meets once, at the lesser of the two.
    below = F.filter(beside, lambda b: b["own"] <= F.col("part"))
    rows = distinct.select("fp", _node(depth).alias("part"))
    rows = rows.select("fp", "part", F.inline(below))
    if not cuts:
        zero = F.lit(0).cast("long")
        return rows.select("fp", "part", zero.alias("place"), "own", zero.alias("home")), depth
    table = _cuts(distinct.sparkSession, cuts)
    joined = rows.join(table, F.col("own") == F.col("cut"), "left")
    bits = F.coalesce("bits", F.array().cast("array<int>"))
    placed = joined.select("fp", "part", "own", _place(bits).alias("place"), bits.alias("bits"), "left")
    homes = F.transform(
        _flips(F.col("bits"), F.col("left")), lambda m: F.col("place").bitwiseXOR(m)
    )
    # Within a node, too, each pair of parts meets at the lesser one.
    fits = F.filter(homes, lambda h: (F.col("part") != F.col("own")) | (h <= F.col("place")))
    return placed.select("fp", "part", "place", "own", F.explode(fits).alias("home")), depth


def links(distinct: DataFrame, budget: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (u, v) that connect the fingerprints (``fp``, distinct) within budget bits."""
    rows, depth = copies(distinct, budget, node_rows)

    def walk(key: tuple[int, ...], group: pd.DataFrame) -> pd.DataFrame:
        return node_links(key[0], key[1], group, depth, budget)

    return rows.groupBy("own", "home").applyInPandas(walk, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    budget: int = 2,
) -> DataFrame:
    """Rows (id, fingerprint, component_id), one for each row of docs.

    Null and empty texts have the fingerprint zero and are linked like any
    other. component_id is the least id among the documents that can be reached
    over links; it is null only where none of them has an id. Rows that repeat
    an id come back once each. An empty table gives an empty result; further
    columns of docs are ignored.
    """
    marked = fingerprints(
        docs.select(F.col(id).alias("doc"), F.col(text).alias("text")), "text", width
    )
    marked = scratch.keep(marked, "fingerprints")
    distinct = scratch.keep(
        marked.groupBy("fp").agg(F.min("doc").alias("least")), "distinct"
    )
    found = components(links(distinct.select("fp"), budget), scratch)
    least = (
        distinct.join(found, F.col("fp") == F.col("node"))
        .groupBy("root")
        .agg(F.min("least").alias("least"))
    )
    reached = scratch.keep(
        found.withColumnRenamed("root", "at")
        .join(least, F.col("at") == F.col("root"))
        .select("node", F.col("least").alias("component")),
        "reached",
    )
    alone = distinct.join(reached, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("of"), F.coalesce("component", "least").alias("component_id")
    )
    return marked.join(alone, F.col("fp") == F.col("of")).select(
        F.col("doc").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
