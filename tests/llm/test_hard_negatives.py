import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from biasloom.llm import hard_negatives
from biasloom.llm.common import Scratch
from biasloom.llm.hard_negatives import mine, walk

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, negatives=5, low=80, high=100):
    """The same rows by scoring every pair."""
    kept = []
    for id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((id, [math.floor(256 * float(np.float32(x))) for x in v], label))

    def first(found, most):
        order = sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))
        return order[:most]

    out = []
    for a, (id, v, label) in enumerate(kept):
        if id is None or id % 100:
            continue
        scored = [
            (sum(x * y for x, y in zip(v, w)), other, lab)
            for k, (other, w, lab) in enumerate(kept)
            if k != a
        ]
        for p, pid, _ in first([s for s in scored if s[2] == label], positives):
            fit = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p]
            for rank, (n, nid, _) in enumerate(first(fit, negatives), 1):
                out.append((id, pid, rank, nid, p, n))
    return out


def mined(spark, rows, schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema).repartition(3)
    found = mine(df, Scratch(spark, "test"), F.col("vec_id") % 100 == 0, **options)
    return [tuple(r) for r in found.collect()]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def clustered(rng, n, width, clusters=12):
    centres = rng.normal(size=(clusters, width))
    own = rng.integers(0, clusters, n)
    v = centres[own] + 0.2 * rng.normal(size=(n, width))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_walk_gives_falling_sums():
    rng = np.random.default_rng(1)
    a, b = (np.sort(rng.normal(size=k))[::-1].tolist() for k in (7, 5))
    seen = list(walk(a, b))
    assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(7) for j in range(5)]
    assert [s for s, _, _ in seen] == sorted((s for s, _, _ in seen), reverse=True)
    assert all(s == a[i] + b[j] for s, i, j in seen)


@pytest.mark.parametrize("part_rows", [4096, 37])
def test_brute_force(spark, monkeypatch, part_rows):
    monkeypatch.setattr(hard_negatives, "LEAST_PART_ROWS", part_rows)
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "CHUNK_ANCHORS", 3)
    rng = np.random.default_rng(2)
    v = clustered(rng, 900, 10).round(2).tolist()
    rows = [(k, v[k], int(rng.integers(0, 4))) for k in range(900)]
    got = mined(spark, rows)
    assert sorted(got) == sorted(plain(rows)) and got


def test_hot_vector_and_ties(spark, monkeypatch):
    """A third of all rows have one vector; ties go by id, in parts of any cut."""
    monkeypatch.setattr(hard_negatives, "LEAST_PART_ROWS", 25)
    rng = np.random.default_rng(3)
    v = clustered(rng, 400, 6).round(1)
    v[rng.permutation(400)[:140]] = [0.5, 0.5, 0.5, 0.5, 0.0, 0.0]
    rows = [(int(i), v[k].tolist(), k % 3) for k, i in enumerate(rng.permutation(400))]
    assert sorted(mined(spark, rows)) == sorted(plain(rows))


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (100, [0.5, -0.3], 1), (200, [-1.0, -1.0], 2),
        (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 1), (3, [0.8, 0.1], 2), (4, [0.9, 0.0], 2),
        (5, [0.85], 2), (6, [], 2), (7, [0.9, 0.5, 0.5], 3),
        (None, [0.9, 0.0], 2), (None, [0.95, 0.0], 1),
        (8, None, 1), (9, [1.0, 1.0], None), (10, [nan, 1.0], 2), (11, [inf, 1.0], 2),
        (12, [None, 1.0], 1), (13, [-1e-12, -0.001], 1), (300, [0.0, 0.0], 5),
        (400, [1e6, 1e6], 7), (401, [1e6, 1e6], 7), (402, [9e5, 1e6], 8),
    ]
    got = mined(spark, rows)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    # Lengths that need whole numbers beyond what a double holds exactly.
    rows = [(k * 50, [1e5 + k, 3e5 - 7 * k, float(k)], k % 2) for k in range(20)]
    got = mined(spark, rows, "vec_id long, embedding array<double>, label int")
    wide = [(i, [float(x) for x in v], lab) for i, v, lab in rows]
    assert sorted(got) == sorted(plain(wide))


def test_repeated_rows_empty_and_clashing(spark):
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [0.9], 2), (1, [0.9], 2)]
    assert sorted(mined(spark, rows)) == sorted(plain(rows))
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    names = ["row", "part", "cell", "v", "wins", "x", "score", "rank"]
    df = spark.createDataFrame(rows[1:], SCHEMA).selectExpr("*", *(f"'z' AS {n}" for n in names))
    found = mine(df, Scratch(spark, "test"), F.col("vec_id") == 0)
    assert found.count() == 0  # no other row of the label
