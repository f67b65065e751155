import numpy as np
import pytest

from biasloom.llm.common import Scratch, row_key
from biasloom.llm.cube_mix import flight, landing, mix, mixed, source_targets


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, total, out = set(names), sum(sizes.values()), {}
    while left:
        share = {s: total * weight[s] / sum(weight[t] for t in left) for s in left}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3 * sizes[s]
            total -= out[s]
            left.remove(s)
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 500, "c": 90, None: 4},
        {"a": 1, "b": 1, "c": 1000},
        {"é": 7, "z": 9, "A": 0},
        {"only": 5},
    ],
)
def test_targets(spark, sizes):
    rows = [(s, 1) for s, n in sizes.items() for _ in range(n)] + [(s, 0) for s in sizes]
    df = spark.createDataFrame(rows, "source string, size long")
    got = source_targets(df, Scratch(spark, "test")).collect()
    want = plain_targets(sizes)
    assert {r.source for r in got} == set(want)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])


def test_flight_keeps_the_totals():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 900, 500).astype(float)
    balance = np.vstack([size / size.mean(), np.ones(500)])
    chance = np.full(500, 0.37)
    out = flight(chance, balance, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    np.testing.assert_allclose(balance @ out, balance @ chance, atol=1e-6)
    landed = landing(out, balance)
    assert set(landed) <= {0.0, 1.0}


def test_chances_are_kept_on_average():
    size = np.arange(1.0, 13.0)
    balance = np.vstack([size, np.ones(12)])
    chance = np.linspace(0.1, 0.9, 12)
    runs = [flight(chance, balance, np.random.default_rng(i)) for i in range(3000)]
    np.testing.assert_allclose(np.mean(runs, axis=0), chance, atol=0.03)


def corpus(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, " ".join(["w"] * int(rng.integers(1, 60))), f"s{min(i % 7, 3)}")
        for i in range(3000)
    ]
    rows += [(1, "w w", "s1")] * 5 + [(None, "w w w", None), (9000, None, "s0"), (9001, "", "s9")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix(spark):
    rows, df = corpus(spark)
    first = mix(df, Scratch(spark, "test"), cell_rows=200)
    got = first.collect()
    assert len(got) == len(rows)
    again = mix(df.repartition(7, "text"), Scratch(spark, "test"), cell_rows=200)
    assert sorted(map(str, got)) == sorted(map(str, again.collect()))
    taken, target, top = {}, {}, {}
    for r in got:
        assert 0 <= r.copies <= 3
        of = (r.source_size, r.target)
        taken[of] = taken.get(of, 0) + r.copies * r.size
        top[of] = max(top.get(of, 0), r.size)
    for of in taken:
        assert abs(taken[of] - of[1]) <= 0.5 * top[of]
    assert sum(taken.values()) == pytest.approx(sum(o[0] for o in taken), rel=0.01)


def test_mixed_repeats_rows(spark):
    _, df = corpus(spark)
    counts = {
        r.key: r.n
        for r in mix(df, Scratch(spark, "test")).groupBy("key").agg({"copies": "sum"})
        .withColumnRenamed("sum(copies)", "n").collect()
        if r.n
    }
    out = mixed(df, Scratch(spark, "test"))
    assert out.columns == df.columns
    got = out.select(row_key(out, "doc_id", "source", "text").alias("k")).groupBy("k").count()
    assert {r.k: r["count"] for r in got.collect()} == counts


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(df, Scratch(spark, "test")).count() == 0
    assert mixed(df, Scratch(spark, "test")).count() == 0


def test_rows_that_differ_by_a_null_are_not_alike(spark):
    rows = [(1, "a b c", None), (1, None, "a b c"), (None, "a b c", "1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(df, Scratch(spark, "test"))
    assert len({r.key for r in found.collect()}) == 3
    assert {tuple(r) for r in mixed(df, Scratch(spark, "test")).collect()} <= set(rows)


def test_many_rows_alike(spark):
    """A row that comes very often is one row of a cell; its copies share what is taken."""
    rows = [(7, "a b", "s")] * 5000 + [(1000 + k, "c d e", "s") for k in range(50)]
    rows += [(100 + k, "w " * 40, "t") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(df, Scratch(spark, "test"), cell_rows=20)
    assert found.count() == len(rows)
    got = found.groupBy("doc_id").agg({"copies": "min", "*": "count"}).collect()
    assert {r.doc_id: r["count(1)"] for r in got}[7] == 5000
    spread = found.filter("doc_id = 7").agg({"copies": "max"}).first()[0]
    assert spread - min(r["min(copies)"] for r in got if r.doc_id == 7) <= 1
    taken = found.selectExpr("source_size", "target", "size * copies AS n", "target t")
    per = taken.groupBy("target").sum("n").collect()
    assert all(abs(r["sum(n)"] - r.target) <= 0.02 * r.target + 40 for r in per)


def test_clashing_columns_and_long_texts(spark):
    rows = [(k, "a b c", "s" if k % 2 else None) for k in range(60)] + [(99, "w " * 200_000, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = ["key", "doc", "cell", "n", "whole", "size", "chance", "mix__key", "target"]
    wide = df.selectExpr("*", *(f"'x' AS {n}" for n in names))
    plain = {tuple(r) for r in mix(df, Scratch(spark, "test")).drop("key").collect()}
    assert {tuple(r) for r in mix(wide, Scratch(spark, "test")).drop("key").collect()} == plain
    out = mixed(wide, Scratch(spark, "test"))
    assert out.columns == wide.columns
    assert {r[0] for r in plain if r[0] == 99 and r[1] == 200_000} == {99}
