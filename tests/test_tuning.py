from __future__ import annotations

import random
from dataclasses import replace

import pytest

from biasloom.operators import joint
from biasloom.operators.effects import fit
from biasloom.operators.joint import joint_curve, tune_jointly
from biasloom.operators.scoring import Model, score
from biasloom.operators.tuning import (
    Axis,
    best_point,
    param_grid,
    tune,
    tuning_curve,
)

SCHEMA = "user_id int, item_id int, rating double, genres string"


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        item = rng.randrange(12)
        out.append((rng.randrange(9), item, rng.randrange(1, 11) / 2, f"g{item % 4}"))
    return out


@pytest.fixture
def train(spark):
    return spark.createDataFrame(rows(1, 400), SCHEMA)


@pytest.fixture
def test_rows(spark):
    return spark.createDataFrame(rows(2, 100), SCHEMA)


def test_axis_has_the_documented_points(spark):
    axes = {"a": Axis(2.0, 3.0, 0.1), "b": Axis(4.5, 6.0, 0.1), "c": Axis(1.6, 1.9, 0.1)}
    assert [a.size for a in axes.values()] == [11, 16, 4]
    grid = param_grid(spark, {"a": axes["a"]}).collect()
    assert [r["a"] for r in grid] == [round(2 + i / 10, 1) for i in range(11)]


def test_param_grid_varies_the_first_axis_fastest(spark):
    grid = param_grid(spark, {"x": Axis(1, 2), "y": Axis(5, 7), "z": Axis.fixed(9)})
    rows = [tuple(r) for r in grid.orderBy("grid_id").collect()]
    assert rows == [
        (0, 1, 5, 9),
        (1, 2, 5, 9),
        (2, 1, 6, 9),
        (3, 2, 6, 9),
        (4, 1, 7, 9),
        (5, 2, 7, 9),
    ]


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_curve_equals_refitting_for_every_penalty(keep, train, test_rows, depth):
    base = (2.2, 5.3, 1.7)
    axis = Axis(0.5, 3.5, 0.5)
    effects = fit(train, {"s": base}, keep, "base")
    curve = tuning_curve(effects, test_rows, depth, "s", axis).orderBy("grid_id")
    lam = ["lam_item", "lam_user", "lam_genre"][depth]
    for r in curve.collect():
        lams = list(base)
        lams[depth] = r[lam]
        refit = fit(train, {"s": lams}, keep, f"refit_{r['grid_id']}")
        naive = score(test_rows, refit, [Model("m", depth + 1, "s")]).first()
        assert r["rmse"] == pytest.approx(naive["rmse"], abs=1e-12)


def test_unseen_test_group_makes_the_curve_missing(spark, keep, train, test_rows):
    cold = spark.createDataFrame([(1, 99, 3.0, "g1")], SCHEMA)
    effects = fit(train, {"s": (1, 1, 1)}, keep, "cold")
    for depth in (0, 1):
        rows_ = test_rows.unionByName(cold)
        curve = tuning_curve(effects, rows_, depth, "s", Axis(1, 2))
        assert [r["rmse"] for r in curve.collect()] == [None, None]
        assert best_point(curve).first()["rmse"] is None


def test_best_point_is_the_first_of_equals_and_skips_missing(spark):
    rows_ = [(0, 1.0, None), (1, 2.0, 0.5), (2, 3.0, 0.5), (3, 4.0, 0.9)]
    curve = spark.createDataFrame(rows_, "grid_id long, lam_item double, rmse double")
    assert best_point(curve).first()["lam_item"] == 2.0


def test_tune_chains_the_best_penalties(keep, train, test_rows):
    axes = (Axis(1, 9, 2), Axis(1, 9, 2), Axis(1, 9, 2))
    start = fit(train, {"any": (7, 7, 7)}, keep, "start")
    best = tune(start, train, test_rows, axes, keep, "t").first()
    lams = [0.0, 0.0, 0.0]
    for depth, axis in enumerate(axes):
        tried = []
        for i in range(axis.size):
            lams[depth] = axis.first + i * axis.step
            model = fit(train, {"s": lams}, keep, f"c{depth}_{i}")
            rmse = score(test_rows, model, [Model("m", depth + 1, "s")]).first()["rmse"]
            tried.append((rmse, lams[depth]))
        lams[depth] = min(tried)[1]
    assert [best["lam_item"], best["lam_user"], best["lam_genre"]] == lams


def test_effects_for_another_last_penalty_need_no_refit(keep, train, test_rows):
    one = fit(train, {"s": (1, 1, 1)}, keep, "one")
    moved = replace(one, settings={"s": (1, 1, 4)})
    refit = fit(train, {"s": (1, 1, 4)}, keep, "four")
    model = [Model("m", 3, "s")]
    a, b = (score(test_rows, e, model).first()["rmse"] for e in (moved, refit))
    assert a == pytest.approx(b, abs=1e-12)


JOINT = (Axis(1.0, 2.0, 0.5), Axis(0.0, 3.0, 1.0), Axis(0.5, 1.5, 0.5))


@pytest.mark.parametrize("prefixes, points", [(32, 96), (5, 4)])
def test_joint_curve_equals_refitting_every_combination(
    keep, train, test_rows, monkeypatch, prefixes, points
):
    monkeypatch.setattr(joint, "PREFIXES", prefixes)
    monkeypatch.setattr(joint, "POINTS", points)
    base = fit(train, {"s": (9.0, 9.0, 9.0)}, keep, "base")
    grid = joint_curve(base, train, test_rows, JOINT, keep, "joint").orderBy("grid_id").collect()
    assert [r["grid_id"] for r in grid] == list(range(36))
    assert [r["lam_item"] for r in grid[:4]] == [1.0, 1.5, 2.0, 1.0]
    points_of = {f"p{r['grid_id']}": (r["lam_item"], r["lam_user"], r["lam_genre"]) for r in grid}
    assert len(set(points_of.values())) == 36
    refit = fit(train, points_of, keep, "refit")
    models = [Model(name, 3, name) for name in points_of]
    naive = {r["model"]: r["rmse"] for r in score(test_rows, refit, models).collect()}
    for r in grid:
        assert r["rmse"] == pytest.approx(naive[f"p{r['grid_id']}"], abs=1e-12)
    best = tune_jointly(base, train, test_rows, JOINT, keep, "joint").first()
    assert best["rmse"] == min(r["rmse"] for r in grid)


@pytest.mark.parametrize("depth", [1, 2])
def test_joint_curve_of_fewer_axes(keep, train, test_rows, depth):
    base = fit(train, {"s": (9.0, 9.0, 9.0)}, keep, "base")
    grid = joint_curve(base, train, test_rows, JOINT[:depth], keep, "joint").collect()
    for r in grid:
        lams = [r[c] for c in ("lam_item", "lam_user")[:depth]]
        refit = fit(train, {"s": (*lams, 0.0)}, keep, f"refit{r['grid_id']}")
        naive = score(test_rows, refit, [Model("m", depth, "s")]).first()
        assert r["rmse"] == pytest.approx(naive["rmse"], abs=1e-12)
    assert len(grid) == (3, 12)[depth - 1]


def test_joint_curve_with_an_unseen_group_is_missing(spark, keep, train, test_rows):
    base = fit(train, {"s": (9.0, 9.0, 9.0)}, keep, "base")
    for unseen in ((99, 1, 3.0, "g1"), (1, 99, 3.0, "g1"), (1, 1, 3.0, "new")):
        rows = test_rows.unionByName(spark.createDataFrame([unseen], SCHEMA))
        grid = joint_curve(base, train, rows, JOINT, keep, "joint").collect()
        assert {r["rmse"] for r in grid} == {None}


def test_joint_curve_scans_rows_once_a_level(spark, keep, train, test_rows, scans):
    """However many points: two scans of train (the first level is reused), one of test."""
    base = fit(train, {"s": (9.0, 9.0, 9.0)}, keep, "base")
    counted, seen = scans(train)
    tested, seen_test = scans(test_rows)
    joint_curve(base, counted, tested, JOINT, keep, "joint").collect()
    assert (seen(), seen_test()) == (2 * train.count(), test_rows.count())
