"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest

from biasloom.operators.effects import effect_table, fit, fit_aligned
from biasloom.operators.joins import rows_not_in
from biasloom.operators.sampling import holdout_split, stratified_sample
from biasloom.operators.scoring import Model, score
from biasloom.plans.pipeline import COLD_KEYS, LADDER, SETTINGS, pipeline
from biasloom.plans.queries import REGISTRY
from biasloom.schemas import ROW_KEY
from biasloom.sources import Buckets, bind_ratings

SF_DIR = "/root/testdata/sf0.001"
NEVER = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def recording(keep):
    """A keep that also records the plan of everything it builds."""
    plans: dict[str, str] = {}

    def recorder(name, build, **options):
        df = build()
        plans[name] = plan(df)
        return keep(name, lambda: df, **options)

    recorder.plans = plans
    return recorder


@pytest.fixture
def no_broadcast(spark):
    names = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    ]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", REGISTRY)
def test_queries_stay_in_the_jvm_without_products_or_windows(spark, name):
    text = plan(REGISTRY[name](spark, SF_DIR))
    assert not [word for word in [*NEVER, "Window"] if word in text]


def test_fitting_reduces_before_every_shuffle(spark, recording):
    train = pipeline(spark, SF_DIR).train
    fit(train, SETTINGS, recording, "fit")
    assert list(recording.plans) == ["fit_item_id", "fit_user_id", "fit_genres"]
    for depth, text in enumerate(recording.plans.values()):
        assert "partial_sum" in text and "partial_count" in text
        assert text.count("Exchange hashpartitioning") == 1
        assert text.count("BroadcastHashJoin") == depth
        assert "Window" not in text and "PartitionFilters: [isnotnull(in_sample" in text
        assert "Union" not in text


def test_fitting_reads_needed_columns_only(spark, recording):
    fit(pipeline(spark, SF_DIR).train, SETTINGS, recording, "fit")
    assert "ReadSchema: struct<item_id:bigint,rating:double>" in recording.plans["fit_item_id"]


def test_splitting_neither_ranks_nor_shuffles_rows(spark, recording):
    ratings = pipeline(spark, SF_DIR).ratings
    sample = stratified_sample(ratings, "rating", 0.1, 1, ROW_KEY)
    split = holdout_split(ratings, sample, COLD_KEYS, recording, "s", True)
    text = plan(split)
    assert "Window" not in text and "Sort" not in text
    assert "Exchange hashpartitioning" not in text
    assert sorted(recording.plans) == ["s_cold", "s_flagged", "s_sampled"]
    for name, made in recording.plans.items():
        assert "Window" not in made
        assert ("partial_min" in made) == (name == "s_cold")
        assert ("Exchange hashpartitioning" in made) == (name == "s_cold")


def test_seven_models_are_scored_in_one_scan(spark):
    p = pipeline(spark, SF_DIR)
    text = plan(score(p.test, p.effects, LADDER))
    assert text.count("rating:double") == 1


def test_a_model_joins_only_the_levels_it_uses(spark):
    p = pipeline(spark, SF_DIR)
    for model in LADDER:
        text = plan(score(p.test, p.effects, [model]))
        assert text.count("BroadcastHashJoin") == model.depth


def test_beyond_the_broadcast_threshold_joins_are_sorted_and_equal(
    spark, recording, no_broadcast
):
    p = pipeline(spark, SF_DIR)
    assert "BroadcastHashJoin" not in plan(bind_ratings(spark, SF_DIR))
    sorted_ = fit(p.train, SETTINGS, recording, "fit")
    assert "SortMergeJoin" in recording.plans["fit_genres"]
    assert "Broadcast" not in recording.plans["fit_genres"]
    model = [Model("m", 3, "shrunk")]
    rmse = [score(p.test, e, model).first()["rmse"] for e in (sorted_, p.effects)]
    assert rmse[0] == pytest.approx(rmse[1], abs=1e-12)


def test_an_anti_join_shuffles_each_side_once(spark, no_broadcast):
    left = spark.range(100).selectExpr("id AS a", "id % 7 AS b")
    right = spark.range(50).selectExpr("id AS a", "id % 5 AS b")
    text = plan(rows_not_in(left, right))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("key", ["user_id", "item_id"])
def test_rows_that_lie_apart_by_a_key_are_not_moved_for_it(spark, recording, no_broadcast, key):
    """Sort-merge joins and groups on the bucketed key leave the rows where they are."""
    train = pipeline(spark, SF_DIR).train
    buckets = Buckets(key, 4)
    aligned = fit_aligned(train, SETTINGS, recording, "a", buckets)
    other = "item_id" if key == "user_id" else "user_id"
    if key == "item_id":
        assert "Exchange" not in recording.plans["a_item_id"]
    for name in ["a_genres", "a_user_id"][: 1 + (key == "item_id")]:
        text = recording.plans[name]
        assert "Broadcast" not in text
        # Rows and effects are read with their buckets and joined as they lie.
        assert text.count("Bucketed: true") == 2
        assert f"Exchange hashpartitioning({key}" not in text
        assert f"coalesce({key}" not in text
    assert f"Exchange hashpartitioning(coalesce({other}" in recording.plans["a_genres"]
    plain = fit(train, SETTINGS, recording, "p")
    for level in ("item_id", "user_id", "genres"):
        for setting in SETTINGS:
            got, want = (
                {r[level]: (r["n"], r["b"]) for r in effect_table(e, level, setting, "b").collect()}
                for e in (aligned, plain)
            )
            assert got.keys() == want.keys()
            assert all(got[k][0] == want[k][0] for k in got)
            assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in got)


def test_missing_keys_are_a_group_of_aligned_rows_too(spark, keep):
    rows = [(u, i, float(i or 3), f"g{k % 2}") for k, (u, i) in enumerate(
        [(1, 1), (None, 1), (None, 2), (2, None), (2, 2), (None, None)] * 3)]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating double, genres string")
    plain = fit(train, SETTINGS, keep, "p")
    for key in ("user_id", "item_id"):
        aligned = fit_aligned(train, SETTINGS, keep, f"a_{key}", Buckets(key, 3))
        for level in ("item_id", "user_id", "genres"):
            got, want = (
                sorted(
                    str((r[level], r["n"], round(r["b"], 9)))
                    for r in effect_table(e, level, "shrunk", "b").collect()
                )
                for e in (aligned, plain)
            )
            assert got == want
        model = [Model("m", 3, "shrunk")]
        assert score(train, aligned, model).first()["rmse"] == pytest.approx(
            score(train, plain, model).first()["rmse"]
        )
