from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from biasloom.operators import sampling
from biasloom.operators.joins import seen_only
from biasloom.operators.sampling import (
    Copies,
    cold_keys,
    holdout_split,
    order_statistics,
    quantiles,
    quartile_bin,
    stratified_sample,
)


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"y {kind}")


SHAPES = {
    "few values": [0.5 * (1 + i * i % 10) for i in range(997)],
    "uniform": [random.Random(1).random() for _ in range(5000)],
    "long tail": [math.exp(20 * random.Random(2 + i).random()) for i in range(3000)],
    "hot value": [7.0] * 2000 + [float(i) for i in range(1000)],
    "outlier": [1e15, *(random.Random(3 + i).random() for i in range(1000))],
    "constant": [3.0] * 50,
    "single": [4.0],
    "two": [1.0, 2.0],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_equal_numpy(spark, shape):
    values = SHAPES[shape]
    expected = np.quantile(values, [0, 0.25, 0.5, 0.75, 1])
    assert quantiles(numbers(spark, values), "y") == pytest.approx(list(expected))


def spans(ranks):
    return {(0, r): (0, 2**60, 0) for r in ranks}


def test_order_statistics_count_ties(spark):
    df = numbers(spark, [5, 1, 3, 3, 3, 9], "long")
    at = order_statistics(df, F.col("y"), spans([0, 2, 5]))
    found = [(s.value, s.below, s.equal) for s in at.values()]
    assert sorted(found) == [(1, 0, 1), (3, 1, 3), (9, 5, 1)]


def test_order_statistics_of_close_large_values(spark):
    base = 2**60 - 2000
    values = [base + i for i in range(1000)] + [0]
    df = numbers(spark, values, "long")
    at = order_statistics(df, F.col("y"), spans([1, 500, 1000]))
    assert {r: s.value for (_, r), s in at.items()} == {
        r: sorted(values)[r] for r in (1, 500, 1000)
    }


def test_order_statistics_with_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKETS", 4)
    values = [random.Random(i).randrange(10**6) for i in range(500)]
    df = numbers(spark, values, "long")
    ranks = range(0, 500, 37)
    at = order_statistics(df, F.col("y"), spans(ranks))
    assert [at[0, r].value for r in ranks] == [sorted(values)[r] for r in ranks]


def test_quantiles_of_nothing(spark):
    assert quantiles(numbers(spark, [None]), "y") == []


def ratings(spark, n=3000, users=40, items=60):
    rng = random.Random(5)
    rows = [
        (rng.randrange(users), rng.randrange(items), rng.randrange(1, 11) / 2, i)
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "user_id long, item_id long, rating double, row long"
    )


def quota_check(df, flagged, p):
    bins = quartile_bin("rating", quantiles(df, "rating"))
    rows = flagged.groupBy(bins.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("in_sample").alias("taken")
    )
    for r in rows.collect():
        assert r["taken"] == math.ceil(p * r["n"]), r


@pytest.mark.parametrize("p", [0.0, 0.1, 0.112, 0.5, 1.0])
def test_quota_is_exact_in_every_bin(spark, p):
    df = ratings(spark)
    flagged = stratified_sample(df, "rating", p, 1, ["row"]).flagged(df)
    assert flagged.count() == df.count()
    quota_check(df, flagged, p)


def test_sample_ignores_partitioning_and_heeds_the_seed(spark):
    df = ratings(spark)

    def taken(frame, seed):
        sample = stratified_sample(frame, "rating", 0.2, seed, ["row"])
        return {r["row"] for r in sample.rows(frame).collect()}

    assert taken(df, 1) == taken(df.repartition(17, "item_id"), 1)
    assert taken(df, 1) != taken(df, 2)


def test_sample_equals_ranking_by_hash(spark):
    from pyspark.sql import Window

    from biasloom.functions import row_hash

    df = ratings(spark)
    bins = quartile_bin("rating", quantiles(df, "rating"))
    rank = F.row_number().over(
        Window.partitionBy(bins).orderBy(row_hash(9, ["row"]))
    )
    size = F.count(F.lit(1)).over(Window.partitionBy(bins))
    ranked = df.withColumn("brute", rank <= F.ceil(size * 0.3))
    flagged = stratified_sample(df, "rating", 0.3, 9, ["row"]).flagged(ranked)
    assert flagged.filter("brute <> in_sample").count() == 0


def test_missing_outcomes_are_a_stratum_of_their_own(spark):
    df = ratings(spark, 400).withColumn(
        "rating", F.when(F.col("row") % 4 == 0, None).otherwise(F.col("rating"))
    )
    flagged = stratified_sample(df, "rating", 0.25, 3, ["row"]).flagged(df)
    assert flagged.count() == 400
    assert flagged.filter("rating IS NULL AND in_sample").count() == 25


def with_copies(df, copies):
    """df and so many copies of one row, which fall into one bin."""
    copy = df.sparkSession.range(copies).select(
        F.lit(1).cast("long").alias("user_id"),
        F.lit(2).cast("long").alias("item_id"),
        F.lit(3.0).alias("rating"),
        F.lit(-1).cast("long").alias("row"),
    )
    return df.unionByName(copy)


@pytest.mark.parametrize("chunk, key", [(7, None), (1_000_000, None), (7, ["user_id"])])
def test_a_third_of_all_rows_being_copies_is_spread(spark, monkeypatch, chunk, key):
    monkeypatch.setattr(sampling, "COPY_CHUNK", chunk)
    df = with_copies(ratings(spark, 600), 300)
    flagged = stratified_sample(df, "rating", 0.2, 1, key).flagged(df)
    quota_check(df, flagged, 0.2)
    assert Counter(flagged.drop("in_sample").collect()) == Counter(df.collect())
    taken = flagged.filter("row = -1 AND in_sample").count()
    assert 40 <= taken <= 80 or key == ["user_id"]


def test_copies_are_drawn_one_by_one_whatever_their_number(spark):
    """No number of copies, and no step from one to the next, changes the rule."""
    sizes = {-1: 1, -16: 16, -17: 17, -31: 31, -32: 32, -333: 333}
    rows = [(float(i % 7), i) for i in range(570)]
    rows += [(3.0, row) for row, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "rating double, row long").cache()
    seeds, taken = range(20), Counter()
    for seed in seeds:
        flagged = stratified_sample(df, "rating", 0.1, seed).flagged(df)
        for r in flagged.filter("row < 0 AND in_sample").groupBy("row").count().collect():
            taken[r["row"]] += r["count"]
        if seed < 2:
            quota_check(df, flagged, 0.1)
    for row, n in sizes.items():
        drawn = n * len(seeds)
        assert abs(taken[row] / drawn - 0.1) <= 4 * math.sqrt(0.09 / drawn), (n, taken[row])


def test_copies_of_a_key_at_the_threshold_are_split_exactly(spark):
    df = with_copies(ratings(spark, 40), 12)
    hit = False
    for seed in range(30):
        sample = stratified_sample(df, "rating", 0.5, seed, ["row"])
        flagged = sample.flagged(df)
        quota_check(df, flagged, 0.5)
        assert Counter(flagged.drop("in_sample").collect()) == Counter(df.collect())
        hit = sample.ties is not None and isinstance(sample.ties.ties, Copies)
        if hit:
            break
    assert hit


def test_missing_and_infinite_outcomes(spark):
    rows = [(float(i), i) for i in range(50)] + [(float("nan"), 50 + i) for i in range(10)]
    df = spark.createDataFrame(rows, "rating double, row long")
    assert quantiles(df, "rating") == [0.0, 12.25, 24.5, 36.75, 49.0]
    flagged = stratified_sample(df, "rating", 0.5, 1, ["row"]).flagged(df)
    assert flagged.count() == 60
    assert flagged.filter("in_sample AND isnan(rating)").count() == 5
    endless = df.unionByName(df.limit(1).withColumn("rating", F.lit(float("-inf"))))
    with pytest.raises(ValueError, match="infinite"):
        quantiles(endless, "rating")
    with pytest.raises(ValueError, match="infinite"):
        stratified_sample(endless, "rating", 0.5, 1, ["row"])


@pytest.mark.parametrize("spread", [3, 20, 60])
def test_quantiles_of_any_spread_take_two_scans(spark, scans, spread):
    rng = random.Random(spread)
    values = [10 ** rng.uniform(-spread, spread) for _ in range(20_000)]
    df, read = scans(spark.createDataFrame([(v,) for v in values], "y double"))
    got = quantiles(df, "y")
    assert got == pytest.approx(list(np.quantile(values, [0, 0.25, 0.5, 0.75, 1])), rel=1e-12)
    assert read() <= 2 * len(values)


def test_a_sketch_that_is_off_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BRACKET", 0.0)
    monkeypatch.setattr(sampling, "ACCURACY", 5)
    values = [random.Random(i).random() for i in range(3000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "rating double, row long")
    expected = np.quantile(values, [0, 0.25, 0.5, 0.75, 1])
    assert quantiles(df, "rating") == pytest.approx(list(expected))
    flagged = stratified_sample(df, "rating", 0.3, 2, ["row"]).flagged(df)
    quota_check(df, flagged, 0.3)


@pytest.mark.parametrize("give_back", [True, False])
def test_a_holdout_reads_its_input_four_times(spark, keep, scans, give_back):
    rng = random.Random(1)
    rows = [(rng.randrange(900), rng.randrange(700), rng.random(), i) for i in range(12_000)]
    df, read = scans(
        spark.createDataFrame(rows, "user_id long, item_id long, rating double, row long")
    )
    sample = stratified_sample(df, "rating", 0.1, 1, ["row"], keep)
    split = holdout_split(df, sample, ["item_id", "user_id"], keep, "s", give_back)
    assert split.count() <= len(rows)
    assert read() <= 4 * len(rows)


@pytest.mark.parametrize("p", [0.0, 0.1, 0.33, 1.0])
def test_nothing_but_copies(spark, p):
    df = with_copies(ratings(spark, 0), 100).unionByName(
        with_copies(ratings(spark, 0), 41).withColumn("rating", F.lit(1.0))
    )
    flagged = stratified_sample(df, "rating", p, 1).flagged(df)
    quota_check(df, flagged, p)
    assert flagged.count() == 141


def test_rows_that_share_the_key_are_told_apart_by_the_rest(spark):
    df = ratings(spark, 900).withColumn("key", F.lit(1))
    sample = stratified_sample(df, "rating", 0.4, 4, ["key"])
    flagged = sample.flagged(df)
    quota_check(df, flagged, 0.4)
    assert sample.ties is not None and not isinstance(sample.ties, Copies)
    assert flagged.drop("in_sample").exceptAll(df).count() == 0


@pytest.fixture
def sparse(spark):
    """Many users with one or two ratings, so that splits leave cold rows."""
    return ratings(spark, 1500, users=900, items=700)


def keys_of(df, key):
    return {r[key] for r in df.select(key).distinct().collect()}


@pytest.mark.parametrize("give_back", [True, False])
def test_holdout_never_holds_unseen_keys(spark, keep, sparse, give_back):
    sample = stratified_sample(sparse, "rating", 0.2, 1, ["row"])
    split = holdout_split(
        sparse, sample, ["item_id", "user_id"], keep, "s", give_back
    ).collect()
    drawn = sample.flagged(sparse).collect()
    base = [r for r in drawn if not r["in_sample"]]
    items, users = {r["item_id"] for r in base}, {r["user_id"] for r in base}
    kept = {
        r["row"]
        for r in drawn
        if r["in_sample"] and r["item_id"] in items and r["user_id"] in users
    }
    test = {r["row"] for r in split if r["part"] == "test"}
    train = {r["row"] for r in split if r["part"] == "train"}
    cold = {r["row"] for r in drawn if r["in_sample"]} - kept
    assert cold and test == kept and not test & train
    expected = {r["row"] for r in base} | (cold if give_back else set())
    assert train == expected
    assert len(split) == len(train) + len(test)


def test_split_with_missing_keys(spark, keep):
    rows = [(None, 1, 3.0, i) for i in range(20)] + [(2, None, 4.0, 20 + i) for i in range(20)]
    df = spark.createDataFrame(
        rows, "user_id long, item_id long, rating double, row long"
    )
    sample = stratified_sample(df, "rating", 0.2, 1, ["row"])
    split = holdout_split(df, sample, ["item_id", "user_id"], keep, "n", True)
    assert split.filter("part = 'test'").count() == 8
    assert split.count() == 40


def test_seen_only_matches_missing_with_missing(spark, keep):
    schema = "user_id long, item_id long, row int"
    train = spark.createDataFrame([(1, 10, 0), (None, 11, 1)], schema)
    test = spark.createDataFrame(
        [(1, 11, 0), (None, 10, 1), (2, 10, 2), (1, 12, 3)], schema
    )
    kept = seen_only(test, train, ["item_id", "user_id"], keep, "seen")
    assert sorted(r["row"] for r in kept.collect()) == [0, 1]


def test_cold_keys_of_all_keys_in_one_read(spark, keep, sparse, scans):
    flagged = stratified_sample(sparse, "rating", 0.2, 1, ["row"]).flagged(sparse)
    rows, read = scans(flagged)
    found = cold_keys(rows, ["item_id", "user_id"]).collect()
    assert read() == sparse.count()
    drawn = flagged.collect()
    for place, key in enumerate(["item_id", "user_id"]):
        want = {r[key] for r in drawn} - {r[key] for r in drawn if not r["in_sample"]}
        assert want and {r[key] for r in found if r["of"] == place} == want
    one = cold_keys(flagged, ["user_id"]).collect()
    assert {r["user_id"] for r in one} == {r["user_id"] for r in found if r["of"] == 1}


@pytest.mark.parametrize("p", [0.1, 0.5])
def test_thresholds_are_the_same_on_the_driver_and_off_it(spark, monkeypatch, p):
    df = ratings(spark, 4000)
    for key in (["row"], None):
        here = stratified_sample(df, "rating", p, 3, key)
        monkeypatch.setattr(sampling, "EDGE_ROWS", 0)
        there = stratified_sample(df, "rating", p, 3, key)
        monkeypatch.undo()
        assert (here.thresholds, here.groups) == (there.thresholds, there.groups)
