"""Named queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.functions import residual
from biasloom.operators import histogram, profile
from biasloom.operators.effects import (
    effect_table,
    global_mean,
    group_mean_on_rows,
    group_means_on_rows,
)
from biasloom.operators.joins import attach, rows_not_in
from biasloom.operators.sampling import stratified_sample
from biasloom.operators.scoring import improvement, score
from biasloom.operators.tuning import best_point
from biasloom.plans.pipeline import DEV, HOLDOUT, LADDER, Pipeline, pipeline
from biasloom.schemas import ROW_KEY
from biasloom.sources import (
    bind_items,
    bind_ratings,
    read_items,
    read_ratings,
    split_ratings,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

GENRE_PATTERNS = {
    "n_ring": "ring",
    "n_bolt": "bolt",
    "n_economy": "ECONOMY",
    "n_large": "LARGE",
}


def query(build: Callable[[Pipeline], DataFrame]) -> Callable[[Pipeline], DataFrame]:
    """Register a query under its function's name, on customers as raters."""
    return _register(build, build.__name__, "customer")


def basket_query(build: Callable[[Pipeline], DataFrame]):
    """Register a query on baskets as raters, where cold rows abound."""
    return _register(build, build.__name__, "basket")


def _register(build, name: str, rater: str):
    REGISTRY[name] = lambda spark, sf_dir: build(pipeline(spark, sf_dir, rater))
    return build


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- scans, joins, profile -------------------------------------------------


@query
def scan_ratings_text(p: Pipeline) -> DataFrame:
    fields = ["user_id", "item_id", "rating", "ts"]
    lines = p.ratings.select(F.concat_ws("::", *fields).alias("value"))
    p.keep("ratings_text", lambda: lines, fmt="text")
    return read_ratings(p.spark, p.store.files("ratings_text", lines))


def _mixed_lines(p: Pipeline):
    """Lines of ratings and of items in one folder; items are no ratings."""
    part = table(p.spark, p.sf_dir, "part")
    ratings = p.ratings.select(
        F.concat_ws("::", "user_id", "item_id", "rating", "ts").alias("value")
    )
    items = part.select(F.concat_ws("::", "p_partkey", "p_name", "p_type").alias("value"))
    wider = part.select(
        F.concat_ws("::", "p_partkey", "p_size", "p_name", "p_brand").alias("value")
    )
    lines = ratings.unionByName(items).unionByName(wider)
    p.keep("mixed_text", lambda: lines, fmt="text")
    return split_ratings(p.spark, p.store.files("mixed_text", lines), p.keep, "mixed")


@query
def accepted_lines(p: Pipeline) -> DataFrame:
    return _mixed_lines(p).rows


@query
def rejected_lines(p: Pipeline) -> DataFrame:
    return _mixed_lines(p).rejected.select("line", "reason")


@query
def scan_items_text(p: Pipeline) -> DataFrame:
    # Four parts per line: the third one read keeps the surplus.
    part = table(p.spark, p.sf_dir, "part")
    fields = ["p_partkey", "p_name", "p_type", "p_brand"]
    lines = part.select(F.concat_ws("::", *fields).alias("value"))
    p.keep("items_text", lambda: lines, fmt="text")
    return read_items(p.spark, p.store.files("items_text", lines))


@query
def left_join_items(p: Pipeline) -> DataFrame:
    items = bind_items(p.spark, p.sf_dir)
    return attach(p.ratings.drop("title", "genres"), items, "item_id")


@query
def bound_ratings(p: Pipeline) -> DataFrame:
    return bind_ratings(p.spark, p.sf_dir, p.rater)


@query
def preview_rows(p: Pipeline) -> DataFrame:
    return profile.preview(p.development, ["user_id", "item_id", *ROW_KEY])


@query
def table_dims(p: Pipeline) -> DataFrame:
    return profile.dimensions(p.development)


@query
def rating_equals_counts(p: Pipeline) -> DataFrame:
    return profile.equal_counts(p.development, "rating", {"n_zero": 0.0, "n_three": 3.0})


@query
def genre_match_counts(p: Pipeline) -> DataFrame:
    return profile.match_counts(p.development, "genres", GENRE_PATTERNS)


@query
def whole_rating_share(p: Pipeline) -> DataFrame:
    return rounded(profile.whole_share(p.development, "rating"), "whole_share")


@query
def distinct_counts(p: Pipeline) -> DataFrame:
    return profile.distinct_counts(p.development, {"n_items": "item_id", "n_users": "user_id"})


@query
def null_counts(p: Pipeline) -> DataFrame:
    parts = [
        profile.missing_counts(df).withColumn("table_name", F.lit(name))
        for name, df in (("development", p.development), ("validation", p.validation))
    ]
    return parts[0].unionByName(parts[1])


@query
def dataset_summary(p: Pipeline) -> DataFrame:
    return profile.summary(p.development.unionByName(p.validation))


@query
def top_items_by_count(p: Pipeline) -> DataFrame:
    return profile.most_frequent(p.development, ["item_id", "title"], 10)


@query
def top_rating_values(p: Pipeline) -> DataFrame:
    return profile.most_frequent(p.development, ["rating"], 5)


@query
def rating_frequency(p: Pipeline) -> DataFrame:
    return profile.frequency(p.development, "rating")


@query
def distinct_genres(p: Pipeline) -> DataFrame:
    return p.development.select("genres").distinct()


@query
def rating_histogram(p: Pipeline) -> DataFrame:
    return rounded(histogram.fixed_width(p.development, "rating", 0.5, True), "center")


@query
def event_value_histogram(p: Pipeline) -> DataFrame:
    # A width that no double holds exactly.
    events = table(p.spark, p.sf_dir, "events")
    return rounded(histogram.fixed_width(events, "value", 0.1, True), "center")


@query
def order_total_runs(p: Pipeline) -> DataFrame:
    # Values far apart: nearly all of the bins are empty.
    orders = table(p.spark, p.sf_dir, "orders")
    return rounded(histogram.fixed_width(orders, "o_totalprice", 0.01), "center")


def _effect_histogram(p: Pipeline, level: str) -> DataFrame:
    bias = effect_table(p.effects, level, "plain", "bias")
    return rounded(histogram.fixed_count(bias, "bias", 20), "center")


@query
def item_effect_histogram(p: Pipeline) -> DataFrame:
    return _effect_histogram(p, "item_id")


@query
def user_effect_histogram(p: Pipeline) -> DataFrame:
    return _effect_histogram(p, "user_id")


@query
def genre_effect_histogram(p: Pipeline) -> DataFrame:
    return _effect_histogram(p, "genres")


# -- samples and splits ----------------------------------------------------


@query
def sampled_ratings(p: Pipeline) -> DataFrame:
    sample = p.sample(p.ratings, **HOLDOUT)
    return sample.rows(p.ratings).select(*ROW_KEY, "rating")


@query
def sampled_events(p: Pipeline) -> DataFrame:
    events = table(p.spark, p.sf_dir, "events").select("event_id", "user_id", "value")
    sample = stratified_sample(events, "value", DEV["p"], DEV["seed"], ["event_id"])
    return sample.flagged(events)


@query
def dev_subset(p: Pipeline) -> DataFrame:
    return p.dev.select(*ROW_KEY, "user_id", "rating")


@query
def holdout_split(p: Pipeline) -> DataFrame:
    return p.holdout.select(*ROW_KEY, "part")


@basket_query
def holdout_split_basket(p: Pipeline) -> DataFrame:
    return p.holdout.select(*ROW_KEY, "part")


@basket_query
def holdout_given_back(p: Pipeline) -> DataFrame:
    back = p.holdout.filter(F.col("cold") & (F.col("part") == "train"))
    return back.select(*ROW_KEY, "rating")


@basket_query
def sampled_not_in_holdout(p: Pipeline) -> DataFrame:
    sampled = p.sample(p.ratings, **HOLDOUT).rows(p.ratings)
    return rows_not_in(sampled, p.validation).select(*ROW_KEY, "rating")


@query
def train_test_split(p: Pipeline) -> DataFrame:
    return p.split.select(*ROW_KEY, "part")


@basket_query
def train_test_split_basket(p: Pipeline) -> DataFrame:
    return p.split.select(*ROW_KEY, "part")


@query
def cold_start_filter(p: Pipeline) -> DataFrame:
    return p.seen_in_dev().select(*ROW_KEY, "user_id")


# -- effects ---------------------------------------------------------------


@query
def mean_rating(p: Pipeline) -> DataFrame:
    return rounded(global_mean(p.train), "mu")


def _effects_of(p: Pipeline, level: str, setting: str, alias: str) -> DataFrame:
    return rounded(effect_table(p.effects, level, setting, alias), alias)


@query
def item_effect_mean(p: Pipeline) -> DataFrame:
    return _effects_of(p, "item_id", "plain", "bi")


@query
def user_effect_mean(p: Pipeline) -> DataFrame:
    return _effects_of(p, "user_id", "plain", "bu")


@query
def genre_effect_mean(p: Pipeline) -> DataFrame:
    return _effects_of(p, "genres", "plain", "bg")


@query
def item_effect_shrunk(p: Pipeline) -> DataFrame:
    return _effects_of(p, "item_id", "shrunk", "bi")


@query
def user_effect_shrunk(p: Pipeline) -> DataFrame:
    return _effects_of(p, "user_id", "shrunk", "bu")


@query
def genre_effect_shrunk(p: Pipeline) -> DataFrame:
    return _effects_of(p, "genres", "shrunk", "bg")


@query
def user_effect_aligned(p: Pipeline) -> DataFrame:
    return rounded(effect_table(p.aligned_effects("user_id"), "user_id", "shrunk", "bu"), "bu")


@query
def genre_effect_aligned(p: Pipeline) -> DataFrame:
    return rounded(effect_table(p.aligned_effects("item_id"), "genres", "shrunk", "bg"), "bg")


@basket_query
def model_ladder_aligned_basket(p: Pipeline) -> DataFrame:
    scores = score(p.test, p.aligned_effects("user_id"), LADDER)
    return scores.withColumn("rmse", F.round("rmse", 5))


def _rows_with_item_mean(p: Pipeline) -> DataFrame:
    off_mean = residual(p.effects.mu, [])
    return group_mean_on_rows(p.train, "item_id", off_mean, "bi", p.keep, "on_rows")


@query
def item_effect_window(p: Pipeline) -> DataFrame:
    return rounded(_rows_with_item_mean(p).select(*ROW_KEY, "bi"), "bi")


@query
def user_effect_window(p: Pipeline) -> DataFrame:
    means = [
        ("item_id", residual(p.effects.mu, []), "bi"),
        ("user_id", residual(p.effects.mu, ["bi"]), "bu"),
    ]
    rows = group_means_on_rows(p.train, means, p.keep, "on_rows")
    return rounded(rows.select(*ROW_KEY, "bi", "bu"), "bi", "bu")


# -- predictions, scores, tuning -------------------------------------------


@query
def predictions_final(p: Pipeline) -> DataFrame:
    return rounded(p.predictions().select(*ROW_KEY, "rating", "r_hat"), "r_hat")


def _model_query(model) -> None:
    def build(p: Pipeline) -> DataFrame:
        return rounded(p.scores(model), "rmse")

    _register(build, f"rmse_model{model.name[0]}", "customer")


for _model in LADDER:
    _model_query(_model)


@query
def model_ladder(p: Pipeline) -> DataFrame:
    return p.ladder().withColumn("rmse", F.round("rmse", 5))


@basket_query
def model_ladder_basket(p: Pipeline) -> DataFrame:
    return p.ladder().withColumn("rmse", F.round("rmse", 5))


@query
def improvement_over_naive(p: Pipeline) -> DataFrame:
    return rounded(improvement(p.ladder(), LADDER[0].name), "rmse", "improvement")


@query
def tune_lambda_item(p: Pipeline) -> DataFrame:
    return rounded(p.curve("item_id"), "rmse")


@query
def tune_lambda_user(p: Pipeline) -> DataFrame:
    return rounded(p.curve("user_id"), "rmse")


@query
def tune_lambda_genre(p: Pipeline) -> DataFrame:
    return rounded(p.curve("genres"), "rmse")


@query
def best_lambda_item(p: Pipeline) -> DataFrame:
    return rounded(best_point(p.curve("item_id")), "rmse")


@query
def best_lambdas(p: Pipeline) -> DataFrame:
    return rounded(p.best_penalties(), "rmse")


@basket_query
def best_lambdas_basket(p: Pipeline) -> DataFrame:
    return rounded(p.best_penalties(), "rmse")


@query
def tune_lambdas_jointly(p: Pipeline) -> DataFrame:
    return rounded(p.joint_curve(), "rmse")


@basket_query
def tune_lambdas_jointly_basket(p: Pipeline) -> DataFrame:
    return rounded(p.joint_curve(), "rmse")


@query
def best_lambdas_jointly(p: Pipeline) -> DataFrame:
    return rounded(best_point(p.joint_curve()), "rmse")


@query
def final_holdout_rmse(p: Pipeline) -> DataFrame:
    return rounded(p.final_score(), "rmse")


@query
def final_holdout_rmse_subset_filter(p: Pipeline) -> DataFrame:
    return rounded(p.final_score(seen_in="dev train"), "rmse")


@query
def final_test_rmse(p: Pipeline) -> DataFrame:
    return rounded(p.final_test_score(), "rmse")
