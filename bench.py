"""Time the headline queries; prints one JSON line.

Every pass starts without any prepared table, so the first steps include
binding, sampling, splitting and fitting; each step is timed once per pass and
the median over the passes is reported. A pass over a small folder warms the
JVM up when there is one.

    BENCH_SF_DIR   input folder   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores    (default 8)
    BENCH_PASSES   passes         (default 3)
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from biasloom.operators import histogram, profile
from biasloom.operators.effects import effect_table
from biasloom.plans.pipeline import LADDER, Pipeline

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PASSES = int(os.environ.get("BENCH_PASSES", "3"))


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def steps(p: Pipeline) -> dict:
    """Steps in order; the prepare_* ones write the tables the rest reads."""
    return {
        "prepare_ratings": lambda: p.ratings,
        "prepare_holdout": lambda: p.holdout,
        "prepare_train_test": lambda: p.split,
        "fit_plain_and_shrunk": lambda: p.effects,
        "fit_final": lambda: p.final_effects,
        "dataset_summary": lambda: run(
            profile.summary(p.development.unionByName(p.validation))
        ),
        "null_counts": lambda: run(profile.missing_counts(p.development)),
        "genre_match_counts": lambda: run(
            profile.match_counts(p.development, "genres", {"n": "ring", "m": "LARGE"})
        ),
        "top_items_by_count": lambda: run(
            profile.most_frequent(p.development, ["item_id", "title"], 10)
        ),
        "rating_histogram": lambda: run(histogram.fixed_width(p.development, "rating", 0.5, True)),
        "user_effect_histogram": lambda: run(
            histogram.fixed_count(
                effect_table(p.effects, "user_id", "plain", "b"), "b", 20
            )
        ),
        "rmse_model0": lambda: run(p.scores(LADDER[0])),
        "rmse_model6": lambda: run(p.scores(LADDER[6])),
        "model_ladder": lambda: run(p.ladder()),
        "predictions_final": lambda: run(p.predictions()),
        "tune_lambda_item": lambda: run(p.curve("item_id")),
        "tune_lambda_user": lambda: run(p.curve("user_id")),
        "tune_lambda_genre": lambda: run(p.curve("genres")),
        "best_lambdas": lambda: run(p.best_penalties()),
    }


def one_pass(spark: SparkSession, sf_dir: str, store: str) -> dict[str, float]:
    took = {}
    for name, step in steps(Pipeline(spark, sf_dir, store=store)).items():
        began = time.perf_counter()
        step()
        took[name] = time.perf_counter() - began
    return took


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("biasloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = pathlib.Path(SF_DIR).parent / "sf0.001"
    if small.exists():
        one_pass(spark, str(small), "warm-up")
    passes = [one_pass(spark, SF_DIR, f"pass-{i}") for i in range(PASSES)]
    medians = {q: round(statistics.median(p[q] for p in passes), 3) for q in passes[0]}
    print(
        json.dumps(
            {
                "metric": "total_of_headline_queries",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
