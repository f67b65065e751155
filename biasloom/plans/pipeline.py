"""From bound tables to holdout, train/test split, fitted models and scores.

Each step that later steps read again is a prepared table (see
``biasloom.sources.store``), written once for an input folder and found again by
later applications until the pipeline is closed.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.operators.effects import Effects, fit, fit_aligned
from biasloom.operators.joins import seen_only
from biasloom.operators.joint import joint_curve
from biasloom.operators.sampling import (
    Sample,
    cold_table,
    holdout_split,
    stratified_sample,
)
from biasloom.operators.scoring import Model, predict, score
from biasloom.operators.tuning import Axis, tune, tuning_curve
from biasloom.schemas import LEVELS, ROW_KEY
from biasloom.sources import INPUTS, Buckets, TableStore, bind_ratings, version

# Published penalties, tuning grids, fractions and seeds.
PENALTIES = (2.2, 5.3, 1.7)
GRIDS = (Axis(2.0, 3.0, 0.1), Axis(4.5, 6.0, 0.1), Axis(1.6, 1.9, 0.1))
JOINT = (Axis(2.0, 3.0, 0.5), Axis(4.5, 6.0, 0.5), Axis(1.6, 1.8, 0.1))
HOLDOUT = {"p": 0.1, "seed": 1}
DEV = {"p": 0.1, "seed": 10}
SPLIT = {"p": 0.2, "seed": 20}
FINAL_SPLIT = {"p": 0.2, "seed": 50}

SETTINGS = {"plain": (0.0, 0.0, 0.0), "shrunk": PENALTIES}
COLD_KEYS = ("item_id", "user_id")

LADDER = (
    Model("0 mean", 0, "plain"),
    Model("1 item", 1, "plain"),
    Model("2 item+user", 2, "plain"),
    Model("3 item+user+genre", 3, "plain"),
    Model("4 shrunk item", 1, "shrunk"),
    Model("5 shrunk item+user", 2, "shrunk"),
    Model("6 shrunk item+user+genre", 3, "shrunk"),
)
FINAL = Model("final on holdout", 3, "shrunk")


class Pipeline:
    """The prepared tables and models over one folder of input tables."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        rater: str = "customer",
        store: str = "tables",
        known: Mapping[str, str] | None = None,
    ):
        """``known`` has marks of the inputs' files by path; else they are taken here."""
        self.spark, self.sf_dir, self.rater = spark, sf_dir, rater
        if known is None:
            known = input_marks(spark, sf_dir)
        self.store = TableStore(spark, f"{store}/{rater}", known)
        self.keep = self.store.keep

    # -- tables ------------------------------------------------------------

    @cached_property
    def ratings(self) -> DataFrame:
        bound = bind_ratings(self.spark, self.sf_dir, self.rater)
        return self.keep("ratings", lambda: bound)

    def sample(self, df: DataFrame, p: float, seed: int) -> Sample:
        return stratified_sample(df, "rating", p, seed, ROW_KEY, self.keep)

    def _split(
        self, name: str, df: DataFrame, p: float, seed: int, give_back: bool
    ) -> DataFrame:
        of = [df, "rating", p, seed, ROW_KEY]
        split = holdout_split(
            df, lambda: self.sample(df, p, seed), COLD_KEYS, self.keep, name, give_back, of
        )
        self.store.drop(cold_table(name), "sample_counts", "sample_edge")
        return split

    @cached_property
    def holdout(self) -> DataFrame:
        """All ratings: "test" is the holdout, cold rows are back in "train"."""
        return self._split("holdout", self.ratings, **HOLDOUT, give_back=True)

    @cached_property
    def development(self) -> DataFrame:
        return self.holdout.filter("part = 'train'").drop("part", "cold")

    @cached_property
    def validation(self) -> DataFrame:
        return self.holdout.filter("part = 'test'").drop("part", "cold")

    @cached_property
    def dev(self) -> DataFrame:
        return self.keep("dev", lambda: self.sample(self.development, **DEV).rows(self.development))

    def _fit_columns(self) -> DataFrame:
        return self.development.drop("ts", "title")

    @cached_property
    def split(self) -> DataFrame:
        return self._split("split", self._fit_columns(), **SPLIT, give_back=False)

    @staticmethod
    def part(split: DataFrame, part: str) -> DataFrame:
        return split.filter(F.col("part") == part).drop("part", "cold")

    @cached_property
    def train(self) -> DataFrame:
        return self.part(self.split, "train")

    @cached_property
    def test(self) -> DataFrame:
        return self.part(self.split, "test")

    # -- models ------------------------------------------------------------

    @cached_property
    def effects(self) -> Effects:
        """Plain and shrunk effects of the train part."""
        return fit(self.train, SETTINGS, self.keep, "effects")

    def aligned_effects(self, key: str) -> Effects:
        """The same effects, fitted on rows that lie apart by one of the keys."""
        buckets = Buckets(key, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return fit_aligned(self.train, SETTINGS, self.keep, f"aligned_{key}", buckets)

    @cached_property
    def final_effects(self) -> Effects:
        """Shrunk effects of everything outside the holdout."""
        return fit(self.development, {"shrunk": PENALTIES}, self.keep, "final")

    def scores(self, *models: Model) -> DataFrame:
        return score(self.test, self.effects, models)

    def predictions(self) -> DataFrame:
        return predict(self.validation, self.final_effects, FINAL)

    @cached_property
    def _seen_in_dev(self) -> DataFrame:
        def build() -> DataFrame:
            split = self._split("dev_split", self.dev, **SPLIT, give_back=False)
            train = self.part(split, "train")
            return seen_only(self.validation, train, COLD_KEYS, self.keep, "dev_seen")

        of = [self.dev, self.validation, SPLIT]
        seen = self.keep("seen_in_dev", build, of=of)
        self.store.drop("dev_split_flagged", "dev_split_sampled")
        self.store.drop(*(f"dev_seen_{key}" for key in COLD_KEYS))
        return seen

    def seen_in_dev(self) -> DataFrame:
        """The holdout without keys the dev train part has not seen."""
        return self._seen_in_dev

    def final_score(self, seen_in: str = "fitting table") -> DataFrame:
        """The final model on the holdout.

        ``seen_in`` says which table's keys the holdout is limited to: the
        fitting table, which by construction has them all, or the much smaller
        "dev train" part, as in the published score.
        """
        if seen_in == "fitting table":
            rows = self.validation
        elif seen_in == "dev train":
            rows = self.seen_in_dev()
        else:
            raise ValueError("seen_in must be 'fitting table' or 'dev train'")
        return score(rows, self.final_effects, [FINAL])

    def final_test_score(self) -> DataFrame:
        """The final penalties refitted on 80 % of development, scored on the rest."""

        def build() -> DataFrame:
            split = self._split(
                "final_split", self._fit_columns(), **FINAL_SPLIT, give_back=False
            )
            train, test = self.part(split, "train"), self.part(split, "test")
            effects = fit(train, {"shrunk": PENALTIES}, self.keep, "final_test")
            return score(test, effects, [Model("final on test", 3, "shrunk")])

        of = [self._fit_columns(), FINAL_SPLIT, PENALTIES]
        scored = self.keep("final_test_score", build, of=of)
        self.store.drop("final_split_flagged", "final_split_sampled")
        self.store.drop(*(f"final_test_{level}" for level in LEVELS))
        return scored

    def close(self) -> None:
        """Delete all prepared tables; the pipeline can't be used after that."""
        self.store.close()

    def ladder(self) -> DataFrame:
        return self.scores(*LADDER).unionByName(self.final_score())

    def curve(self, level: str) -> DataFrame:
        """Tuning curve of one level, published penalties before it."""
        depth = LEVELS.index(level)
        return tuning_curve(self.effects, self.test, depth, "shrunk", GRIDS[depth])

    def best_penalties(self) -> DataFrame:
        return tune(self.effects, self.train, self.test, GRIDS, self.keep, "tuned")

    def joint_curve(self) -> DataFrame:
        """The error of every combination of the joint grid's penalties."""
        return joint_curve(self.effects, self.train, self.test, JOINT, self.keep, "joint")


def input_marks(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """A mark of each input's files; the only listing of them that a pipeline needs."""
    paths = [f"{sf_dir}/{name}.parquet" for name in INPUTS]
    return {path: version(spark, path) for path in paths}


_pipelines: dict[str, Pipeline] = {}
_lock = threading.Lock()


def pipeline(spark: SparkSession, sf_dir: str, rater: str = "customer") -> Pipeline:
    """The application's pipeline over a folder, a new one when its files change."""
    sf_dir = sf_dir.rstrip("/")
    marks = input_marks(spark, sf_dir)
    folder = hashlib.md5("|".join(marks.values()).encode()).hexdigest()[:12]
    key = f"{spark.sparkContext.applicationId}/{folder}/{rater}"
    with _lock:
        if key not in _pipelines:
            _pipelines[key] = Pipeline(spark, sf_dir, rater, folder, marks)
        return _pipelines[key]
