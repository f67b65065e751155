"""Text files to final score, against the same steps in plain Python."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from biasloom.operators.effects import fit
from biasloom.operators.joins import attach
from biasloom.operators.sampling import holdout_split, stratified_sample
from biasloom.operators.scoring import Model, score
from biasloom.sources import read_items, read_ratings

LAMS = (2.2, 5.3, 1.7)


def plain_python(train, test, lams):
    """RMSE of the three-level model, group by group in dictionaries."""
    mu = math.fsum(r["rating"] for r in train) / len(train)
    effects = []
    for level, lam in zip(("item_id", "user_id", "genres"), lams):
        rest = defaultdict(list)
        for r in train:
            known = sum(b[r[k]] for k, b in effects)
            rest[r[level]].append(r["rating"] - mu - known)
        effects.append(
            (level, {k: math.fsum(v) / (len(v) + lam) for k, v in rest.items()})
        )
    errors = [r["rating"] - mu - sum(b[r[k]] for k, b in effects) for r in test]
    return math.sqrt(math.fsum(e * e for e in errors) / len(errors))


@pytest.mark.parametrize("give_back", [True, False])
def test_files_to_score(spark, keep, tmp_path, give_back):
    rng = random.Random(11)
    pairs = rng.sample([(u, i) for u in range(60) for i in range(40)], 500)
    pairs += [(1000 + n, n % 40) for n in range(50)]  # raters of a single item
    lines = [f"{u}::{i}::{rng.randrange(1, 11) / 2}::{n}" for n, (u, i) in enumerate(pairs)]
    (tmp_path / "ratings.dat").write_text("\n".join(lines))
    items = [f"{i}::Title {i}::{'AB'[i % 2]}|{'XYZ'[i % 3]}" for i in range(39)]
    (tmp_path / "items.dat").write_text("\n".join(items))  # item 39 has no entry

    ratings = attach(
        read_ratings(spark, str(tmp_path / "ratings.dat")),
        read_items(spark, str(tmp_path / "items.dat")),
        "item_id",
    )
    sample = stratified_sample(ratings, "rating", 0.2, 7, ["user_id", "item_id"])
    split = keep(
        "split",
        lambda: holdout_split(
            ratings, sample, ["item_id", "user_id"], keep, "s", give_back
        ),
        partition_by=["part"],
    )
    train, test = (split.filter(f"part = '{p}'") for p in ("train", "test"))
    cold = split.filter("cold").count()
    assert (cold > 0) == give_back
    effects = fit(train, {"plain": (0, 0, 0), "shrunk": LAMS}, keep, "fit")
    models = [Model("plain", 3, "plain"), Model("shrunk", 3, "shrunk")]
    ours = {r["model"]: r["rmse"] for r in score(test, effects, models).collect()}
    a, b = train.collect(), test.collect()
    assert ours["plain"] == pytest.approx(plain_python(a, b, (0, 0, 0)), abs=1e-12)
    assert ours["shrunk"] == pytest.approx(plain_python(a, b, LAMS), abs=1e-12)
