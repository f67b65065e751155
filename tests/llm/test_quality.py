import math
from collections import Counter

import numpy as np

from biasloom.llm.common import Scratch
from biasloom.llm.quality import estimate, judge, measures, repeated_words


def plain_repeats(words):
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(runs)
    return len({i + k for i, r in enumerate(runs) if counts[r] > 1 for k in range(8)})


def test_repeated_words():
    rng = np.random.default_rng(0)
    for n in (0, 7, 8, 9, 30, 200):
        words = [str(w).encode() for w in rng.integers(0, 3, n)]
        assert repeated_words(words) == plain_repeats(words)
        assert repeated_words(words * 2) == plain_repeats(words * 2)


def test_measures():
    text = "Aé b#\n x \n\nAé b#\n x \n x \x0b\n$ \xa0y"
    got = measures(text)
    assert got[:5] == (9, 14, 3, 2, 0)
    assert measures("") == (0,) * 11


def test_estimate_finds_the_good_rules():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.55])
    speaks = rng.random((20_000, 4)) < 0.7
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None])
    votes = np.where(speaks, np.where(votes, 1, -1), 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    weight, prior = estimate(patterns, counts.astype(float))
    assert weight[:3, 2].min() > 1.5 * weight[3, 2]
    assert weight[:3, 0].max() < 1.5 * weight[3, 0]
    odds = prior + weight[np.arange(4), votes + 1].sum(1)
    assert ((odds > 0) == truth).mean() > 0.9


def word(x):
    return "".join("bdfglmnprt"[int(d)] + "aeiou"[int(d) % 5] for d in str(x))


def prose(rng, n):
    return "".join(
        " ".join(word(x) for x in rng.integers(0, 5000, 12)).capitalize() + ".\n"
        for _ in range(n)
    )


def test_judge(spark):
    rng = np.random.default_rng(2)
    rows = [(i, prose(rng, int(rng.integers(4, 20))), "x") for i in range(150)]
    bad = range(1000, 1030)
    rows += [(i, " ".join(f"{x}###" for x in rng.integers(0, 9, 60)), "x") for i in bad]
    loop = prose(rng, 3)
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, loop * 9, "x"), (None, loop * 200, "x")]
    rows += [(2003, "too short", "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, votes string")
    got = judge(df, Scratch(spark, "test")).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    assert kept == set(range(150))
    failed = {r.doc_id for r in got if r.base_failed}
    assert failed >= {2000, 2001, 2002, 2003, None} and not failed & kept
    assert judge(df.limit(0), Scratch(spark, "test")).count() == 0


def plain_posteriors(votes):
    """Expectation maximisation document by document, from the definition."""
    n, rules = len(votes), len(votes[0])

    def tables(good, anchors):
        out = []
        for side in (0, 1):
            chance = [g if side else 1 - g for g in good]
            rows = []
            for k in range(rules):
                row = [0.5 + sum(c for c, v in zip(chance, votes) if v[k] == x) for x in (-1, 0, 1)]
                if anchors:
                    row = [r + 0.02 * sum(chance) * a for r, a in zip(row, anchors[side][k])]
                rows.append([r / sum(row) for r in row])
            out.append(rows)
        return out

    good = [0.05 if -1 in v else 0.95 for v in votes]
    now = anchors = tables(good, None)
    share = (sum(good) + 1) / (n + 2)
    for _ in range(200):
        before = good
        good = []
        for v in votes:
            odds = math.log(share / (1 - share))
            odds += sum(math.log(now[1][k][x + 1] / now[0][k][x + 1]) for k, x in enumerate(v))
            good.append(1 / (1 + math.exp(-odds)))
        if max(abs(a - b) for a, b in zip(good, before)) < 1e-9:
            break
        share = (sum(good) + 1) / (n + 2)
        now = tables(good, anchors)
    out = []
    for v in votes:
        odds = math.log(share / (1 - share))
        for k, x in enumerate(v):
            weight = math.log(now[1][k][x + 1] / now[0][k][x + 1])
            odds += max(weight, 0) if x == 1 else min(weight, 0) if x == -1 else 0
        out.append(1 / (1 + math.exp(-odds)))
    return out


def test_posteriors_equal_a_plain_estimation(spark):
    rng = np.random.default_rng(5)
    words = ["the", "and", "of", "story", "told", "Here.", "$$", "AB", "1", "x#"]
    texts = [
        "\n".join(" ".join(rng.choice(words[: rng.integers(3, 11)], rng.integers(3, 40))) for _ in range(4))
        for _ in range(150)
    ]
    texts += [None, "", texts[0], texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = judge(df.repartition(3), Scratch(spark, "test")).orderBy("doc_id").collect()
    assert len({tuple(r.votes) for r in rows}) > 10
    for row, want in zip(rows, plain_posteriors([r.votes for r in rows]), strict=True):
        assert abs(row.posterior - want) < 1e-6
        assert row.kept == (not row.base_failed and row.posterior >= 0.5)
