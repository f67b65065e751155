import math

import numpy as np
import pytest

from biasloom.llm import url_filter
from biasloom.llm.common import Scratch
from biasloom.llm.url_filter import (
    ORDER, RULES, VERDICTS, address, calibrated, judge, ruled, scored, train,
)


def plain_address(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for stop in "?#":
        rest = rest.split(stop, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if c < "\x80" else c for c in host), slash + path


def plain_rule(host, path):
    best = None
    for verdict, rule in RULES:
        domain, prefix = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


URLS = [
    None, "", "no address", "http://A.COM", "http://A.com/x?y#z", "https://example.com/en/1",
    "http://m.example.com/en/", "http://www.example.com/en/5", "http://a.www.example.com/en/5",
    "http://xexample.com/en/", "ftp://ÄB.net/es/1", "http://net/fr/", "http://a.net/fr", "://com/",
    "http://a.net?x=/es/", "http://a.org/en/1://b.com/", "http://u:p@b.com:80/", "http:///p",
]


def test_address_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = address(df.url)
    rows = df.select("url", host.alias("h"), path.alias("p"))
    for row in rows.withColumn("r", ruled(rows.h, rows.p)).collect():
        assert (row.h, row.p) == plain_address(row.url), row.url
        want = plain_rule(row.h, row.p)
        assert (row.r and tuple(row.r)) == want, row.url


@pytest.fixture(scope="module")
def pages(spark):
    rng = np.random.default_rng(0)
    rows = [(i, u, "x") for i, u in enumerate(URLS)]
    for i in range(100, 1100):
        kind = i % 4
        if kind < 2:
            url = f"https://{'news' if kind else 'blog'}{rng.integers(9)}.com/story/{rng.integers(999)}"
        else:
            url = f"http://casino{rng.integers(9)}.net/{'es' if i % 3 else 'fr'}/win-{rng.integers(999)}"
        rows.append((i, url, "x"))
    for i in range(2000, 2040):
        url = f"https://news{i}.org/story/{i}" if i % 2 else f"http://casino{i}.org/win-{i}"
        rows.append((i, url, "x"))
    rows += [(None, rows[-1][1], "x"), rows[-1]]
    return rows, spark.createDataFrame(rows, "page_id long, url string, rule string")


def test_judge(spark, pages):
    rows, df = pages
    got = judge(df, Scratch(spark, "test")).collect()
    assert len(got) == len(rows)
    for row in got:
        want = plain_rule(row.host, row.path)
        assert row.rule == (want and want[1])
        if want:
            assert row.verdict == want[0]
        assert row.verdict in ("allow", "block")
    by = {r.page_id: r.verdict for r in got}
    right = sum(by[i] == ("allow" if i % 2 else "block") for i in range(2000, 2040))
    assert right >= 38
    assert by[None] == by[2039]


def test_no_python_and_reruns_agree(spark, pages):
    _, df = pages
    first = judge(df, Scratch(spark, "test"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "NestedLoop", "Cartesian"):
        assert word not in plan
    again = judge(df.repartition(5), Scratch(spark, "test"))
    one, two = (
        {(r.page_id, r.host, r.verdict) for r in x.collect()} for x in (first, again)
    )
    assert one == two


def test_empty_and_unlabelled(spark):
    schema = "page_id long, url string"
    assert judge(spark.createDataFrame([], schema), Scratch(spark, "test")).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/"), (2, None)], schema)
    assert judge(one, Scratch(spark, "test")).count() == 2


def test_training_reads_whole_addresses_and_keeps_all_runs(spark):
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 5000)]
    rows = [(f"http://a.com/{'x' * 250}tail", "allow")]
    rows += [(f"http://a.net/{''.join(rng.choice(letters, 100))}", "block") for _ in range(500)]
    df = spark.createDataFrame(rows, "url string, verdict string")
    last = train(df, Scratch(spark, "test"))[ORDER].collect()
    want, contexts = {}, {}
    for url, verdict in rows:
        framed = f"\u0002{url}\u0003"
        for i in range(len(framed) - ORDER):
            run = framed[i : i + ORDER + 1]
            want.setdefault(run, {"allow": 0, "block": 0})[verdict] += 1
            contexts.setdefault(run[:ORDER], {"allow": 0, "block": 0})[verdict] += 1
    assert len(want) > 40_000 and "xtail" in want
    assert {r.run: {"allow": r.allow, "block": r.block} for r in last} == want
    for r in last:
        assert {"allow": r.allow_all, "block": r.block_all} == contexts[r.run[:ORDER]]


def plain_difference(url, train_rows):
    """Mean log-likelihood difference, character by character, from raw counts."""
    def likelihood(verdict):
        seen, every = {}, {}
        for text, label in train_rows:
            if label != verdict:
                continue
            framed = f"\u0002{text.lower()}\u0003"
            for i in range(1, len(framed)):
                for k in range(min(ORDER, i) + 1):
                    run = framed[i - k : i + 1]
                    seen[run] = seen.get(run, 0) + 1
                    every[k, run[:k]] = every.get((k, run[:k]), 0) + 1
        framed, total = f"\u0002{url.lower()}\u0003", []
        for i in range(1, len(framed)):
            chance = 1 / url_filter.CHARACTERS
            for k in range(ORDER + 1):
                run = framed[i - k : i + 1] if i >= k else None
                n = seen.get(run, 0) if run else 0
                of = every.get((k, run[:k]), 0) if run else 0
                chance = (n + url_filter.BACKOFF * chance) / (of + url_filter.BACKOFF)
            total.append(math.log(chance))
        return total

    pairs = zip(likelihood("allow"), likelihood("block"), strict=True)
    differences = [a - b for a, b in pairs]
    return sum(differences) / len(differences)


def test_scores_equal_a_plain_model(spark):
    rng = np.random.default_rng(6)
    parts = ["news", "casino", "/a", "/win", "-7", "é", ".com", "", "X", "漢"]
    rows = [
        ("".join(rng.choice(parts, rng.integers(0, 7))), "allow" if rng.random() < 0.5 else "block")
        for _ in range(60)
    ]
    rows = list(dict(rows).items())
    df = spark.createDataFrame(rows, "url string, verdict string")
    orders = train(df, Scratch(spark, "test"))
    asked = ["", "news.com/a", "casino/win-7", "zzz 漢字", rows[0][0], "x" * 3000]
    keyed = spark.createDataFrame([(u, u) for u in asked], "key string, url string")
    got = {r.key: r.difference for r in scored(keyed, orders).collect()}
    for url in asked:
        assert got[url] == pytest.approx(plain_difference(url, rows), abs=1e-9), url


def test_threshold_has_the_least_sum_of_error_rates(spark):
    rng = np.random.default_rng(7)
    rows = [(float(rng.normal(0.4, 0.5)), "allow") for _ in range(200)]
    rows += [(float(rng.normal(-0.3, 0.6)), "block") for _ in range(80)] + [(9.0, "allow"), (-9.0, "block")]
    df = spark.createDataFrame(rows, "difference double, verdict string")

    def errors(threshold):
        missed = sum(d < threshold for d, v in rows if v == "allow") / 201
        return missed + sum(d >= threshold for d, v in rows if v == "block") / 81

    best = min(errors(-4 + 8 * k / url_filter.BINS) for k in range(url_filter.BINS + 1))
    assert errors(calibrated(df)) <= best + 0.02
    assert calibrated(df.filter("verdict = 'allow'")) == 0.0 == calibrated(df.limit(0))


def test_folds_are_scored_by_the_counts_of_the_others(spark):
    rng = np.random.default_rng(8)
    parts = ["news", "casino", "/a", "/win", "-7", "é", ".com", "X"]
    urls = sorted({"".join(rng.choice(parts, rng.integers(1, 7))) for _ in range(50)})
    rows = [
        (u, ("allow", "block")[rng.integers(2)], int(rng.integers(url_filter.FOLDS))) for u in urls
    ]
    df = spark.createDataFrame(rows, "url string, verdict string, fold int")
    orders = train(df, Scratch(spark, "test"))
    keyed = df.withColumn("key", df.url)
    got = {r.key: r.difference for r in scored(keyed, orders).collect()}
    whole = {r.key: r.difference for r in scored(keyed.drop("fold"), orders).collect()}
    for url, _, fold in rows[::5]:
        others = [(u, v) for u, v, f in rows if f != fold]
        assert got[url] == pytest.approx(plain_difference(url, others), abs=1e-9), url
        everything = [(u, v) for u, v, _ in rows]
        assert whole[url] == pytest.approx(plain_difference(url, everything), abs=1e-9), url


def test_models_and_threshold_count_every_labelled_address(spark, monkeypatch, pages):
    rows, df = pages
    labelled = {u for _, u, _ in rows if plain_rule(*plain_address(u))}
    trained, calibrating = [], []
    plain_train, plain_calibrated = train, calibrated

    def spy_train(labelled, scratch):
        trained.extend(r.url for r in labelled.collect())
        return plain_train(labelled, scratch)

    def spy_calibrated(scores):
        calibrating.extend(r.key for r in scores.collect())
        return plain_calibrated(scores)

    monkeypatch.setattr(url_filter, "train", spy_train)
    monkeypatch.setattr(url_filter, "calibrated", spy_calibrated)
    judge(df, Scratch(spark, "test"))
    assert sorted(trained) == sorted(labelled) == sorted(calibrating)


def joins_over_characters(df):
    """The joins that the rows of single characters go through."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    (at,) = (i for i, line in enumerate(lines) if "Generate explode" in line)
    above, level = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            level = depth[i]
            above.append(lines[i].lstrip(" :+-"))
    return [line for line in above if line.startswith("Join")]


def test_a_character_meets_one_table(spark):
    rows = [("http://a.com/x", "allow", 0), ("http://a.net/es/", "block", 1)]
    df = spark.createDataFrame(rows, "url string, verdict string, fold int")
    orders = train(df, Scratch(spark, "test"))
    for urls in (df.withColumn("key", df.url), df.select("url", df.url.alias("key"))):
        assert len(joins_over_characters(scored(urls, orders))) == 1


def test_addresses_of_any_kind_are_scored_at_once(spark):
    """A null fold leaves no counts out; rows with one beside it are scored as alone."""
    rng = np.random.default_rng(9)
    parts = ["news", "casino", "/a", "\u0002", "\u0003b", "é", "X", "漢"]
    urls = sorted({"".join(rng.choice(parts, rng.integers(1, 6))) for _ in range(30)})
    rows = [(u, VERDICTS[i % 2], i % url_filter.FOLDS) for i, u in enumerate(urls)]
    orders = train(
        spark.createDataFrame(rows, "url string, verdict string, fold int"), Scratch(spark, "test")
    )
    asked = [(u, u, f) for u, _, f in rows[:6]] + [("all " + u, u, None) for u, _, _ in rows[:6]]
    asked += [("new", "unseen/漢x", None)]
    got = scored(spark.createDataFrame(asked, "key string, url string, fold int"), orders).collect()
    got = {r.key: r.difference for r in got}
    assert len(got) == len(asked)
    for key, url, fold in asked:
        known = [(u, v) for u, v, f in rows if f != fold]
        assert got[key] == pytest.approx(plain_difference(url, known), abs=1e-9), key


def test_no_side_is_broadcast_for_its_small_files(spark, monkeypatch, pages):
    """Characters, runs and addresses are far more than their compressed files say."""
    _, df = pages
    plans = []
    plain_keep, plain_calibrated = Scratch.keep, calibrated

    def noted(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())

    def spy_keep(self, rows, *args):
        noted(rows)
        return plain_keep(self, rows, *args)

    def spy_calibrated(scores):
        noted(scores)
        return plain_calibrated(scores)

    monkeypatch.setattr(Scratch, "keep", spy_keep)
    monkeypatch.setattr(url_filter, "calibrated", spy_calibrated)
    judge(df, Scratch(spark, "test"))
    joins = "\n".join(plans).count("SortMergeJoin")
    # Counts of a run, of its context and the shorter run's chances; those of a character; its address.
    assert joins == 3 * (ORDER + 1) - 1 + 1 + 1
    assert not [plan for plan in plans if "Broadcast" in plan]
