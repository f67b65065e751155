"""Each stage on a small corpus, held against a plain version of its decisions."""

import random

import pytest

import corpus_pipeline
from biasloom.llm.cube_mix import WEIGHTS
from tests.llm.test_simhash import plain_components, plain_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string"
VOCABULARY = [f"{a}{b}" for a in "ka to mi re su la".split() for b in "ne po ri da".split()]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    rng = random.Random(4)
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, prose(rng, 25)) for i in range(4)] + [(9, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    texts = [prose(rng, rng.randint(30, 200)) for _ in range(60)]
    texts[5] = f"{texts[5]}. {items[0][1]}; {prose(rng, 60)}"
    texts[6] = items[1][1]
    texts += [texts[7], texts[7], texts[8] + " tail", None, "", "12 34"]
    rows = [(i, t, "en", f"s{i % 4}", len(t or ""), "extra") for i, t in enumerate(texts)]
    rows += [(None, prose(rng, 50), None, None, None, None)] * 2 + [rows[3]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return folder, rows, items


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_language_stage(spark, world):
    folder, rows, _ = world
    out = corpus_pipeline.language(spark, documents(spark, folder), folder)
    want = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert out.columns == documents(spark, folder).columns


def test_near_duplicates_stage(spark, world):
    folder, rows, _ = world
    out = corpus_pipeline.near_duplicates(spark, documents(spark, folder), folder)
    groups = plain_components([plain_fingerprint(r[1] or "") for r in rows])
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(groups))
    first = {}
    for row, group in zip(rows, groups, strict=True):
        first.setdefault(group, []).append(row)
    for members in first.values():
        ids = [m[0] for m in members if m[0] is not None]
        assert sum(r in members for r in got) == 1
        if ids:
            assert [r for r in got if r in members][0][0] == min(ids)


def test_benchmark_stage(spark, world):
    folder, rows, items = world
    out = corpus_pipeline.benchmark(spark, documents(spark, folder), folder)
    assert out.columns == documents(spark, folder).columns
    got = {r.doc_id: r for r in out.collect()}
    assert 6 not in got
    assert items[0][1] not in got[5].text and got[5].n_chars == len(got[5].text)
    clean = [r for r in rows if r[0] not in (5, 6, None)]
    assert all(tuple(got[r[0]]) == r for r in clean)


def test_mix_stage(spark, world):
    folder, rows, _ = world
    out = corpus_pipeline.mix(spark, documents(spark, folder), folder)
    assert out.columns == documents(spark, folder).columns
    got = [tuple(r) for r in out.collect()]
    assert set(got) <= set(rows)
    assert all(got.count(r) <= 3 * rows.count(r) for r in set(got))
    size = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    taken = sum(len(r[1].split()) for r in got)
    assert taken == pytest.approx(sum(size.values()), rel=0.1)
    assert len(WEIGHTS) == 3


def test_run(spark, world):
    folder, _, _ = world
    out = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert out and out[0].start == 0
    for a, b in zip(out, out[1:], strict=False):
        assert b.start == a.start + a.n_tokens


def test_stages_take_an_empty_table(spark, world):
    folder, _, _ = world
    docs = documents(spark, folder).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_rows_that_swap_a_null_are_two_rows(spark, world):
    """A good row is not lost to one with the same values in other columns."""
    folder, rows, _ = world
    text = rows[0][1]
    good = (900, text, None, "s1", 5, None)
    pair = [good, (900, None, text, "s1", 5, None), (901, "12 34", "en", None, None, "s1"),
            (901, "12 34", "en", "s1", None, None)]
    docs = spark.createDataFrame(rows + pair, SCHEMA)
    kept = [tuple(r) for r in corpus_pipeline.language(spark, docs, folder).collect()]
    assert good in kept and not any(r[0] == 901 or (r[0] == 900 and r != good) for r in kept)
    alike = spark.createDataFrame(pair[2:] + [pair[0]], SCHEMA)
    out = corpus_pipeline.near_duplicates(spark, alike, folder).collect()
    assert len(out) == 2 and all(tuple(r) in pair for r in out)
    two = [(1, text, "en", None, 3, "x"), (1, text, "en", "x", 3, None)]
    mixed = corpus_pipeline.mix(spark, spark.createDataFrame(two, SCHEMA), folder).collect()
    assert {tuple(r) for r in mixed} <= set(two)


def test_short_items_are_cut(spark, world, tmp_path):
    _, rows, _ = world
    folder = str(tmp_path)
    spark.createDataFrame([(1, "zig zag zug")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    docs = spark.createDataFrame([(1, f"{rows[0][1]} Zig, zag zug {rows[1][1]}", "en", "s", 1, "")], SCHEMA)
    (out,) = corpus_pipeline.benchmark(spark, docs, folder).collect()
    assert out.text == f"{rows[0][1]}  {rows[1][1]}" and out.n_chars == len(out.text)


def test_decontamination_runs_one_python_step_at_a_time(spark, tmp_path):
    """Each Python step of a task has a worker of its own, which counts as memory."""
    passage = " ".join(f"w{i}" for i in range(10))
    items = spark.createDataFrame([("i", passage)], "item_id string, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"{'a b c ' * 10}{passage} d"), (2, "e f"), (3, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = corpus_pipeline.benchmark(spark, docs, str(tmp_path))
    leaves = clean._jdf.queryExecution().executedPlan().toString()
    assert leaves.count("MapInArrow") == 1
    left = {r.doc_id: r.text.split() for r in clean.collect()}
    assert left == {1: ["a", "b", "c"] * 10 + ["d"], 2: ["e", "f"]}
