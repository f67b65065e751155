from __future__ import annotations

import pathlib
import uuid

import pytest
from pyspark.sql import DataFrameWriter

from biasloom.operators.effects import effect_table, fit
from biasloom.operators.joins import attach, rows_not_in
from biasloom.operators.tuning import Axis, lam_column, tune
from biasloom.plans import pipeline as pipeline_module
from biasloom.sources import store as store_module
from biasloom.sources import (
    TableStore,
    bind_ratings,
    load_or_build,
    read_items,
    read_ratings,
    shared_root,
    split_ratings,
    version,
)

published = store_module.published

RATINGS = """1::10::5::1000
1::11::3.5::1001
2::10::4::1002
2::12::0.5::1003
3::99::2::1004
"""
ITEMS = """10::Alpha, The "A" (1990)::Drama|Romance
11::Beta (1991)::Comedy
12::Gamma (1992)::Drama|Thriller
13::Delta::Part::Two
14::Epsilon
x::Zeta::Comedy
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "ratings.dat").write_text(RATINGS)
    (tmp_path / "items.dat").write_text(ITEMS)
    return tmp_path


def test_read_ratings(spark, files):
    df = read_ratings(spark, str(files / "ratings.dat"))
    assert df.dtypes == [
        ("user_id", "bigint"),
        ("item_id", "bigint"),
        ("rating", "double"),
        ("ts", "bigint"),
    ]
    rows = sorted(map(tuple, df.collect()))
    assert rows[0] == (1, 10, 5.0, 1000)
    assert rows[-1] == (3, 99, 2.0, 1004)
    assert len(rows) == 5


def test_read_items_has_exactly_three_parts(spark, files):
    df = read_items(spark, str(files / "items.dat"))
    rows = {r["title"]: (r["item_id"], r["genres"]) for r in df.collect()}
    assert rows['Alpha, The "A" (1990)'] == (10, "Drama|Romance")
    assert rows["Delta"] == (13, "Part::Two")
    assert rows["Epsilon"] == (14, "")
    assert rows["Zeta"] == (None, "Comedy")


def test_left_join_keeps_ratings_without_item(spark, files):
    ratings = read_ratings(spark, str(files / "ratings.dat"))
    items = read_items(spark, str(files / "items.dat"))
    joined = attach(ratings, items, "item_id")
    assert joined.count() == 5
    lost = joined.filter("title IS NULL").collect()
    assert [(r["item_id"], r["genres"]) for r in lost] == [(99, None)]


def test_rows_not_in_drops_every_copy_and_matches_missing_values(spark):
    left = spark.createDataFrame(
        [(1, None, 0), (1, None, 0), (2, "b", 1), (3, None, 2)], "a int, b string, c int"
    )
    right = spark.createDataFrame([("b", 2), (None, 1)], "b string, a int")
    rest = rows_not_in(left, right)
    assert rest.columns == ["a", "b", "c"]
    assert [tuple(r) for r in rest.collect()] == [(3, None, 2)]


def test_load_or_build_builds_once_and_again_when_incomplete(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    path = str(tmp_path / "prepared")
    for _ in range(2):
        assert load_or_build(spark, path, build).count() == 3
    assert len(built) == 1
    (tmp_path / "prepared" / "_table").unlink()
    assert load_or_build(spark, path, build).count() == 3
    assert len(built) == 2


def test_bad_lines_are_reported_or_left_out(spark, tmp_path):
    path = tmp_path / "bad.dat"
    path.write_text(RATINGS + "2::11::bad::1001\n3::12\n4::13::3::1002::extra\n")
    with pytest.raises(Exception, match="malformed line"):
        read_ratings(spark, str(path)).collect()
    with pytest.raises(Exception, match="malformed line"):
        read_ratings(spark, str(path)).count()
    assert read_ratings(spark, str(path), mode="DROPMALFORMED").count() == 5
    assert len(read_ratings(spark, str(path), mode="PERMISSIVE").collect()) == 8


@pytest.fixture
def store(spark):
    return TableStore(spark, f"test-{uuid.uuid4().hex}")


TRAIN = [(1, 10, 5.0, "D"), (1, 11, 3.0, "C"), (2, 10, 4.0, "D"), (2, 11, 2.0, "C"), (3, 10, 1.0, "D")]
RATED = "user_id long, item_id long, rating double, genres string"


def effects_of(train, lams, keep):
    made = fit(train, {"a": lams}, keep, "fit", levels=("item_id", "user_id"))
    return sorted(tuple(r) for r in effect_table(made, "user_id", "a", "b").collect())


def test_a_name_used_again_gives_the_right_table(spark, store):
    train = spark.createDataFrame(TRAIN, RATED)
    fresh = TableStore(spark, f"test-{uuid.uuid4().hex}")
    effects_of(train, (0, 0), store.keep)
    assert effects_of(train, (50, 0), store.keep) == effects_of(train, (50, 0), fresh.keep)
    short = spark.createDataFrame(TRAIN[:3], RATED)
    assert [n for _, n, _ in effects_of(short, (0, 0), store.keep)] == [2, 1]


def test_tuning_twice_under_one_name(spark, store):
    train = spark.createDataFrame(TRAIN, RATED)
    model = fit(train, {"a": (0, 0, 0)}, store.keep, "fit")
    rows = [
        tune(model, train, train, axes, store.keep, "tuned").first()[lam_column("item_id")]
        for axes in ([Axis(1.0, 1.0, 0.5)] * 3, [Axis(9.0, 9.0, 0.5)] * 3)
    ]
    assert rows == [1.0, 9.0]


def test_a_replaced_part_file_gives_a_new_table(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).coalesce(1).write.parquet(folder)

    def total():
        rows = spark.read.parquet(folder)
        return store.keep("sum", lambda: rows.selectExpr("sum(id) AS s")).first()["s"]

    before = version(spark, folder)
    assert total() == 10
    part = next((tmp_path / "in").glob("part-*.parquet"))
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "other"))
    new = next((tmp_path / "other").glob("part-*.parquet"))
    part.write_bytes(new.read_bytes())
    for crc in (tmp_path / "in").glob(".part-*.crc"):
        crc.write_bytes(next((tmp_path / "other").glob(".part-*.crc")).read_bytes())
    assert version(spark, folder) != before
    assert total() == 21


def test_a_prepared_table_is_found_again_and_reads_no_input(spark, store, tmp_path, scans):
    folder = str(tmp_path / "in")
    spark.range(50).write.parquet(folder)
    for expected in (50, 50):
        rows, read = scans(spark.read.parquet(folder))
        other = TableStore(spark, store.root.rsplit("/", 1)[1])
        made = other.keep("all", lambda rows=rows: rows, of=[spark.read.parquet(folder)])
        assert made.count() == expected
    assert read() == 0


def test_nothing_is_left_after_close(spark, store):
    root = pathlib.Path(store.root.removeprefix("file:"))
    for name in ("one", "one_more", "two"):
        store.keep(name, lambda: spark.range(3))
    store.drop("one")
    assert sorted(p.name.rsplit("-", 1)[0] for p in root.iterdir()) == ["one_more", "two"]
    store.close()
    assert not root.exists()


def test_an_empty_partitioned_table_keeps_its_columns(spark, store):
    empty = spark.createDataFrame([], "a long, part string")
    for _ in range(2):
        made = store.keep("empty", lambda: empty, partition_by=["part"])
        assert made.columns == ["a", "part"] and made.count() == 0


def test_store_lies_under_the_named_checkpoint_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_root(spark) == named


def test_version_changes_with_the_file(spark, tmp_path):
    file = tmp_path / "t"
    file.write_text("a")
    before = version(spark, str(file))
    assert version(spark, str(file)) == before
    file.write_text("ab")
    assert version(spark, str(file)) != before


def test_unknown_rater_is_refused(spark):
    with pytest.raises(ValueError):
        bind_ratings(spark, "/nowhere", "visitor")


def test_publishing_moves_nothing_and_writers_agree(spark, tmp_path, monkeypatch):
    """A second writer that began earlier takes the first one's table for its own."""
    path = str(tmp_path / "t")

    def slow():
        assert load_or_build(spark, path, lambda: spark.range(3)).count() == 3
        return spark.range(3).repartition(2)

    written = {p.name for p in (tmp_path).glob("t/*")}
    assert not written and load_or_build(spark, path, slow).count() == 3
    names = sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith("."))
    assert len(names) == 2 and names[0] == "_table"
    assert (tmp_path / "t" / "_table").read_text() == names[1]


def test_a_killed_write_leaves_no_table_and_no_harm(spark, tmp_path):
    path = tmp_path / "t"

    def killed():
        # Rows are written, then the writer dies before it publishes them.
        spark.range(5).write.parquet(str(path / f"attempt-{'0' * 32}"))
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        load_or_build(spark, str(path), killed)
    assert published(spark, str(path)) is None
    (path / "_table").write_text("attempt-00")  # a pointer cut short
    for crc in path.glob("._table.crc"):
        crc.unlink()
    assert load_or_build(spark, str(path), lambda: spark.range(3)).count() == 3
    assert load_or_build(spark, str(path), killed).count() == 3


def test_an_old_table_is_readable_while_a_new_one_is_made(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).write.parquet(folder)
    old = store.keep("t", lambda: spark.read.parquet(folder))
    spark.range(5, 8).write.mode("append").parquet(folder)

    def building():
        assert old.count() == 5
        return spark.read.parquet(folder)

    new = store.keep("t", building, of=[spark.read.parquet(folder)])
    assert (old.count(), new.count()) == (5, 8)


def test_inputs_are_listed_once(spark, tmp_path, monkeypatch):
    """A pipeline's tables name their inputs by the marks taken when it began."""
    listed = []
    plain = store_module.version
    monkeypatch.setattr(
        store_module, "version", lambda s, path: listed.append(path) or plain(s, path)
    )
    monkeypatch.setattr(pipeline_module, "version", store_module.version)
    p = pipeline_module.Pipeline(spark, "/root/testdata/sf0.001", store=f"test-{uuid.uuid4().hex}")
    p.ladder().collect()
    p.best_penalties().collect()
    p.close()
    assert sorted(listed) == [
        f"/root/testdata/sf0.001/{name}.parquet" for name in ("lineitem", "orders", "part")
    ]


def test_a_folder_of_many_files_is_digested_by_spark(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    spark.range(40).repartition(12).write.parquet(str(folder))
    (folder / "deep").mkdir()
    small = version(spark, str(folder))
    monkeypatch.setattr(store_module, "LISTED", 3)
    before = version(spark, str(folder))
    assert before == version(spark, str(folder)) != small
    part = next(folder.glob("part-*.parquet"))
    (folder / "deep" / "part-x.parquet").write_bytes(part.read_bytes())
    assert version(spark, str(folder)) != before


def test_bad_lines_are_kept_apart_by_one_read(spark, keep, tmp_path):
    good = RATINGS + "5::::4.0::\n\n"
    bad = {"2::11::bad::1001": "unreadable: rating", "3::12": "2 fields", "x": "1 fields",
           "4::13::3::1002::extra": "5 fields", "a::b::3::1": "unreadable: user_id, item_id"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.dat").write_text(good)
    (tmp_path / "in" / "two.dat").write_text("\n".join(bad) + "\n")
    read = []

    def counting(name, build, **options):
        read.append(build().count())
        return keep(name, build, **options)

    found = split_ratings(spark, str(tmp_path / "in"), counting, "lines")
    assert len(read) == 1
    assert found.rows.count() + found.rejected.count() == read[0] == 11
    assert {r["line"]: r["reason"] for r in found.rejected.collect()} == bad
    assert {r["file"].rsplit("/", 1)[1] for r in found.rejected.collect()} == {"two.dat"}
    assert {r["block"] for r in found.rejected.collect()} == {0}
    plain = read_ratings(spark, str(tmp_path / "in" / "one.dat"))
    assert found.rows.schema == plain.schema
    assert sorted(map(str, found.rows.collect())) == sorted(map(str, plain.collect()))


def test_ratings_of_unknown_items_stay(spark):
    ratings = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "user_id long, item_id long")
    items = spark.createDataFrame([(10, "a")], "item_id long, title string")
    got = attach(ratings, items, "item_id").collect()
    assert {r["user_id"]: r["title"] for r in got} == {1: "a", 2: None, 3: None}


def test_partitioned_tables_are_written_without_a_sort(spark, keep, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before, plain = spark.conf.get(name), DataFrameWriter.save

    def save(self, *args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", save)
    df = spark.range(100).selectExpr("id", "id % 2 = 0 AS even")
    table = keep("apart", lambda: df, partition_by=["even"])
    assert seen == [store_module.WRITERS] and spark.conf.get(name) == before
    assert table.count() == 100 and table.filter("even AND id % 2 = 1").count() == 0
