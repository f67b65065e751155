import pathlib

import pytest

from biasloom.llm.common import Scratch, output_folder, row_key
from biasloom.llm.queries import REGISTRY


def test_scratch_keeps_and_drops(spark):
    scratch = Scratch(spark, "test")
    root = pathlib.Path(scratch.root.removeprefix("file:"))
    assert root.is_dir()
    kept = scratch.keep(spark.range(5), "five")
    assert kept.count() == 5 and kept.dtypes == spark.range(5).dtypes
    empty = scratch.keep(spark.range(0), "none")
    assert empty.count() == 0
    scratch.drop("five", "none")
    assert list(root.iterdir()) == []


@pytest.mark.parametrize("name", ["op2_url_filter", "op7_secret_scan"])
def test_native_queries_run_no_python(spark, name):
    df = REGISTRY[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"):
        assert word not in plan


def test_a_named_run_replaces_its_output(spark, tmp_path):
    spark.conf.set("spark.biasloom.output.dir", str(tmp_path))
    try:
        assert output_folder(spark, "a") != output_folder(spark, "a")
        spark.conf.set("spark.biasloom.output.run", "nightly")
        for n in (3, 5):
            folder = output_folder(spark, "a")
            assert folder == f"{tmp_path}/biasloom-output/a-nightly"
            spark.range(n).write.parquet(folder)
        assert spark.read.parquet(folder).count() == 5
    finally:
        spark.conf.unset("spark.biasloom.output.dir")
        spark.conf.unset("spark.biasloom.output.run")


def test_row_keys_tell_nulls_apart(spark):
    rows = [("x", None, ["a", None]), (None, "x", ["a", None]), ("x", None, [None, "a"]), (None, None, None)]
    df = spark.createDataFrame(rows + rows, "a string, b string, c array<string>")
    keys = [r[0] for r in df.select(row_key(df)).collect()]
    assert len(set(keys)) == 4 and keys[:4] == keys[4:] and {len(k) for k in keys} == {32}
