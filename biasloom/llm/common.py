"""What the operators share: inputs, written stages, batches of bounded bytes."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biasloom.sources.store import named_root, shared_root

#: Bytes and rows of one Arrow batch that goes to a Python task.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound what one Python task holds, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def _located(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def output_folder(spark: SparkSession, name: str) -> str:
    """A folder for files that stay after the session.

    It is below ``spark.biasloom.output.dir``, else the folder all executors
    share, else (a local session) the warehouse. Each call makes a new one, unless
    ``spark.biasloom.output.run`` names the run: the folder of that name is replaced.
    """
    root = spark.conf.get("spark.biasloom.output.dir", None) or named_root(spark)
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    run = spark.conf.get("spark.biasloom.output.run", None)
    folder = f"{root.rstrip('/')}/biasloom-output/{name}-{run or uuid.uuid4().hex}"
    if run:
        files, path = _located(spark, folder)
        files.delete(path, True)
    return folder


class Scratch:
    """Stages written as Parquet to the shared folder, removed with the session.

    A written stage cuts the lineage: a lost executor costs a re-read only.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/biasloom-llm/{name}-{uuid.uuid4().hex}"
        files, path = _located(spark, self.root)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def keep(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle(self) -> None:
        """Have Spark delete the shuffle files of finished stages now.

        It deletes them when the driver's garbage collector finds that nobody
        can ask for them any more, which an idle driver may put off for long.
        The JVM lets go of what Python has dropped a moment later, hence twice.
        """
        for _ in range(2):
            gc.collect()
            time.sleep(0.5)
            self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for name in names:
            files, path = _located(self.spark, f"{self.root}/{name}")
            files.delete(path, True)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, which gives its memory back to the system at the end of a task.

    Python workers are kept for later tasks; what one has freed but still holds
    would count against the executor until then.
    """

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """A binary column's values, nothing for a null."""
    for value in column.to_pylist():
        yield value or b""


def row_key(df: DataFrame, *columns: str) -> Column:
    """128 bits, as hex digits, that rows alike in these columns (all, if none are named) share.

    A null is a value of its own: it says at which place it stands, within arrays,
    maps and structs too.
    """
    names = columns or df.columns
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    values = [
        F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"})
        if isinstance(df.schema[c].dataType, nested)
        else F.col(c)
        for c in names
    ]
    nulls = F.concat(*(F.col(c).isNull().cast("int").cast("string") for c in names))
    halves = (F.xxhash64(F.lit(seed), nulls, *values) for seed in (1, 2))
    return F.concat(*(F.lpad(F.hex(half), 16, "0") for half in halves))


def text_bytes(name: str = "text"):
    """A text column as its UTF-8 bytes; null stays null."""
    return F.col(name).cast("string").cast("binary")
