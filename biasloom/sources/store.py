"""Prepared tables: written once to shared storage, then read by every job.

A prepared table cuts the lineage (a lost executor costs a re-read, never a
re-fit) and gives Catalyst real file sizes, so that a join against it is
broadcast only below ``spark.sql.autoBroadcastJoinThreshold`` and is a
sort-merge join, split by AQE where skewed, above it.

A table's folder is named by what it is made of: the plan that describes it,
with its parameters, and the paths, lengths and times of the files it reads. A
name may so be used again for another table, a changed input gives a new table,
and a later application over the same input finds the tables of an earlier one.
A prepared table is known by its folder, and an input folder that its reader has
taken a mark of by that mark, so files are listed once, not for every table.

Each attempt at a table is written to a folder of its own and stays there. A
small pointer file, created by one writer only, says which attempt is the table:
nothing is moved, which an object store would do by copying.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA = "_schema"
#: Names the attempt that is the table.
POINTER = "_table"
ATTEMPT = re.compile(r"attempt-[0-9a-f]{32}")
#: Files of a folder that are listed on the driver; more, by Spark.
LISTED = 1000
#: Values of a partition column up to which a task writes their files side by side;
#: beyond that it sorts its rows by the value first.
WRITERS = 4
#: Leaves of a plan without files whose printed form says all about them.
TOLD = ("Range", "OneRowRelation")

#: Attempts this process has read or written, and the tables they are.
_prepared: dict[str, str] = {}
_scratch: dict[str, str] = {}
_scratch_lock = threading.Lock()


def named_root(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names, if it is set."""
    context = spark.sparkContext
    named = (
        context.getConf().get("spark.checkpoint.dir")
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    return named.rstrip("/") if named else None


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one; it gets a scratch folder, which
    goes with the session.
    """
    context = spark.sparkContext
    named = named_root(spark)
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    with _scratch_lock:
        if context.applicationId not in _scratch:
            folder = tempfile.mkdtemp(prefix="biasloom-")
            files, path = _locate(spark, folder)
            files.deleteOnExit(path)
            _scratch[context.applicationId] = folder
        return _scratch[context.applicationId]


def _locate(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(*parts)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _plain(spark: SparkSession, path: str) -> str:
    """A path without its scheme."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def _digest(marks: Iterable[str]) -> str:
    return hashlib.md5("\n".join(marks).encode()).hexdigest()


def _mark(status) -> str:
    return f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}"


def version(spark: SparkSession, path: str) -> str:
    """A mark that changes when the file at path, or any file below it, does.

    A folder of many files is listed and digested by Spark.
    """
    files, location = _locate(spark, path)
    if files.getFileStatus(location).isFile():
        return _mark(files.getFileStatus(location))
    found, marks = files.listFiles(location, True), []
    while found.hasNext() and len(marks) <= LISTED:
        marks.append(_mark(found.next()))
    if len(marks) <= LISTED:
        return f"{path}:{_digest(sorted(marks))}"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    hashed = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    total = listed.agg(
        F.count(F.lit(1)), F.sum("length"), F.sum(hashed.cast("decimal(38,0)"))
    ).first()
    return f"{path}:{_digest(map(str, total))}"


def _roots(leaf) -> list[str] | None:
    """The paths a leaf of a plan was asked to read; None if it reads no files."""
    if leaf.getClass().getSimpleName() != "LogicalRelation":
        return None
    try:
        found = leaf.relation().location().rootPaths()
    except (Py4JError, Py4JJavaError):
        return None
    return [found.apply(i).toString() for i in range(found.size())]


def identity(df: DataFrame, known: Mapping[str, str] | None = None) -> str:
    """What a DataFrame is made of: its plan with all values, and its files.

    ``known`` has marks of inputs by their path; prepared tables are known too, and
    only other paths are looked at. Data that comes from no file is known within
    its application only.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    limit = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(1 << 20))
    try:
        marks = [plan.canonicalized().toString()]
    finally:
        spark.conf.set(limit, before)
    inputs = {_plain(spark, path): mark for path, mark in (known or {}).items()}
    told, seen = True, {}
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        roots = _roots(leaf)
        if roots is None:
            told = told and leaf.getClass().getSimpleName() in TOLD
            continue
        for root in roots:
            plain = _plain(spark, root)
            if plain not in seen:
                seen[plain] = _prepared.get(plain) or inputs.get(plain) or version(spark, root)
            marks.append(seen[plain])
    if not told:
        marks += [spark.sparkContext.applicationId, str(df.semanticHash())]
    return _digest(marks)


def _text(files, path) -> str:
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _put(files, path, text: str, replace: bool) -> None:
    stream = files.create(path, replace)
    stream.write(bytearray(text.encode()))
    stream.close()


def published(spark: SparkSession, path: str) -> str | None:
    """The folder with the rows of the table at path; None if there is no table.

    A pointer that was cut short names no attempt and counts as none.
    """
    files, pointer = _locate(spark, path, POINTER)
    if not files.exists(pointer):
        return None
    name = _text(files, pointer)
    return f"{path}/{name}" if ATTEMPT.fullmatch(name) else None


def is_complete(spark: SparkSession, path: str) -> bool:
    return published(spark, path) is not None


@dataclass(frozen=True)
class Buckets:
    """Rows lie apart by a hash of ``key``, so joins and groups on it need no shuffle."""

    key: str
    count: int


def _bucketed(spark: SparkSession, path: str, schema: StructType, buckets: Buckets) -> DataFrame:
    """The files at path as a table of this session's catalog that knows its buckets."""
    name = f"biasloom_{_digest([path])}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{buckets.key}`) "
        f"SORTED BY (`{buckets.key}`) INTO {buckets.count} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _save(
    df: DataFrame, path: str, partition_by: Sequence[str], fmt: str, buckets: Buckets | None
) -> None:
    if buckets is None:
        writers = "spark.sql.maxConcurrentOutputFileWriters"
        before = df.sparkSession.conf.get(writers)
        if partition_by and int(before) < WRITERS:
            df.sparkSession.conf.set(writers, WRITERS)
        try:
            df.write.format(fmt).partitionBy(*partition_by).save(path)
        finally:
            df.sparkSession.conf.set(writers, before)
        return
    # Only a table's writer lays out buckets; the files stay when the table goes.
    name = f"biasloom_{_digest([path])}"
    apart = df.repartition(buckets.count, buckets.key)
    writer = apart.write.format("parquet").option("path", path)
    writer.bucketBy(buckets.count, buckets.key).sortBy(buckets.key).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def _write(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    fmt: str,
    buckets: Buckets | None = None,
) -> str:
    """Write an attempt and publish it; the attempt that is the table in the end.

    Of several writers the first to create the pointer wins, and the others take
    its attempt for theirs.
    """
    spark, name = df.sparkSession, f"attempt-{uuid.uuid4().hex}"
    attempt = f"{path}/{name}"
    _save(df, attempt, partition_by, fmt, buckets)
    files, note = _locate(spark, attempt, SCHEMA)
    _put(files, note, df.schema.json(), True)
    _, pointer = _locate(spark, path, POINTER)
    torn = files.exists(pointer) and published(spark, path) is None
    try:
        _put(files, pointer, name, torn)
    except Py4JJavaError:
        if published(spark, path) is None:
            raise
    chosen = published(spark, path)
    if chosen != attempt:
        files.delete(_locate(spark, attempt)[1], True)
    return chosen


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    buckets: Buckets | None = None,
) -> DataFrame:
    """Read the table at path; build and write it first if it is not there."""
    found = published(spark, path) or _write(build(), path, partition_by, fmt, buckets)
    _prepared[_plain(spark, found)] = f"{path}@{found.rsplit('/', 1)[1]}"
    files, note = _locate(spark, found, SCHEMA)
    schema = StructType.fromJson(json.loads(_text(files, note)))
    if buckets is not None:
        return _bucketed(spark, found, schema, buckets)
    return spark.read.format(fmt).schema(schema).load(found)


class TableStore:
    """Prepared tables under one folder.

    ``known`` has marks of input folders by their path, taken by version(): those
    folders are not listed again for each table that is made of them.
    """

    def __init__(self, spark: SparkSession, name: str, known: Mapping[str, str] | None = None):
        self.spark, self.known = spark, dict(known or {})
        self.root = f"{shared_root(spark)}/biasloom/{name}"
        self._locks: dict[str, threading.Lock] = defaultdict(threading.Lock)

    def path(self, name: str, *of: object) -> str:
        """Where the table of this name lies that is made of these things."""
        marks = [identity(x, self.known) if isinstance(x, DataFrame) else repr(x) for x in of]
        return f"{self.root}/{name}-{_digest(marks)[:16]}"

    def files(self, name: str, *of: object) -> str:
        """The folder that holds the rows of that table, which is there already."""
        found = published(self.spark, self.path(name, *of))
        if found is None:
            raise FileNotFoundError(f"no table {name}")
        return found

    def keep(
        self,
        name: str,
        build: Callable[[], DataFrame],
        partition_by: Sequence[str] = (),
        fmt: str = "parquet",
        of: Sequence[object] | None = None,
        buckets: Buckets | None = None,
    ) -> DataFrame:
        """The table that build describes, written if it is not there yet.

        ``of`` are the DataFrames and values the table is made of; with them,
        build is called only if the table has to be written. Without them, the
        plan that build returns tells.
        """
        if of is None:
            built = build()
            of, build = (built,), lambda: built
        path = self.path(name, *of, *([buckets] if buckets else []))
        with self._locks[path]:
            return load_or_build(self.spark, path, build, partition_by, fmt, buckets)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names; none may be read after that."""
        for name in names:
            files, pattern = _locate(self.spark, f"{self.root}/{name}-*")
            for found in files.globStatus(pattern) or ():
                files.delete(found.getPath(), True)

    def close(self) -> None:
        """Delete all tables of this store."""
        files, root = _locate(self.spark, self.root)
        files.delete(root, True)
