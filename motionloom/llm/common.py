"""What the training-data operators share: tables, and work on Arrow batches."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.operators.ranks import free_name
from motionloom.shared import Scratch, cut, fresh_dir, release, shared_dir  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings within; afterwards it has its own again, so what is to run with them must run within."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20):
    """Within, rows that hold whole texts or sets of hashes go to Python in batches of at most so many rows and about so many bytes
    (a longer row stays whole), which bounds the memory of both sides; smaller bounds of the session stay."""
    values = {}
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = int(spark.conf.get(name, None) or 0)
        values[name] = str(now if 0 < now <= most else most)
    return settings(spark, values)


#: Tables that a Python worker keeps from task to task, as it may serve their operator again.
kept: dict = {}


def drop_kept() -> None:
    kept.clear()


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def shrink_heaps(spark: SparkSession) -> None:
    """The executors collect their garbage and give free heap back to the system, a task for each core.

    A heap that has once grown stays as large until a full collection, beside the memory of Python workers."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.reflect(F.lit("java.lang.System"), F.lit("gc")).alias("done")).where("done <> ''").count()


def lean(run: Callable) -> Callable:
    """run, for mapInArrow, in a worker that first drops what other operators left in it, and in the end gives back what it freed.

    An executor has several workers for each core, which live on and take turns: else each keeps the peak of all tasks it served."""

    def inner(batches):
        drop_kept()
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def lean_groups(run: Callable) -> Callable:
    """As lean, for applyInArrow with a key."""

    def inner(key, got):
        drop_kept()
        try:
            return run(key, got)
        finally:
            give_back()

    return inner


def apart(*keys: Column) -> Column:
    """A join key with the same equality as keys but another partitioning.

    Where one side of a join comes out of an aggregation by the same keys, Spark keeps that partitioning and shuffles only
    the other side, and then adaptive execution can't split a hot key. Joined on apart(), both sides are shuffled for the
    join, and it can."""
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])


#: Beyond so many files, numbered() keeps a numbered copy of the rows instead of broadcasting the files' names.
MOST_FILES = 100_000


def _rows_of_files(docs: DataFrame) -> bool:
    """Whether each row is a row of a file, at most once: one file scan below nothing but projections and filters."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.nodeName() == "LogicalRelation"


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number of each row that stays the same wherever it is read, and the name of that column, unlike all others.

    Rows of a file scan are numbered by file and place in it. Of other tables (joined, exploded, made), and beyond MOST_FILES
    files, a numbered copy is kept."""
    from pyspark.errors import AnalysisException

    node, file, row, name, first = (free_name(docs.columns, n) for n in ("node", "file", "row", "file_name", "file_first"))
    placed = None
    if _rows_of_files(docs):
        try:
            placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
        except AnalysisException:
            pass
    if placed is not None:
        files = placed.select(file).distinct().limit(MOST_FILES + 1).toArrow().column(0).to_pylist()
        if len(files) <= MOST_FILES and None not in files:
            number = docs.sparkSession.createDataFrame([(f, k << 40) for k, f in enumerate(sorted(files))], f"`{name}` string, `{first}` bigint")
            found = placed.join(F.broadcast(number), F.col(f"`{file}`") == F.col(f"`{name}`"))
            return found.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(f"`{first}`") + F.col(f"`{row}`")).alias(node)), node
    return cut(docs.withColumn(node, F.monotonically_increasing_id())), node


def keep_one(rows: DataFrame, number: str, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """numbered rows without all but one of each group. members: node, grp, at most one row for each node.

    The smallest id stays, a null id only if there is no other; of equal ids the smallest hash of the text, then of equal
    texts the smallest number. The choice is an aggregate with a map side; the anti-join carries numbers only."""
    members = cut(members)  # read three times below
    own = F.col(f"`{number}`")
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("n"), F.col(f"`{id_col}`").alias("i"), F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256).alias("s"), own.alias("k"))
    placed = rows.select(own.alias("k"), order.alias("o")).join(members.hint("merge"), F.col("k") == F.col("node"))
    best = placed.groupBy("grp").agg(F.min("o").alias("o")).select(F.col("o.k").alias("best"))
    lost = free_name(rows.columns, "gone")
    gone = members.join(best.hint("merge"), F.col("node") == F.col("best"), "left_anti").select(F.col("node").alias(lost))
    return rows.join(gone.hint("merge"), own == F.col(f"`{lost}`"), "left_anti").drop(number)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def learnable(id_col: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0. A null id counts as held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 != 0, F.lit(False))


def spread_ids(id_col: Column) -> Column:
    """An order of ids that has nothing to do with their values, for bounded samples."""
    return F.xxhash64(F.lit("sample"), id_col)


def text_slices(batches: Iterator[pa.RecordBatch], most_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that none holds much more than most_bytes of text; a single longer row stays whole."""
    for batch in batches:
        col = batch.column(column)
        sizes = pc.binary_length(col).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def as_bytes(col: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8; null is empty."""
    return [x or b"" for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


def local_path(uri: str) -> str:
    return uri[len("file://"):] if uri.startswith("file://") else uri


def file_system(uri: str):
    """(pyarrow file system, path in it) of a URI: file, hdfs, s3, gs or a plain path."""
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """Writes beside the final name and moves there at the end, so that a lost or repeated task leaves no torn file."""

    def __init__(self, uri: str):
        self.fs, self.path = file_system(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp, compression=None)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


