"""The folder that driver and executors share, and cuts of a lineage in it."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (`spark.checkpoint.dir`); one of our own only where it is unset."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="motionloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def fresh_dir(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """After a cut: lets the driver notice that the shuffles before it are unreachable, so that their files go now and not
    whenever it next collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Written tables in the shared folder, which go at the end of the with block; for loops over tables.

    A checkpoint keeps Spark's estimate of a table's size, and joins multiply estimates: after some rounds these are numbers
    of millions of digits, and planning takes longer than running. A table that is read has the size of its files."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.folder, self.kept = spark, fresh_dir(spark, tag), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept += 1
        df.write.parquet(path := f"{self.folder}/{self.kept}")
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        delete(self.spark, self.folder)
