"""A stream appended to a stored table exactly once: every batch has a folder of its own, and a log says which batches are whole.

A batch that runs again after a failure overwrites its folder, so it adds nothing twice; readers take the folders of logged
batches only, so a batch that failed between its data and its log entry isn't seen until it has run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from motionloom.sources.logs import _exists


def _log(target: str) -> str:
    return f"{target}/_log"


def append_batch(rows: DataFrame, number: int, target: str, step=lambda name: None) -> None:
    """Writes one batch and then its log entry. A batch that is in the log is left alone."""
    spark = rows.sparkSession
    entry = f"{_log(target)}/{number:012d}"
    if _exists(spark, entry):
        return
    step("data")
    rows.write.mode("overwrite").parquet(f"{target}/batch={number}")
    step("log")
    fs = spark._jvm.org.apache.hadoop.fs.Path(entry).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(entry), True).close()


def append_stream(stream: DataFrame, target: str, checkpoint: str, step=lambda name: None) -> StreamingQuery:
    """Starts the stream over what is available; the batch numbers are those of its checkpoint."""
    return stream.writeStream.foreachBatch(lambda rows, number: append_batch(rows, number, target, step)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_appended(spark: SparkSession, target: str, schema) -> DataFrame:
    """The rows of all logged batches, with their batch number."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_log(target))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName()) for s in (fs.listStatus(where) if fs.exists(where) else [])]
    if not done:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    return spark.read.schema(schema).option("basePath", target).parquet(*[f"{target}/batch={n}" for n in sorted(done)])
