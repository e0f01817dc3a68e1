"""Structured Streaming forms of the incremental loads and time-series aggregates.

Streams read the table's files and run until all available data is processed. Each
micro-batch is written to a folder of its own number, so a batch that is replayed after
a failure overwrites itself; readers take the newest row per key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.operators.groups import top_rows
from sparkloom.session import scratch_path
from sparkloom.sources.sinks import unseen


def read_files(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files at ``path`` (a file, or a folder of files)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path + "*")


def timed(stream: DataFrame, ts: str, delay: str | None = None) -> DataFrame:
    """Zone-less event time as a timestamp.

    Without ``delay`` no row is ever late, whatever order the files come in; the state holds
    one row per window and key. With it, rows that lag more than ``delay`` behind the newest
    one are dropped by Spark, and state that old is given up.
    """
    out = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, delay) if delay else out


def run(stream: DataFrame, name: str, mode: str, root: str | None = None) -> str:
    """Process all available data; returns the folder holding one sub-folder per micro-batch.

    With ``root`` the load keeps its checkpoint there, and a later call goes on where it stopped.
    """
    spark = stream.sparkSession
    root = root or scratch_path(spark, name)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    job = (stream.writeStream.outputMode(mode).foreachBatch(write)
           .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
    job.awaitTermination()
    return f"{root}/out"


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _with_batch(schema):
    return T.StructType([*schema.fields]).add("batch", T.LongType())


def updated(stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Result of an aggregate run in update mode: the newest row of each key."""
    path = run(stream, name, "update")
    rows = read_batches(stream.sparkSession, path, _with_batch(stream.schema))
    return top_rows(rows, keys, [F.desc("batch")]).drop("batch")


def appended(stream: DataFrame, name: str) -> DataFrame:
    path = run(stream, name, "append")
    return read_batches(stream.sparkSession, path, _with_batch(stream.schema)).drop("batch")


def windowed(stream: DataFrame, ts: str, size: str, slide: str | None, keys: list[str], **aggs: Column) -> DataFrame:
    """Aggregates per tumbling or sliding window, for a stream made by ``timed``."""
    slot = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = stream.groupBy(slot.alias("w"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, *aggs)


def first_seen(stream: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, once and for all: a key lives as long as the table, as does its state."""
    return stream.select(*keys).dropDuplicates(keys)


def load_id(spark: SparkSession, state: str) -> str:
    """Name of the load that keeps its checkpoint at ``state``; stored there by the first call."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/load")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([(uuid.uuid4().hex,)], "id string").coalesce(1).write.parquet(f"{state}/load")
    return spark.read.schema("id string").parquet(f"{state}/load").head()[0]


def append_unseen(stream: DataFrame, target: str, keys: list[str], state: str | None = None) -> None:
    """Append the rows of each micro-batch whose key the target lacks.

    The checkpoint belongs to the target (``<target>-state`` if none is given): later calls,
    also with other source folders, go on counting batches where the last one stopped. A
    batch is written to a folder of its load's name and its number, so a replayed batch
    overwrites itself alone; it does not look at its own earlier output, and of rows that
    share a key it keeps the smallest, so a replay gives the same rows.
    """
    spark, state = stream.sparkSession, state or f"{target.rstrip('/')}-state"
    load = load_id(spark, state)
    schema = T.StructType([*stream.schema.fields]).add("load", T.StringType()).add("batch", T.LongType())

    def write(batch: DataFrame, number: int) -> None:
        held = spark.read.schema(schema).option("basePath", target).parquet(target)
        held = held.filter(~((F.col("load") == load) & (F.col("batch") >= number)))
        one = top_rows(batch, keys, [c for c in batch.columns if c not in keys] or keys)
        unseen(one, held, keys).write.mode("overwrite").parquet(f"{target}/load={load}/batch={number}")

    job = (stream.writeStream.foreachBatch(write).trigger(availableNow=True)
           .option("checkpointLocation", f"{state}/checkpoint").start())
    job.awaitTermination()
