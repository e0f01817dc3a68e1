"""What several corpus operators share: reading, staging, word hashes, connected components."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"

BATCH = {  # texts vary by a factor of a thousand: bound an Arrow batch by bytes as well as by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # each step is written to the shared folder, so its shuffle files may go when it is done
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ready(spark: SparkSession, batch_bytes: int = 32 << 20) -> None:
    """Settings of the session that the operators rely on; workers started from here on find this package."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in staged:
        files = df.inputFiles()
        if files:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def hash60(column: Column | str, salt: str) -> Column:
    """0 .. 2^60 - 1 from a value's text (null is a value of its own); the same in any SQL engine that has MD5."""
    value = F.col(column) if isinstance(column, str) else column
    text = F.coalesce(value.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(salt))), 1, 15), 16, 10).cast("long")


class Remembered(dict):
    """word -> ``value(word)``; up to ``limit`` words of at most 24 bytes are remembered, about 20 MB.

    A worker process outlives a stage of a pipeline, so the table that a step uses empties those of earlier steps.
    """

    limit = 100_000
    tables: list[dict] = []

    def __init__(self, value):
        super().__init__()
        self.value = value
        Remembered.tables.append(self)

    def __missing__(self, word: bytes) -> int:
        value = self.value(word)
        if len(word) <= 24 and len(self) < self.limit:
            self[word] = value
        return value

    def in_use(self) -> Remembered:
        for other in Remembered.tables:
            if other is not self and other:
                other.clear()
        return self


_HASHES = Remembered(xxhash.xxh3_64_intdigest)


def word_hashes(text: bytes | None, lower: bool = True) -> np.ndarray:
    """Hashes of the words of a text in order; A-Z lower-cased if asked, words end at ASCII white space."""
    if not text:
        return np.empty(0, np.uint64)
    words = (text.lower() if lower else text).split()
    return np.fromiter(map(_HASHES.in_use().__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; a shorter text is one run, no words give none."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        out = mix(out + np.uint64(0x9E3779B97F4A7C15)) ^ words[k : len(words) - size + 1 + k]
    return mix(out + np.uint64(size))


def texts(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """(lists of the named columns) per batch; strings come as UTF-8 bytes, without decoding."""
    for batch in batches:
        yield tuple(
            (c.cast(pa.large_binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c).to_pylist()
            for c in (batch.column(batch.schema.get_field_index(n)) for n in names))


def offsets(df: DataFrame, part: str, value: str) -> DataFrame:
    """(part, before): the sum of ``value`` over all smaller parts. One row per part, as many as tasks wrote."""
    from pyspark.sql import Window

    totals = df.groupBy(part).agg(F.sum(value).alias("total"))
    before = F.sum("total").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(part, F.coalesce(before, F.lit(0)).cast("long").alias("before"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the connected components of an edge list; root is the smallest node.

    Union-find in rounds: a node takes its smallest neighbour as parent where that is smaller, parents are
    followed to their roots, edges are rewritten between roots and the loop ends when none is left. Every
    step is an aggregate with partial sums or a join that adaptive execution can split, so a hub may hold any
    share of the edges. Null ends are ignored. Nothing but a count of edges reaches the driver.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    e = stage(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    found = None
    while not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(both.groupBy("a").agg(F.min("b").alias("p"))
                       .select(F.col("a").alias("node"), F.least("a", "p").alias("root")), "parent")
        while True:  # follow parents; a path halves with each step
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            step = stage(parent.join(up, "root").select("node", "root", "up"), "jump")
            parent = step.select("node", F.col("up").alias("root"))
            if step.where("up <> root").isEmpty():
                break
        ends = e.join(parent.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a") \
                .join(parent.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        e = stage(ends.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges")
        if found is None:
            found = parent
        else:  # nodes joined in earlier rounds follow their roots
            moved = parent.select(F.col("node").alias("root"), F.col("root").alias("now"))
            found = stage(found.join(moved, "root", "left")
                          .select("node", F.coalesce("now", "root").alias("root")), "found")
    if found is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


LEVELS, BITS = 6, 10


def nested_limits(rows: DataFrame) -> DataFrame:
    """Where a budget ends in hash order, without sorting: (key, limit, limit_left, limit_size).

    ``rows``: key, h (0 .. 2^60 - 1), size (above 0), left (the key's budget, 1 .. sum of its sizes). Rows with
    h < limit fit whole; ``limit_left`` is what is left for the rows that hold the limit, ``limit_size`` their
    size. Sizes are summed by key and leading digit of h; only rows in the digit where the budget ends go on to
    the next digit. A histogram holds at most 2^10 counters a key, so no source makes a large group.
    """
    from pyspark.sql import Window

    for level in range(LEVELS):
        digit = F.shiftright("h", BITS * (LEVELS - 1 - level)).bitwiseAND((1 << BITS) - 1)
        sums = rows.groupBy("key", digit.alias("digit")).agg(
            F.sum("size").alias("held"), F.min("left").alias("left"), F.min("h").alias("limit"))
        upto = F.sum("held").over(Window.partitionBy("key").orderBy("digit"))
        ends = sums.withColumn("upto", upto).where("upto >= left and upto - held < left").select(
            "key", "digit", "held", "limit", (F.col("left") - F.col("upto") + F.col("held")).alias("left"))
        if level < LEVELS - 1:
            rows = stage(rows.drop("left").withColumn("digit", digit)
                         .join(ends.select("key", "digit", "left"), ["key", "digit"]).drop("digit"), "limit")
    return ends.select("key", "limit", F.col("left").alias("limit_left"), F.col("held").alias("limit_size"))
