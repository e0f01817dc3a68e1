"""Model registry: one row per training window, with its state, metric and model folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import ml
from sparkloom.session import scratch_path

SCHEMA = "window_id int, beg timestamp_ntz, end timestamp_ntz, run boolean, n_rows bigint, r2 double, path string"


def windows(spark: SparkSession, first: str, months: int, count: int) -> DataFrame:
    """Consecutive half-open training windows, none of them run."""
    start = F.lit(first).cast("timestamp_ntz")
    months_on = F.make_ym_interval(F.lit(0), F.col("id").cast("int") * months)
    beg = start + months_on
    step = F.make_ym_interval(F.lit(0), F.lit(months))
    return spark.range(count).select(
        F.col("id").cast("int").alias("window_id"), beg.alias("beg"), (beg + step).alias("end"), F.lit(False).alias("run"),
        F.lit(None).cast("bigint").alias("n_rows"), F.lit(None).cast("double").alias("r2"), F.lit(None).cast("string").alias("path"))


def next_window(registry: DataFrame) -> DataFrame:
    """The earliest window not run yet."""
    return registry.filter("NOT run").orderBy("beg").limit(1)


def append_window(registry: DataFrame, beg: Column, end: Column) -> DataFrame:
    row = registry.agg((F.max("window_id") + 1).alias("window_id"), F.max(beg).alias("beg"), F.max(end).alias("end"))
    return registry.unionByName(row.withColumn("run", F.lit(False)), allowMissingColumns=True)


def mark_run(registry: DataFrame, window_id: int, n_rows: int, r2: float | None, path: str) -> DataFrame:
    """Set the state of exactly the window that was trained."""
    mine = F.col("window_id") == window_id
    return registry.withColumns({
        "run": F.when(mine, True).otherwise(F.col("run")),
        "n_rows": F.when(mine, F.lit(n_rows).cast("bigint")).otherwise(F.col("n_rows")),
        "r2": F.when(mine, F.lit(r2).cast("double")).otherwise(F.col("r2")),
        "path": F.when(mine, F.lit(path)).otherwise(F.col("path"))})


def latest_path(registry: DataFrame) -> str | None:
    """Folder of the newest trained model."""
    return registry.filter("run").agg(F.max_by("path", "beg")).first()[0]


def train_next(registry: DataFrame, data: DataFrame, ts: str, cols: list[str], label: str) -> DataFrame:
    """Train on the next window, save the model and mark the window.

    The registry holds one row per window; only the row of the next window reaches the driver.
    """
    todo = next_window(registry).first()
    if todo is None:
        return registry
    rows = data.filter((F.col(ts) >= F.lit(todo["beg"]).cast("timestamp_ntz")) & (F.col(ts) < F.lit(todo["end"]).cast("timestamp_ntz")))
    fitted = ml.fit(rows, cols, LinearRegression(labelCol=label))
    path = scratch_path(data.sparkSession, f"model-{todo['window_id']}")
    fitted.write().save(path)
    summary = fitted.stages[-1].summary
    return mark_run(registry, todo["window_id"], summary.numInstances, float(summary.r2), path)


def load_latest(registry: DataFrame) -> PipelineModel:
    return PipelineModel.load(latest_path(registry))


def check_version(spark: SparkSession, path: str) -> bool:
    """Whether a saved model was written by the major version of this Spark."""
    meta = spark.read.text(f"{path}/metadata").select(F.get_json_object("value", "$.sparkVersion").alias("v")).first()[0]
    return meta.split(".")[0] == spark.version.split(".")[0]
