"""Sinks and the incremental loads built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import scratch_path


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def reload_parquet(df: DataFrame, path: str) -> None:
    """Truncate and load again; running it twice leaves the same table."""
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def unseen(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not loaded yet."""
    return df.join(done.select(*keys), keys, "left_anti")


def load_unseen(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose key the table at ``path`` does not hold."""
    spark = df.sparkSession
    append_parquet(unseen(df, spark.read.schema(df.schema).parquet(path), keys), path)


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
