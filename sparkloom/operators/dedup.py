"""Duplicates: by row, by key, by run; uniqueness and order checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import top_rows
from sparkloom.operators.ordered import Running, Shift, over_order
from sparkloom.session import checkpointed


def keep_one(df: DataFrame, keys: list[str], order: list[str], which: str = "first") -> DataFrame:
    """First or last row per key in an explicit order with a unique end."""
    return top_rows(df, keys, [F.desc(c) if which == "last" else F.asc(c) for c in order])


def run_starts(df: DataFrame, by, order, key: str) -> DataFrame:
    """Drop a row when the row before it has the same key value."""
    seen = over_order(df.withColumn("_set", F.lit(1)), by, order, {"_before": Shift(key), "_any": Shift("_set")})
    changed = F.col("_any").isNull() | ~F.col("_before").eqNullSafe(F.col(key))
    return seen.filter(changed).select(*df.columns)


def runs(df: DataFrame, by, order, key: str, out: str = "run") -> DataFrame:
    """Number the runs of equal neighbouring key values from 1."""
    seen = over_order(df.withColumn("_set", F.lit(1)), by, order, {"_before": Shift(key), "_any": Shift("_set")})
    start = F.col("_any").isNull() | ~F.col("_before").eqNullSafe(F.col(key))
    return over_order(checkpointed(seen.withColumn("_start", start.cast("bigint"))), by, order,
                      {out: Running("sum", "_start")}).select(*df.columns, out)


def key_checks(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """One row: is the key unique, and does the value never fall in the given order?"""
    steps = over_order(df.select(key, *[c for c in dict.fromkeys([*order, value]) if c != key]), [], order,
                       {"_before": Shift(value)})
    return steps.agg(
        (F.count(F.lit(1)) == F.count_distinct(key)).alias("key_unique"),
        F.coalesce(F.bool_and(F.col(value) >= F.col("_before")), F.lit(True)).alias("never_falls"))
