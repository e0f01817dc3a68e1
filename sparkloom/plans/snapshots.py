"""Versioned snapshots (slowly changing dimension, type 2; timestamp strategy)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import top_rows
from sparkloom.operators.ordered import Shift, over_order
from sparkloom.session import checkpointed


def versions(df: DataFrame, key: str, updated_at: str, tie: str | None = None) -> DataFrame:
    """Each change of a key as a version with ``valid_from`` and ``valid_to``.

    Of several rows with the same time the one with the largest ``tie`` counts.
    """
    rows = df
    if tie:
        rows = checkpointed(top_rows(df, [key, updated_at], [F.desc(tie)]))
    out = over_order(rows, key, updated_at, {"valid_to": Shift(updated_at, -1)})
    return out.withColumn("valid_from", F.col(updated_at))


def current(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter(F.col("valid_to").isNull())


def maintain(snapshot: DataFrame, incoming: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Snapshot after a load: rows newer than the current version close it and open a new one.

    ``incoming`` holds one row per key. Closed versions are not touched.
    """
    attributes = incoming.columns
    closed = snapshot.filter(F.col("valid_to").isNotNull())
    live = current(snapshot).select(*attributes, "valid_from", "valid_to")
    seen = live.select(F.col(key).alias("_k"), F.col("valid_from").alias("_since"))
    newer = incoming.join(seen, F.col(key) == F.col("_k"), "left").filter(
        F.col("_since").isNull() | (F.col(updated_at) > F.col("_since"))).select(*attributes)
    ends = newer.select(F.col(key).alias("_k"), F.col(updated_at).alias("_until"))
    ended: Column = F.coalesce(F.col("valid_to"), F.col("_until"))
    live = live.join(ends, F.col(key) == F.col("_k"), "left").withColumn("valid_to", ended).drop("_k", "_until")
    opened = newer.withColumns({"valid_from": F.col(updated_at),
                                "valid_to": F.lit(None).cast(snapshot.schema["valid_to"].dataType)})
    columns = [*attributes, "valid_from", "valid_to"]
    return closed.select(*columns).unionByName(live.select(*columns)).unionByName(opened.select(*columns))
