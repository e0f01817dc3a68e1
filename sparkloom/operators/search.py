"""Inverted index as a table of postings; discount rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import token_rows
from sparkloom.operators.groups import exact_sum


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per token and text. A common token is many rows, never one long list."""
    return token_rows(df, key, text, distinct=True)


def all_tokens(index: DataFrame, key: str, query: str) -> DataFrame:
    """Keys of the texts that hold every token of the query."""
    wanted = sorted(set(query.upper().replace("-", " ").split()))
    hits = index.filter(F.col("token").isin(*wanted))
    return hits.groupBy(key).agg(F.count_distinct("token").alias("_n")).filter(F.col("_n") == len(wanted)).select(key)


def discounts(lines: DataFrame, order: str, item: str, quantity: str, amount: str, points: DataFrame, fidelity: str,
              bulk_units: int = 20, large_order: int = 10, scale: int | None = None) -> DataFrame:
    """Per order: total, the three discounts, the best of them and the amount due.

    Loyalty gives 5 % from 1000 points, each line of ``bulk_units`` or more gives 10 %,
    ``large_order`` or more distinct items give 7 %. ``points`` holds the fidelity of the
    buyer of each order; it is joined to the orders after their lines are summed up.
    """
    bulky = F.when(F.col(quantity) >= bulk_units, F.col(amount))
    per = lines.groupBy(order).agg(
        exact_sum(amount, scale).alias("total"), F.coalesce(exact_sum(bulky, scale), F.lit(0.0)).alias("_bulk"),
        F.count_distinct(item).alias("_items")).join(points.select(order, fidelity), order)
    total = F.col("total")
    out = per.select(
        order, "total", F.when(F.col(fidelity) >= 1000, total * 0.05).otherwise(0.0).alias("loyalty"),
        (F.col("_bulk") * 0.10).alias("bulk"), F.when(F.col("_items") >= large_order, total * 0.07).otherwise(0.0).alias("large"))
    out = out.withColumn("best", F.greatest("loyalty", "bulk", "large"))
    return out.withColumn("due", F.col("total") - F.col("best"))
