"""Missing values: filling by statistic, by order, by interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import exact_avg, quantiles, whole
from sparkloom.operators.ordered import Ahead, RowNumber, Running, over_order
from sparkloom.session import checkpointed


def fill_statistic(df: DataFrame, col: str, strategy: str, out: str) -> DataFrame:
    """Fill nulls with the column's mean, median or (smallest) mode."""
    if strategy == "mean":
        value = whole(df, v=F.avg(col))["v"]
    elif strategy == "median":
        value = quantiles(df, [], col, {"v": 0.5}).scalar()
    else:
        counts = df.filter(F.col(col).isNotNull()).groupBy(col).count()
        value = counts.orderBy(F.desc("count"), F.asc(col)).limit(1).select(col).scalar()
    return df.withColumn(out, F.coalesce(F.col(col), value))


def fill_exact_mean(df: DataFrame, col: str, out: str, scale: int | None = None) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(col), whole(df, m=exact_avg(col, scale))["m"]))


def fill_ordered(df: DataFrame, by, order, col: str, forward: str | None = None,
                 backward: str | None = None) -> DataFrame:
    """Last known value before (``forward`` names the column) or next one after (``backward``)."""
    specs = {}
    if forward:
        specs[forward] = Running("last", col)
    if backward:
        specs[backward] = Ahead(col)
    return over_order(df, by, order, specs)


def _neighbours(df: DataFrame, by, order, col: str) -> DataFrame:
    """Add the row number and the known neighbours (value and row number) of each row."""
    numbered = over_order(df, by, order, {"_i": RowNumber()})
    known = checkpointed(numbered.withColumn("_at", F.when(F.col(col).isNotNull(), F.col("_i"))))
    return over_order(known, by, order, {
        "_pv": Running("last", col), "_pi": Running("last", "_at"), "_nv": Ahead(col), "_ni": Ahead("_at")})


def interpolate(df: DataFrame, by, order, col: str, out: str, method: str = "linear",
                when: Column | None = None, otherwise: Column | None = None) -> DataFrame:
    """Fill nulls between known values by row position.

    Leading nulls stay, trailing nulls take the last value. ``nearest`` takes the closer
    neighbour, the earlier one on a tie, and fills inside only. With ``when``, rows
    outside the condition take ``otherwise`` where they are null.
    """
    near = _neighbours(df, by, order, col)
    share = (F.col("_i") - F.col("_pi")) / (F.col("_ni") - F.col("_pi"))
    linear = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * share
    inside = F.col("_pi").isNotNull() & F.col("_ni").isNotNull()
    if method == "nearest":
        closer = F.when(F.col("_i") - F.col("_pi") <= F.col("_ni") - F.col("_i"), F.col("_pv")).otherwise(F.col("_nv"))
        value = F.when(inside, closer)
    else:
        value = F.when(inside, linear).otherwise(F.col("_pv"))
    if when is not None:
        value = F.when(when, value).otherwise(otherwise)
    return near.withColumn(out, F.coalesce(F.col(col), value)).select(*df.columns, out)


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column: null count and share."""
    cols = cols or df.columns
    # one pass over the table; the wide single row is then turned long
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot("_n", cols, "column_name", "nulls").select(
        "column_name", "nulls", F.try_divide(F.col("nulls").cast("double"), F.col("_n")).alias("null_share"))
