"""Aggregations: summaries, frequencies, modes, histograms, two-level counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import exact_avg, joined_on, quantiles, top_rows, whole
from sparkloom.operators.ordered import RowNumber, over_order

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, by: list[str] | str, value: str, scale: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max, overall or per group; ``scale`` as in ``exact_sum``."""
    by = [by] if isinstance(by, str) else list(by)
    base = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(value).alias("n"), exact_avg(value, scale).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    quarts = quantiles(df, by, value, QUARTILES)
    if by:
        return joined_on(base, quarts, by)
    one = quarts.select(F.struct(*QUARTILES).alias("s")).scalar()
    return base.select("*", *[one[q].alias(q) for q in QUARTILES])


def value_counts(df: DataFrame, col: str, top: int | None = None, dropna: bool = True) -> DataFrame:
    rows = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), F.asc(col)).limit(top)


def modes(df: DataFrame, by: list[str] | str, col: str, all_ties: bool = True) -> DataFrame:
    """Most frequent value per group; every tied one, or the smallest."""
    by = [by] if isinstance(by, str) else list(by)
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    if not all_ties:
        return top_rows(counts, by, [F.desc("n"), F.asc(col)])
    if by:
        return top_rows(counts, by, [F.desc("n")], ties="min")
    return counts.filter(F.col("n") == whole(counts, m=F.max("n"))["m"])


def count_of_counts(df: DataFrame, by: list[str] | str, n: str = "n", groups: str = "groups") -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(n)).groupBy(n).agg(F.count(F.lit(1)).alias(groups))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from the smallest to the largest value, the last bin closed."""
    ends = whole(df, lo=F.min(value), hi=F.max(value))
    width = (ends["hi"] - ends["lo"]) / bins
    place = F.floor(F.try_divide(F.col(value) - ends["lo"], width))  # one value only: one bin
    index = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    return (df.filter(F.col(value).isNotNull()).withColumns({"bin": index.cast("bigint")})
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))


def share_within(df: DataFrame, value: str, ks: list[int], scale: int | None = None) -> DataFrame:
    """Percent of rows closer to the mean than k population standard deviations."""
    s = whole(df, m=exact_avg(value, scale), s=F.stddev_pop(value))
    inside = [F.avg((F.abs(F.col(value) - s["m"]) < k * s["s"]).cast("int")).alias(f"within_{k}") for k in ks]
    return df.agg(*inside)


def percent_true(test: Column) -> Column:
    """Percent of all rows where the test holds; a null test does not hold."""
    return F.try_divide(F.count_if(test).cast("double") * 100, F.count(F.lit(1)))


def concat_ordered(col: str, order: str, sep: str = "", distinct: bool = False) -> Column:
    """Strings of a small group joined in order."""
    d = "DISTINCT " if distinct else ""
    return F.expr(f"listagg({d}{col}, '{sep}') WITHIN GROUP (ORDER BY {order})")


def concat_blocks(df: DataFrame, by: list[str] | str, order: list[str] | str, col: str, out: str, block: int = 1000) -> DataFrame:
    """Strings of a group joined in order, in blocks of ``block`` rows numbered from 0.

    The blocks of a group, one after the other, are its whole text; no task builds more
    than one block at a time, however large the group is.
    """
    by = [by] if isinstance(by, str) else list(by)
    placed = over_order(df, by, order, {"_n": RowNumber()})
    blocks = placed.withColumn("block", F.floor((F.col("_n") - 1) / block))
    return blocks.groupBy(*by, "block").agg(concat_ordered(col, "_n").alias(out))
