"""Binning, clipping and generalising of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.math import clip
from sparkloom.operators.filters import choose
from sparkloom.operators.groups import joined_on, quantiles, whole


def cut(value: Column, edges: list, labels: list) -> Column:
    """Right-closed bins ``(edge, next edge]``; values outside all bins give null."""
    rules = [((value > lo) & (value <= hi), name) for lo, hi, name in zip(edges, edges[1:], labels)]
    return choose(rules, F.lit(None))


def cut_width(df: DataFrame, value: str, bins: int, out: str) -> DataFrame:
    """0-based equal-width bin, right-closed, the smallest value in the first bin."""
    ends = whole(df, lo=F.min(value), hi=F.max(value))
    width = (ends["hi"] - ends["lo"]) / bins
    rules = [(F.col(value) <= ends["lo"] + width * (i + 1), i) for i in range(bins - 1)]
    index = F.when(F.col(value).isNotNull(), choose(rules, F.lit(bins - 1)))
    return df.withColumn(out, index.cast("bigint"))


def quantile_bins(df: DataFrame, by: list[str] | str, value: str, out: str, labels: list) -> DataFrame:
    """Bins between equally spaced quantiles of the group, right-closed."""
    by = [by] if isinstance(by, str) else list(by)
    n = len(labels)
    edges = {f"_e{i}": i / n for i in range(1, n)}
    found = quantiles(df, by, value, edges)
    if by:
        joined = joined_on(df, found, by)
    else:
        one = found.select(F.struct(*edges).alias("s")).scalar()
        joined = df.select("*", *[one[e].alias(e) for e in edges])
    rules = [(F.col(value) <= F.col(e), name) for e, name in zip(edges, labels)]
    bucket = F.when(F.col(value).isNotNull(), choose(rules, F.lit(labels[-1])))
    return joined.withColumn(out, bucket).select(*df.columns, out)


def clip_quantiles(df: DataFrame, value: str, low: float, high: float, out: str) -> DataFrame:
    one = quantiles(df, [], value, {"lo": low, "hi": high}).select(F.struct("lo", "hi").alias("s")).scalar()
    return df.withColumn(out, clip(F.col(value), one["lo"], one["hi"]))


def keep_top(df: DataFrame, col: str, out: str, levels: list[tuple[int, str | None]], other: str = "Other") -> DataFrame:
    """Generalise rare categories by frequency rank.

    ``levels`` lists rank limits with the label to use, None keeping the value:
    ``[(5, None)]`` keeps five categories, ``[(5, None), (10, "Top10")]`` adds a level.
    Ties in frequency go by value. The kept values are a table of at most the last limit.
    """
    limit = levels[-1][0]
    ordered = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
               .orderBy(F.desc("_n"), F.asc(col)).limit(limit))
    ranking = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))))
    names = ordered.agg(F.transform(ranking, lambda x: x["v"]).alias("names")).scalar()
    place = F.array_position(names, F.col(col))
    rules = [((place > 0) & (place <= top), F.col(col) if label is None else label) for top, label in levels]
    return df.withColumn(out, choose(rules, F.lit(other)))


def by_substring(value: Column, rules: dict[str, str], default: str) -> Column:
    """Label of the last rule whose key the value contains."""
    return choose([(value.contains(k), v) for k, v in reversed(list(rules.items()))], F.lit(default))


def mapped(value: Column, mapping: dict, default: Column | None = None) -> Column:
    """Replace values by a dictionary; others stay, or take the default."""
    return choose([(value == k, v) for k, v in mapping.items()], value if default is None else default)


def category_order(value: Column, categories: list[str]) -> Column:
    """Position of an ordered category, null for unknown ones."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), value)
    return F.when(place > 0, place)
