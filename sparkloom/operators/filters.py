"""Row selection by position, by group, by sample; replacement by condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import with_group
from sparkloom.operators.ordered import RowNumber, over_order, renamed


def at_positions(df: DataFrame, order: list[str], test, by: list[str] | None = None) -> DataFrame:
    """Rows whose 0-based position in the given order passes ``test(position)``."""
    placed = over_order(df, by or [], order, {"_pos": RowNumber()})
    return placed.filter(test(F.col("_pos") - 1)).drop("_pos")


def parts_at(df: DataFrame, order: list[str], tests: dict[str, object], out: str) -> DataFrame:
    """Rows by 0-based position, once for each named test they pass; positions are numbered once."""
    placed = over_order(df, [], order, {"_pos": RowNumber()})
    names = F.array_compact(F.array(*[F.when(test(F.col("_pos") - 1), F.lit(name)) for name, test in tests.items()]))
    return placed.withColumn(out, F.explode(names)).drop("_pos")


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def where(value: Column, keep: Column, other=None) -> Column:
    """Keep the value where the condition holds, else ``other``; a null condition does not hold."""
    return F.when(keep, value).otherwise(F.lit(None) if other is None else other)


def mask(value: Column, hide: Column, other=None) -> Column:
    """Replace the value where the condition holds."""
    return F.when(hide, F.lit(None) if other is None else other).otherwise(value)


def choose(rules: list[tuple[Column, object]], default) -> Column:
    """First matching rule wins."""
    out = None
    for test, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def recency(day: Column, as_of: Column, bands: list[tuple[int, str]], old: str) -> Column:
    """Name of the first band, in days before ``as_of``, that the day lies in."""
    return choose([(day >= F.date_sub(as_of, days), name) for days, name in bands], old)


def keep_groups(df: DataFrame, by: list[str] | str, test: Column, **aggs: Column) -> DataFrame:
    """All rows of the groups whose aggregates pass ``test``.

    The aggregates are named columns of a pre-aggregated table; a semi join brings the
    rows back without putting a group into one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    good = df.groupBy(*by).agg(*[a.alias(n) for n, a in aggs.items()]).filter(test)
    good, match = renamed(good.select(*by), by, "_k_")
    return df.join(good, match, "left_semi")


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key: repeatable, and the top-n runs in parallel."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), key).limit(n)


def cluster_sample(df: DataFrame, cluster: str, clusters: int, seed: int = 42) -> DataFrame:
    """All rows of ``clusters`` whole clusters, chosen by a seeded hash of the cluster key."""
    chosen = sample_exact(df.select(cluster).distinct(), cluster, clusters, seed)
    return df.join(chosen, cluster, "left_semi")


def at_least_group_size(df: DataFrame, by: list[str] | str, n: int, name: str = "group_size") -> DataFrame:
    return with_group(df, by, **{name: F.count(F.lit(1))}).filter(F.col(name) >= n)
