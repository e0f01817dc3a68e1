"""Column shaping: names, dtypes, safe casts, row-wise values."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.ordered import renamed

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def rename_by(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, keys: Iterable[str]) -> DataFrame:
    """Prefix every column that is not a key."""
    keys = set(keys)
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keys})


def select_dtypes(df: DataFrame, kinds: Iterable[str] = NUMERIC) -> DataFrame:
    return df.select(*[c for c, t in df.dtypes if t.split("(")[0] in tuple(kinds)])


def select_like(df: DataFrame, like: str | None = None, regex: str | None = None) -> DataFrame:
    """Columns whose name contains ``like`` or matches ``regex`` anywhere."""
    test = (lambda c: like in c) if like is not None else (lambda c: re.search(regex, c) is not None)
    return df.select(*[c for c in df.columns if test(c)])


def drop_repeated_names(df: DataFrame) -> DataFrame:
    """Keep the first of each column name."""
    unique = [f"{c}__{i}" for i, c in enumerate(df.columns)]
    first = {}
    for c, u in zip(df.columns, unique):
        first.setdefault(c, u)
    return df.toDF(*unique).select(*[F.col(f"`{u}`").alias(c) for c, u in first.items()])


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def try_cast(col: str | Column, dtype: str) -> Column:
    """Cast that gives null where the value does not parse."""
    return (F.col(col) if isinstance(col, str) else col).try_cast(dtype)


def row_range(*cols: str) -> Column:
    return F.greatest(*cols) - F.least(*cols)


def row_sum(*cols: str) -> Column:
    """Sum across columns; nulls count as nothing."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def row_mean(*cols: str) -> Column:
    present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(row_sum(*cols), present)


def aligned_add(left: DataFrame, right: DataFrame, key: str, a: str, b: str, fill: float | None = None,
                both: str | None = None) -> DataFrame:
    """Add two keyed columns by key; a key on one side only gives null, or uses ``fill``.

    ``both`` adds the filled sum under that name next to the strict one, from the same join.
    """
    other, match = renamed(right.select(key, b), [key], "_o_")
    strict = F.col(a) + F.col("_o_" + b)
    filled = strict if fill is None else F.coalesce(F.col(a), F.lit(fill)) + F.coalesce(F.col("_o_" + b), F.lit(fill))
    sums = [filled.alias("total")] if both is None else [strict.alias("total"), filled.alias(both)]
    return left.select(key, a).join(other, match, "full_outer").select(
        F.coalesce(F.col(key), F.col("_o_" + key)).alias(key), *sums)
