"""Long to wide and back, cross-tabulation, dummy columns.

Wide forms take the list of output columns, so Spark needs no extra pass to find it
and the width of the result is fixed. Values that are not listed are not lost: they
share the column ``REST``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.groups import whole


REST = "other"


def _apart(values: list, *names: str) -> None:
    """The columns of unlisted values and totals must not carry the name of a listed value."""
    clash = sorted(set(names) & set(map(str, values)))
    if clash or len(set(names)) < len(names):
        raise ValueError(f"name the rest and the total otherwise than the values: {clash or names}")


def listed(col: Column, values: list, rest: str = REST) -> Column:
    """The value as text if it is listed, else (also for null) ``rest``."""
    return F.when(col.isin(*values), col.cast("string")).otherwise(F.lit(rest))


def pivot(df: DataFrame, index: list[str] | str, columns: str, values: list, agg: Column, rest: str = REST) -> DataFrame:
    _apart(values, rest)
    index = [index] if isinstance(index, str) else list(index)
    marked = df.withColumn(columns, listed(F.col(columns), values, rest))
    return marked.groupBy(*index).pivot(columns, [*map(str, values), rest]).agg(agg)


def crosstab(df: DataFrame, row: Column | str, col: Column | str, values: list, row_name: str = "row",
             rest: str = REST) -> DataFrame:
    """Counts per row and column label, zero where none."""
    _apart(values, rest)
    row = F.col(row) if isinstance(row, str) else row
    col = F.col(col) if isinstance(col, str) else col
    marked = df.select(row.alias(row_name), listed(col, values, rest).alias("_c"))
    names = [*map(str, values), rest]
    return marked.groupBy(row_name).pivot("_c", names).agg(F.count(F.lit(1))).na.fill(0, subset=names)


def crosstab_totals(df: DataFrame, row: str, col: str, values: list, total: str = "All", rest: str = REST) -> DataFrame:
    """Counts with a total row and column, from one cube; a row label that reads as ``total`` keeps a row of its own."""
    _apart(values, rest, total)
    marked = df.select(F.col(row).alias("r"), listed(F.col(col), values, rest).alias("c"))
    cells = marked.cube("r", "c").agg(F.count(F.lit(1)).alias("n"), F.grouping("r").alias("gr"), F.grouping("c").alias("gc"))
    named = cells.select(F.when(F.col("gr") == 1, total).otherwise(F.col("r")).alias(row),
                         F.when(F.col("gc") == 1, total).otherwise(F.col("c")).alias("c"), "gr", "n")
    wide = named.groupBy(row, "gr").pivot("c", [*values, rest, total]).agg(F.sum("n")).drop("gr")
    return wide.na.fill(0, subset=[*values, rest, total])


def crosstab_shares(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long cross-tab with the share of each cell in all rows, its column and its row."""
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(F.col(row).alias("_r")).agg(F.sum("n").alias("rn"))
    cols = cells.groupBy(F.col(col).alias("_c")).agg(F.sum("n").alias("cn"))
    both = (cells.join(rows, F.col(row).eqNullSafe(F.col("_r"))).join(cols, F.col(col).eqNullSafe(F.col("_c"))))
    total = whole(df, n=F.count(F.lit(1)))["n"]
    n = F.col("n").cast("double")
    return both.select(row, col, (n / total).alias("of_all"), (n / F.col("cn")).alias("of_column"), (n / F.col("rn")).alias("of_row"))


def melt(df: DataFrame, ids: list[str], values: list[str], var: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, var, value)


def unmelt(df: DataFrame, ids: list[str], var: str, value: str, values: list) -> DataFrame:
    return df.groupBy(*ids).pivot(var, values).agg(F.first(value, ignorenulls=True))


def transpose_head(df: DataFrame, order: list, index: str, n: int) -> DataFrame:
    """First ``n`` rows turned into columns named by the index value."""
    return df.orderBy(*order).limit(n).transpose(index)


def dummies(df: DataFrame, col: str, values: list, prefix: str, rest: str = REST) -> DataFrame:
    """One flag per listed value, and one for all others; a null sets none."""
    flags = {f"{prefix}{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in values}
    return df.withColumns({**flags, f"{prefix}{rest}": F.coalesce((~F.col(col).isin(*values)).cast("int"), F.lit(0))})


def undummy(df: DataFrame, prefix: str, values: list, out: str, rest: str = REST) -> DataFrame:
    """Name of the first column holding the largest flag; null if none is set."""
    return df.withColumn(out, F.coalesce(*[F.when(F.col(f"{prefix}{v}") == 1, F.lit(v)) for v in [*values, rest]]))


def character_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per text and character with its number of occurrences."""
    each = df.select(key, F.explode(F.split(text, "")).alias("character")).filter("character <> ''")
    return each.groupBy(key, "character").agg(F.count(F.lit(1)).alias("n"))
