"""Group totals on every row, ranks, top rows and exact quantiles, safe for large groups.

None of these puts a whole group into one task: totals are pre-aggregated and joined
back (adaptive execution splits the skewed side of that join), top rows are cut down
before the shuffle, ranks run over distinct values with counts, and quantiles are found
by radix selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.ordered import RowNumber, Running, over_order, renamed
from sparkloom.session import checkpointed


def units(col: str | Column, scale: int = 2) -> Column:
    """A fixed-point amount held as a double, as a whole number of its smallest unit."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c * 10 ** scale).cast("bigint")


def exact_sum(col: str | Column, scale: int | None = 2) -> Column:
    """Sum of fixed-point amounts held as doubles; the same whatever the row order.

    ``scale`` is the number of decimals the amounts are known to have: they are added as
    decimals of 38 digits. With ``None`` this is the plain sum of any doubles.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c) if scale is None else F.sum(c.cast(f"decimal(28,{scale})")).cast("double")


def exact_avg(col: str | Column, scale: int | None = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.avg(c) if scale is None else F.try_divide(exact_sum(c, scale), F.count(c))


def whole(df: DataFrame, **aggs: Column) -> Column:
    """Aggregates of the whole frame as one struct, read through a scalar subquery."""
    return df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s")).scalar()


def with_group(df: DataFrame, by: list[str] | str, **aggs: Column) -> DataFrame:
    """Add aggregates of each row's group to the row."""
    by = [by] if isinstance(by, str) else list(by)
    if not by:
        total = whole(df, **aggs)
        return df.select("*", *[total[n].alias(n) for n in aggs])
    totals, match = renamed(df.groupBy(*by).agg(*[a.alias(n) for n, a in aggs.items()]), by, "_g_")
    return df.join(totals, match).select(*df.columns, *[F.col("_g_" + n).alias(n) for n in aggs])


def top_rows(df: DataFrame, by: list[str] | str, order: list, k: int = 1, ties: str | None = None,
             rank_as: str | None = None) -> DataFrame:
    """First ``k`` rows per group in the given order.

    ``ties='min'`` and ``'dense'`` keep rows sharing a rank. Spark limits each group to
    its best rows before the shuffle, so a large group costs k rows per map task.
    """
    by = [by] if isinstance(by, str) else list(by)
    fn = {None: F.row_number, "min": F.rank, "dense": F.dense_rank}[ties]
    name = rank_as or "_rank"
    out = df.withColumn(name, fn().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= k)
    return out.withColumn(name, F.col(name).cast("bigint")) if rank_as else out.drop(name)


def ranked(df: DataFrame, by: list[str] | str, value: str, descending: bool = False,
           prefix: str = "rank") -> DataFrame:
    """Add ``<prefix>_avg``, ``_min`` and ``_dense`` ranks of ``value`` in its group.

    Nulls get no rank. The scan runs over distinct values with their counts.
    """
    by = [by] if isinstance(by, str) else list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    cum = over_order(checkpointed(counts), by, [value], {"_cum": Running("sum", "_n"), "_dense": RowNumber()}, descending)
    ranks, match = renamed(cum.select(
        *by, value,
        (F.col("_cum") - (F.col("_n") - 1) / 2).alias("avg"),
        (F.col("_cum") - F.col("_n") + 1).alias("min"),
        F.col("_dense").alias("dense")), [*by, value], "_r_")
    return df.join(ranks, match, "left").select(
        *df.columns, *[F.col("_r_" + m).alias(f"{prefix}_{m}") for m in ("avg", "min", "dense")])


LEVELS, BITS = 4, 16  # a double's 64 ordered bits, 16 at a time


def ordered_bits(value: Column) -> Column:
    """A bigint that orders as the double does: its IEEE bits, negated below zero; NaN behind everything.

    ``value`` must be a column, since it is named many times. Powers of two and products with them are exact.
    """
    two = F.lit(2.0)
    size = F.abs(value)
    near = F.floor(F.log2(size))
    power = F.least(F.greatest(F.when(F.pow(two, near) > size, near - 1).when(F.pow(two, near + 1) <= size, near + 1).otherwise(near),
                               F.lit(-1022)), F.lit(1023))
    fraction = size / F.pow(two, power)  # from 1 to below 2, below 1 for the smallest doubles
    normal = (power + 1022) * (1 << 52) + (fraction * float(1 << 52)).cast("bigint")
    code = (F.when(size == 0, F.lit(0)).when(size == F.lit(float("inf")), F.lit(2047 << 52)).otherwise(normal)).cast("bigint")
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(value < 0, -code).otherwise(code)


def quantiles(df: DataFrame, by: list[str] | str, value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one column per entry of ``probs``, by radix selection.

    Rows are counted by group and the leading 16 of a value's 64 ordered bits, which combines on the map side. Only
    rows in a bucket that holds an asked rank go on to the next 16 bits, and after four rounds a bucket is one
    value. No value is sorted and a histogram has at most 2^16 counters, so a group may hold any share of the rows.
    """
    by = [by] if isinstance(by, str) else list(by)
    keys = by or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(0))
    rows = src.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.select(*keys, "_v", ordered_bits(F.col("_v")).alias("_code"))
    digits = [(1 << BITS) - 1 if level else -1 for level in range(LEVELS)]  # the first holds the sign

    def digit(level: int) -> Column:
        return F.shiftright("_code", BITS * (LEVELS - 1 - level)).bitwiseAND(digits[level])

    counts = rows.groupBy(*keys, digit(0).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_prefix"))
    counts = counts.select(*keys, "_prefix", "_n", (total - 1).alias("_last"), upto.alias("_upto"))
    wanted = []
    for i, p in enumerate(probs.values()):
        place = F.lit(float(p)) * F.col("_last")
        wanted += [F.struct(F.lit(2 * i + side).alias("i"), rank.cast("bigint").alias("rank"), (place - F.floor(place)).alias("f"))
                   for side, rank in enumerate((F.floor(place), F.ceil(place)))]
    found = counts.withColumn("_asked", F.array(*wanted))

    def inside(frame: DataFrame) -> DataFrame:
        """The asked ranks of each bucket, counted from its first row; buckets without one go."""
        below = F.col("_upto") - F.col("_n")
        here = F.filter("_asked", lambda r: (r["rank"] >= below) & (r["rank"] < F.col("_upto")))
        here = F.transform(here, lambda r: F.struct(r["i"].alias("i"), (r["rank"] - below).alias("rank"), r["f"].alias("f")))
        return frame.withColumn("_asked", here).filter(F.size("_asked") > 0)

    for level in range(1, LEVELS):
        # a table of known size, so that Spark sends it to the rows where it is small instead of sorting all rows
        asked, match = renamed(checkpointed(inside(found).select(*keys, "_prefix", "_asked")), keys, "_a_")
        held = rows.withColumn("_prefix", F.shiftright("_code", BITS * (LEVELS - level)))
        held = held.join(asked, match & (F.col("_prefix") == F.col("_a__prefix")))
        counts = held.groupBy(*keys, "_prefix", F.col("_a__asked").alias("_asked"), digit(level).alias("_digit")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_prefix").orderBy("_digit"))
        found = counts.select(*keys, (F.shiftleft("_prefix", BITS) + F.col("_digit")).alias("_prefix"), "_asked", "_n", "_v",
                              upto.alias("_upto"))
    each = inside(found).select(*keys, "_v", F.explode("_asked").alias("_r"))
    ends = each.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_r.i") == 2 * i + side, F.col(c))).alias(f"_{side}{c[-1]}_{name}")
        for i, name in enumerate(probs) for side, c in ((0, "_v"), (1, "_v"), (0, "_r.f"))])
    return ends.select(*by, *[
        (F.col(f"_0v_{n}") + (F.col(f"_1v_{n}") - F.col(f"_0v_{n}")) * F.col(f"_0f_{n}")).alias(n) for n in probs])


def joined_on(left: DataFrame, right: DataFrame, by: list[str] | str, how: str = "left") -> DataFrame:
    """Add the other columns of ``right`` (one row per key) to ``left``, null keys matching."""
    by = [by] if isinstance(by, str) else list(by)
    other, match = renamed(right, by, "_j_")
    extra = [c for c in right.columns if c not in by]
    return left.join(other, match, how).select(*left.columns, *[F.col("_j_" + c).alias(c) for c in extra])
