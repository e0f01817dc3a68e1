"""Resampling, seasonal sums and rolling values over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.dates import month_start, season
from sparkloom.operators.groups import exact_avg, exact_sum, joined_on, quantiles, with_group
from sparkloom.operators.ordered import Rolling, Running, over_order
from sparkloom.session import checkpointed

UNITS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH"}


def period(ts: str, unit: str) -> Column:
    return F.date_trunc(unit, F.col(ts)).cast("date")


def every_period(df: DataFrame, col: str, unit: str) -> DataFrame:
    """All periods from the first to the last one, whether or not they hold rows."""
    ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return ends.select(F.explode(F.expr(f"sequence(lo, hi, {UNITS[unit]})")).alias(col))


def resample(df: DataFrame, ts: str, value: str, unit: str, medians: bool = True, scale: int | None = None) -> DataFrame:
    """Per period: max, sum, mean, median and row count; empty periods are kept.

    Rows are pre-aggregated per period, so the joins run on one row per period.
    """
    rows = df.select(period(ts, unit).alias("period"), F.col(value))
    sums = rows.groupBy("period").agg(F.max(value).alias("max"), exact_sum(value, scale).alias("sum"),
                                      exact_avg(value, scale).alias("mean"), F.count(F.lit(1)).alias("n"))
    if medians:
        sums = joined_on(sums, quantiles(rows, "period", value, {"median": 0.5}), "period")
    out = every_period(sums.select("period"), "period", unit).join(sums, "period", "left")
    return out.withColumns({"sum": F.coalesce("sum", F.lit(0.0)), "n": F.coalesce("n", F.lit(0))})


def sum_by(df: DataFrame, label: Column, value: str, out: str = "total", name: str = "period",
           scale: int | None = None) -> DataFrame:
    return df.groupBy(label.alias(name)).agg(exact_sum(value, scale).alias(out))


def period_quantiles(df: DataFrame, ts: str, value: str, unit: str, probs: dict[str, float]) -> DataFrame:
    return quantiles(df.select(period(ts, unit).alias("period"), value), "period", value, probs)


def season_to_date(df: DataFrame, ts: str, value: str, first_month: int = 10, scale: int | None = None) -> DataFrame:
    """Daily sums and their running sum, starting anew with each season."""
    amount = F.col(value) if scale is None else F.col(value).cast(f"decimal(28,{scale})")
    days = df.groupBy(F.col(ts).cast("date").alias("day")).agg(F.sum(amount).alias("_sum"))
    days = days.withColumn("season", season(F.col("day"), first_month))
    run = over_order(checkpointed(days), "season", "day", {"_run": Running("sum", "_sum")})
    return run.select("day", "season", F.col("_sum").cast("double").alias("total"), F.col("_run").cast("double").alias("to_date"))


def rolling_daily_mean(df: DataFrame, ts: str, value: str, days: int = 7, scale: int | None = None) -> DataFrame:
    """Mean of the last ``days`` daily means on a gapless calendar, null until the frame is full."""
    daily = resample(df, ts, value, "day", medians=False, scale=scale).select("period", "mean")
    return over_order(checkpointed(daily), [], "period", {"rolling": Rolling("avg", "mean", days, days)})


def month_share(df: DataFrame, ts: str, value: str, first_month: int = 10, scale: int | None = None) -> DataFrame:
    """Monthly sums as a share of the season's sum."""
    months = df.groupBy(month_start(F.col(ts)).alias("month")).agg(exact_sum(value, scale).alias("total"))
    months = months.withColumn("season", season(F.col("month"), first_month))
    out = with_group(months, "season", _all=exact_sum("total", scale))
    return out.select("month", "season", "total", F.try_divide(F.col("total"), F.col("_all")).alias("share"))
