"""Time series: resampling, seasons, shares, zones."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.functions import dates as D
from sparkloom.operators import timeseries as S
from sparkloom.operators.aggregates import describe

DEC = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


@query("ts1_resample", "WITH " + ", ".join(f"""{u} AS (SELECT '{u}' AS unit, p AS period, MAX(v) AS max, COALESCE({DEC.format('v')}, 0) AS sum, ROUND({DEC.format('v')} / COUNT(v), 6) AS mean,
 ROUND(QUANTILE_CONT(v, 0.5), 4) AS median, COUNT(v) AS n
 FROM (SELECT unnest(generate_series(date_trunc('{u}', MIN({ts})), date_trunc('{u}', MAX({ts})), INTERVAL {step}))::DATE AS p FROM {table})
 LEFT JOIN (SELECT date_trunc('{u}', {ts})::DATE AS q, {v} AS v FROM {table}) ON p = q GROUP BY 1, 2)"""
    for u, step, table, ts, v in (("day", "1 DAY", "events", "ts", "value"), ("month", "1 MONTH", "orders", "o_orderdate", "o_totalprice"),
                                  ("quarter", "3 MONTH", "orders", "o_orderdate", "o_totalprice")))
    + " SELECT * FROM day UNION ALL SELECT * FROM month UNION ALL SELECT * FROM quarter")
def _(t):
    parts = [S.resample(t.events, "ts", "value", "day", scale=2).withColumn("unit", F.lit("day")),
             S.resample(t.orders, "o_orderdate", "o_totalprice", "month", scale=2).withColumn("unit", F.lit("month")),
             S.resample(t.orders, "o_orderdate", "o_totalprice", "quarter", scale=2).withColumn("unit", F.lit("quarter"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumns({"mean": F.round("mean", 6), "median": F.round("median", 4)})


@query("ts2_shifted_periods", f"""
WITH f AS (SELECT MIN(o_orderdate) AS lo FROM orders), o AS (SELECT *, (YEAR(o_orderdate) - YEAR(lo)) * 12 + MONTH(o_orderdate) - MONTH(lo) AS k FROM orders, f)
SELECT 'two months' AS rule, (date_trunc('month', lo) + INTERVAL 1 MONTH * (k // 2 * 2))::DATE AS period, {DEC.format('o_totalprice')} AS total FROM o GROUP BY 1, 2
UNION ALL SELECT 'year to may', make_date((YEAR(o_orderdate) + CASE WHEN MONTH(o_orderdate) > 5 THEN 1 ELSE 0 END)::INTEGER, 5, 31), {DEC.format('o_totalprice')} FROM o GROUP BY 1, 2
UNION ALL SELECT 'year to september', make_date((YEAR(o_orderdate) + CASE WHEN MONTH(o_orderdate) > 9 THEN 1 ELSE 0 END)::INTEGER, 9, 30), {DEC.format('o_totalprice')} FROM o GROUP BY 1, 2""")
def _(t):
    d = F.col("o_orderdate")
    first = t.orders.agg(F.min("o_orderdate").alias("lo")).scalar()
    rules = {"two months": D.month_block(d, first, 2), "year to may": D.year_ending(d, 5), "year to september": D.year_ending(d, 9)}
    out = None
    for rule, label in rules.items():
        part = S.sum_by(t.orders, label, "o_totalprice", scale=2).withColumn("rule", F.lit(rule))
        out = part if out is None else out.unionByName(part)
    return out


@query("ts3_period_quantiles", """
SELECT date_trunc('quarter', o_orderdate)::DATE AS period, ROUND(QUANTILE_CONT(o_totalprice, 0.05), 4) AS p5, ROUND(QUANTILE_CONT(o_totalprice, 0.5), 4) AS p50,
 ROUND(QUANTILE_CONT(o_totalprice, 0.95), 4) AS p95 FROM orders GROUP BY 1""")
def _(t):
    out = S.period_quantiles(t.orders, "o_orderdate", "o_totalprice", "quarter", {"p5": 0.05, "p50": 0.5, "p95": 0.95})
    return out.withColumns({c: F.round(c, 4) for c in ("p5", "p50", "p95")})


SEASON = "CAST(YEAR({0}) + CASE WHEN MONTH({0}) >= 10 THEN 1 ELSE 0 END AS INTEGER)"


@query("ts4_season_to_date", f"""
WITH d AS (SELECT o_orderdate::DATE AS day, {SEASON.format('o_orderdate')} AS season, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS x FROM orders GROUP BY 1, 2)
SELECT day, season, x::DOUBLE AS total, (SUM(x) OVER (PARTITION BY season ORDER BY day))::DOUBLE AS to_date FROM d""")
def _(t):
    return S.season_to_date(t.orders, "o_orderdate", "o_totalprice", scale=2)


@query("ts5_rolling_daily_mean", f"""
WITH d AS (SELECT o_orderdate::DATE AS day, {DEC.format('o_totalprice')} / COUNT(*) AS mean FROM orders GROUP BY 1),
g AS (SELECT unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY))::DATE AS period FROM d), j AS (SELECT period, mean FROM g LEFT JOIN d ON day = period)
SELECT period, ROUND(mean, 6) AS mean, CASE WHEN COUNT(mean) OVER w = 7 THEN ROUND(AVG(mean) OVER w, 4) END AS rolling FROM j
WINDOW w AS (ORDER BY period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(t):
    out = S.rolling_daily_mean(t.orders, "o_orderdate", "o_totalprice", scale=2)
    return out.select("period", F.round("mean", 6).alias("mean"), F.round("rolling", 4).alias("rolling"))


@query("ts6_seasonality", f"""
SELECT CAST(MONTH(o_orderdate) AS INTEGER) AS month, COUNT(*) AS n, ROUND({DEC.format('o_totalprice')} / COUNT(*), 5) AS mean, ROUND(STDDEV_SAMP(o_totalprice), 4) AS std, MIN(o_totalprice) AS min,
 ROUND(QUANTILE_CONT(o_totalprice, 0.25), 5) AS q25, ROUND(QUANTILE_CONT(o_totalprice, 0.5), 5) AS q50, ROUND(QUANTILE_CONT(o_totalprice, 0.75), 5) AS q75, MAX(o_totalprice) AS max FROM orders GROUP BY 1""")
def _(t):
    out = describe(t.orders.select(F.month("o_orderdate").alias("month"), "o_totalprice"), "month", "o_totalprice", scale=2)
    return out.withColumns({**{c: F.round(c, 5) for c in ("mean", "q25", "q50", "q75")}, "std": F.round("std", 4)})


@query("ts7_month_share", f"""
WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, {SEASON.format('o_orderdate')} AS season, {DEC.format('o_totalprice')} AS total FROM orders GROUP BY 1, 2)
SELECT month, season, total, ROUND(total / CAST(SUM(CAST(total AS DECIMAL(18,2))) OVER (PARTITION BY season) AS DOUBLE), 8) AS share FROM m""")
def _(t):
    return S.month_share(t.orders, "o_orderdate", "o_totalprice", scale=2).withColumn("share", F.round("share", 8))


@query("ts8_per_row_zone", """
WITH z AS (SELECT event_id, ts, CASE WHEN user_id % 2 = 0 THEN 'America/Denver' ELSE 'America/New_York' END AS zone FROM events)
SELECT event_id, zone, ts AT TIME ZONE zone AT TIME ZONE 'UTC' AS utc, ts AT TIME ZONE zone AT TIME ZONE 'America/Denver' AS local FROM z""")
def _(t):
    zone = F.when(F.col("user_id") % 2 == 0, "America/Denver").otherwise("America/New_York")
    src = t.events.select("event_id", "ts", zone.alias("zone"))
    return src.select("event_id", "zone", D.to_zone(F.col("ts"), F.col("zone"), "UTC").alias("utc"),
                      D.to_zone(F.col("ts"), F.col("zone"), "America/Denver").alias("local"))
