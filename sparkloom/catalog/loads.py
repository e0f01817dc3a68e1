"""Incremental loads and their streaming forms."""

from pyspark.sql import functions as F

from sparkloom.catalog.games_sql import MATCH, V1
from sparkloom.catalog.registry import query
from sparkloom.operators.groups import exact_sum, top_rows
from sparkloom.plans import games as G
from sparkloom.plans import snapshots as S
from sparkloom.sources import sinks
from sparkloom.sources.tables import SCHEMAS
from sparkloom.streaming import keyed_state as K
from sparkloom.streaming import micro_batches as M


def events_stream(t):
    return M.read_files(t.spark, t.path("events"), SCHEMAS["events"])


@query("inc1_load_unseen", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = sinks.scratch(t.spark, "staged")
    sinks.append_parquet(rows.filter("o_orderstatus = 'F'"), path)
    sinks.load_unseen(rows, path, ["o_orderkey"])
    sinks.load_unseen(rows, path, ["o_orderkey"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query("inc2_replace_features", V1 + MATCH)
def _(t):
    path = sinks.scratch(t.spark, "features")
    out = G.matchups(G.features(G.team_games(t.lineitem, t.orders), ["team_id", "season"]))
    sinks.reload_parquet(out, path)
    back = t.spark.read.schema(out.schema).parquet(path)
    return back.select([F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in back.dtypes])


@query("inc3_snapshot", """
WITH o AS (SELECT o_custkey, o_orderstatus, o_orderdate, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS r,
  ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS latest FROM orders),
v AS (SELECT * FROM o WHERE r = 1 AND o_orderdate < TIMESTAMP '1999-01-01' UNION SELECT * FROM o WHERE latest = 1 AND o_orderdate >= TIMESTAMP '1999-01-01')
SELECT o_custkey, o_orderstatus, o_orderdate, o_orderdate AS valid_from, LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM v""")
def _(t):
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    old = S.versions(rows.filter(F.col("o_orderdate") < cut), "o_custkey", "o_orderdate", "o_orderkey").drop("o_orderkey")
    fresh = top_rows(rows.filter(F.col("o_orderdate") >= cut), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return S.maintain(old, fresh.drop("o_orderkey"), "o_custkey", "o_orderdate")


@query("stm1_running_totals", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(value) AS top FROM events GROUP BY 1""")
def _(t):
    agg = events_stream(t).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"), F.max("value").alias("top"))
    return M.updated(agg, ["event_type"], "stm1")


@query("stm2_tumbling_window", """
SELECT date_trunc('day', ts) AS window_start, event_type, COUNT(*) AS n, MAX(value) AS top, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def _(t):
    agg = M.windowed(M.timed(events_stream(t), "ts"), "ts", "1 day", None, ["event_type"],
                     n=F.count(F.lit(1)), top=F.max("value"), total=exact_sum("value"))
    return M.updated(agg, ["window_start", "event_type"], "stm2")


@query("stm3_sliding_window", """
SELECT w AS window_start, COUNT(*) AS n, ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 6) AS mean
FROM (SELECT value, date_trunc('day', ts) - INTERVAL 1 DAY * i AS w FROM events, generate_series(0, 6) g(i)) GROUP BY 1""")
def _(t):
    agg = M.windowed(M.timed(events_stream(t), "ts"), "ts", "7 days", "1 day", [], n=F.count(F.lit(1)), total=exact_sum("value"))
    out = M.updated(agg, ["window_start"], "stm3")
    return out.select("window_start", "n", F.round(F.col("total") / F.col("n"), 6).alias("mean"))


@query("stm4_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return M.appended(M.first_seen(M.timed(events_stream(t), "ts"), ["user_id", "event_type"]), "stm4")


@query("stm5_append_micro_batches", "SELECT event_id, user_id, value FROM events")
def _(t):
    held = t.events.filter("event_type = 'click'").select("event_id", "user_id", "value")
    target = sinks.scratch(t.spark, "stm5")
    held.write.parquet(f"{target}/load=first/batch=0")
    for part in (0, 1):  # two deliveries in folders of their own
        folder = sinks.scratch(t.spark, "stm5-source")
        t.events.filter(F.col("event_id") % 2 == part).write.parquet(folder)
        stream = M.read_files(t.spark, f"{folder}/", SCHEMAS["events"])
        M.append_unseen(stream.select("event_id", "user_id", "value"), target, ["event_id"])
    return t.spark.read.schema(held.schema).parquet(target).select("event_id", "user_id", "value")


@query("stm1_keyed_totals", """
SELECT user_id, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(value) AS top, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events GROUP BY 1""")
def _(t):
    changes = K.keyed_totals(events_stream(t), ["user_id"], "ts", "value")
    return K.totals_of(K.load(changes, sinks.scratch(t.spark, "stm1-keyed")), {"user_id": "bigint"})


@query("stm1_expiring_totals", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(value) AS top, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events GROUP BY 1""")
def _(t):
    folder = sinks.scratch(t.spark, "stm1-source")
    day = F.dayofmonth("ts")
    for part in (day <= 10, day > 20, (day > 10) & (day <= 20) | day.isNull()):  # the second third comes late
        t.events.filter(part).write.mode("append").parquet(folder)
    stream = M.read_files(t.spark, f"{folder}/", SCHEMAS["events"], files_per_batch=1)
    changes = K.keyed_totals(stream, ["event_type"], "ts", "value", lifetime="5 days")
    return K.totals_of(K.load(changes, sinks.scratch(t.spark, "stm1-expiring")), {"event_type": "string"}, aside=True)


@query("stm4_keyed_first", "SELECT user_id, event_type AS item, MIN(ts) AS first_ts FROM events GROUP BY 1, 2")
def _(t):
    changes = K.keyed_first(events_stream(t), "user_id", "event_type", "ts")
    return K.first_of(K.load(changes, sinks.scratch(t.spark, "stm4-keyed")), {"user_id": "bigint"})
