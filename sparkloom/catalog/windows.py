"""Window functions; ordered ones run through ``over_order``, which splits large groups."""

from pyspark.sql import functions as F

from sparkloom.catalog.games_sql import PCTG
from sparkloom.catalog.registry import query
from sparkloom.operators.dedup import runs
from sparkloom.operators.groups import exact_avg, exact_sum, ranked, top_rows, units, with_group
from sparkloom.operators.ordered import Rolling, RowNumber, Running, Shift, over_order
from sparkloom.session import checkpointed
from sparkloom.plans import games as G

BY, ORDER = "user_id", ["ts", "event_id"]
W = "(PARTITION BY user_id ORDER BY ts, event_id"


def cents(df, col="value", out="cents"):
    """The amount as whole cents: running sums of it are exact."""
    return df.withColumn(out, units(col))


@query("win1_latest_per_key", """
SELECT user_id, event_id, ts, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _(t):
    return top_rows(t.events.select("user_id", "event_id", "ts", "event_type"), "user_id", [F.desc("ts"), F.desc("event_id")])


@query("win2_ranks", """
SELECT p_partkey, p_brand, RANK() OVER w + (COUNT(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS rank_avg, RANK() OVER w AS rank_min, DENSE_RANK() OVER w AS rank_dense
FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size)""")
def _(t):
    return ranked(t.part.select("p_partkey", "p_brand", "p_size"), "p_brand", "p_size").drop("p_size")


@query("win3_running_sum", f"""
SELECT event_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER {W} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM events""")
def _(t):
    out = over_order(cents(t.events), BY, ORDER, {"run": Running("sum", "cents")})
    return out.select("event_id", (F.col("run") / 100).alias("running"))


@query("win4_running_others", f"""
SELECT event_id, MIN(value) OVER w AS lo, MAX(value) OVER w AS hi, ROUND(PRODUCT(1 + value / 1000) OVER w, 6) AS product,
 ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(*) OVER w, 6) AS mean
FROM events WINDOW w AS {W} ROWS UNBOUNDED PRECEDING)""")
def _(t):
    src = cents(t.events).withColumn("factor", 1 + F.col("value") / 1000)
    out = over_order(src, BY, ORDER, {"lo": Running("min", "value"), "hi": Running("max", "value"),
                                      "p": Running("product", "factor"), "s": Running("sum", "cents"), "n": RowNumber()})
    return out.select("event_id", "lo", "hi", F.round("p", 6).alias("product"), F.round(F.col("s") / 100 / F.col("n"), 6).alias("mean"))


@query("win5_bought_before", """
SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth,
 ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1 AS before FROM events""")
def _(t):
    out = over_order(t.events, ["user_id", "event_type"], ORDER, {"nth": RowNumber()})
    return out.select("event_id", "nth", (F.col("nth") > 1).alias("before"))


@query("win6_lag_lead", f"SELECT event_id, LAG(value) OVER {W}) AS previous, LEAD(value) OVER {W}) AS next FROM events")
def _(t):
    return over_order(t.events, BY, ORDER, {"previous": Shift("value"), "next": Shift("value", -1)}).select("event_id", "previous", "next")


@query("win7_days_since", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - CAST(LAG(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) AS INTEGER) AS days FROM orders""")
def _(t):
    out = over_order(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], {"last": Shift("o_orderdate")})
    return out.select("o_orderkey", F.date_diff("o_orderdate", "last").alias("days"))


@query("win8_rolling_mean", f"""
SELECT event_id, ROUND(AVG(value) OVER {W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 5) AS rolling FROM events""")
def _(t):
    return over_order(t.events, BY, ORDER, {"r": Rolling("avg", "value", 3)}).select("event_id", F.round("r", 5).alias("rolling"))


@query("win9_rolling_full_frame", f"""
SELECT event_id, CASE WHEN COUNT(value) OVER w = 5 THEN ROUND(AVG(value) OVER w, 5) END AS mean, CASE WHEN COUNT(value) OVER w = 5 THEN ROUND(STDDEV_SAMP(value) OVER w, 5) END AS std
FROM events WINDOW w AS {W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def _(t):
    out = over_order(t.events, BY, ORDER, {"m": Rolling("avg", "value", 5, 5), "s": Rolling("stddev", "value", 5, 5)})
    return out.select("event_id", F.round("m", 5).alias("mean"), F.round("s", 5).alias("std"))


@query("win10_group_value", """
SELECT event_id, COUNT(*) OVER w AS size, ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(*) OVER w, 6) AS mean,
 CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total FROM events WINDOW w AS (PARTITION BY event_type)""")
def _(t):
    out = with_group(t.events.select("event_id", "event_type", "value"), "event_type", size=F.count(F.lit(1)),
                     mean=F.round(exact_avg("value"), 6), total=exact_sum("value"))
    return out.select("event_id", "size", "mean", "total")


@query("win11_percent_of_total", """
SELECT o_orderkey, ROUND(o_totalprice / CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE), 6) AS share FROM orders""")
def _(t):
    out = with_group(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", total=exact_sum("o_totalprice"))
    return out.select("o_orderkey", F.round(F.try_divide(F.col("o_totalprice"), F.col("total")), 6).alias("share"))


@query("win12_running_win_share", PCTG.format(plus=0) + """
SELECT game_id, team_id, ROUND(home_win_pctg, 6) AS home_win_pctg, ROUND(away_win_pctg, 6) AS away_win_pctg, ROUND(total_win_pctg, 6) AS total_win_pctg FROM pct""")
def _(t):
    out = G.win_percentages(checkpointed(G.team_games(t.lineitem, t.orders)))
    return out.select("game_id", "team_id", *[F.round(c, 6).alias(c) for c in ("home_win_pctg", "away_win_pctg", "total_win_pctg")])


@query("win13_top_shared_ranks", """
WITH c AS (SELECT event_type, user_id, COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2)
SELECT event_type, user_id, n, place FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY event_type ORDER BY n DESC) AS place FROM c) WHERE place <= 3""")
def _(t):
    week = t.events.filter((F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    counts = week.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counts, "event_type", [F.desc("n")], 3, ties="dense", rank_as="place")


@query("win14_nth_largest", """
SELECT l_suppkey, l_extendedprice AS fifth FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 5""")
def _(t):
    top = top_rows(t.lineitem.select("l_suppkey", "l_extendedprice"), "l_suppkey", [F.desc("l_extendedprice")], 5, rank_as="rn")
    return top.filter("rn = 5").select("l_suppkey", F.col("l_extendedprice").alias("fifth"))


@query("win15_runs", f"""
WITH s AS (SELECT *, CASE WHEN LAG(event_type) OVER {W}) IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS c FROM events),
r AS (SELECT *, SUM(c) OVER {W} ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, COUNT(*) AS n FROM r GROUP BY 1, 2, 3""")
def _(t):
    out = runs(t.events.select("user_id", "ts", "event_id", "event_type"), BY, ORDER, "event_type")
    return out.groupBy("user_id", "run", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("win16_pairwise", f"""
SELECT user_id, event_type AS a, b, COUNT(*) AS n FROM (SELECT *, LEAD(event_type) OVER {W}) AS b FROM events) WHERE b IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    out = over_order(t.events.select("user_id", "ts", "event_id", "event_type"), BY, ORDER, {"b": Shift("event_type", -1)})
    return out.filter("b IS NOT NULL").groupBy("user_id", F.col("event_type").alias("a"), "b").agg(F.count(F.lit(1)).alias("n"))


@query("win17_running_confusion", """
WITH p AS (SELECT doc_id, quality AS truth, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS pred FROM labels JOIN documents USING (doc_id)),
c AS (SELECT doc_id, SUM(pred * truth) OVER w AS tp, SUM((1 - pred) * (1 - truth)) OVER w AS tn, SUM(pred * (1 - truth)) OVER w AS fp,
  SUM((1 - pred) * truth) OVER w AS fn FROM p WINDOW w AS (ORDER BY doc_id ROWS UNBOUNDED PRECEDING))
SELECT doc_id, CAST(tp AS BIGINT) AS tp, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
 ROUND((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, CASE WHEN tp + fp > 0 THEN ROUND(tp / (tp + fp), 6) END AS precision FROM c""")
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), (F.col("n_chars") > 400).cast("int").alias("p"))
    y, p = F.col("y"), F.col("p")
    hits = rows.withColumns({"_tp": p * y, "_tn": (1 - p) * (1 - y), "_fp": p * (1 - y), "_fn": (1 - p) * y})
    run = over_order(checkpointed(hits), [], "doc_id", {c: Running("sum", "_" + c) for c in ("tp", "tn", "fp", "fn")})
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return run.select("doc_id", "tp", "tn", "fp", "fn",
                      F.round(F.try_divide((tp + tn).cast("double"), tp + tn + fp + fn), 6).alias("accuracy"),
                      F.round(F.try_divide(tp.cast("double"), tp + fp), 6).alias("precision"))


@query("win19_currently_never", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS current_type, bool_or(event_type = 'signup') AS ever_signup,
 arg_max(event_type, (ts, event_id)) = 'purchase' AND NOT bool_or(event_type = 'error' AND value > 95) AS currently_and_never FROM events GROUP BY 1""")
def _(t):
    per = t.events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("current_type"),
        F.bool_or(F.col("event_type") == "signup").alias("ever_signup"),
        F.bool_or((F.col("event_type") == "error") & (F.col("value") > 95)).alias("bad"))
    return per.select("user_id", "current_type", "ever_signup",
                      ((F.col("current_type") == "purchase") & ~F.col("bad")).alias("currently_and_never"))
