"""Joins."""

from pyspark.sql import functions as F

from sparkloom.catalog.games_sql import GAMES
from sparkloom.catalog.registry import query
from sparkloom.operators import joins as J
from sparkloom.operators.groups import exact_avg, exact_sum, with_group
from sparkloom.plans import games as G
from sparkloom.plans import snapshots as S


@query("jn1_inner_join", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def _(t):
    rich = t.customer.filter("c_acctbal > 5000").select("c_custkey", "c_name")
    return t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("jn2_left_join", "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


@query("jn3_star_join", """
SELECT c_mktsegment, COUNT(*) AS n_orders, ROUND(CAST(SUM(v) AS DOUBLE) / COUNT(*), 4) AS avg_order_value, ROUND(SUM(o_totalprice_d)::DOUBLE, 4) AS price_total
FROM (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1) l
JOIN (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice_d FROM orders) ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def _(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(exact_sum("l_extendedprice").alias("amount_line"))
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount_order"))
    star = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")))
    return star.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(exact_avg("amount_line"), 4).alias("avg_order_value"),
        F.round(exact_sum("amount_order"), 4).alias("price_total"))


@query("jn4_anti_join", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(t):
    return t.orders.select("o_orderkey").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("jn5_computed_key", """
SELECT n_name, COUNT(*) AS n_docs FROM documents JOIN nation ON n_nationkey = TRY_CAST(NULLIF(substr(source, 4), '') AS INTEGER) GROUP BY 1""")
def _(t):
    key = F.nullif(F.expr("substring(source, 4)"), F.lit("")).try_cast("int")
    per = t.documents.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n_docs"))
    return per.join(t.nation, F.col("k") == F.col("n_nationkey")).select("n_name", "n_docs")


@query("jn6_in_not_in", """
SELECT o_orderkey, 'in' AS test FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT o_orderkey, 'not in' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 9000)
UNION ALL SELECT o_orderkey, 'null' FROM orders WHERE o_custkey NOT IN (SELECT NULLIF(c_custkey, 0) FROM customer)""")
def _(t):
    low = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    inside = t.orders.join(low, "o_custkey", "left_semi").select("o_orderkey", F.lit("in").alias("test"))
    out = J.not_in(t.orders, "o_custkey", t.customer.filter("c_acctbal < 9000"), "c_custkey")
    none = J.not_in(t.orders, "o_custkey", t.customer.select(F.nullif("c_custkey", F.lit(0)).alias("k")), "k")
    return (inside.unionByName(out.select("o_orderkey", F.lit("not in").alias("test")))
            .unionByName(none.select("o_orderkey", F.lit("null").alias("test"))))


@query("jn7_join_derived", """
SELECT c_name, n, total FROM customer JOIN (SELECT o_custkey, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE n > 12""")
def _(t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))
    return per.filter("n > 12").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "n", "total")


@query("jn8_above_group_mean", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem a WHERE l_extendedprice >
  (SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) FROM lineitem b WHERE b.l_partkey = a.l_partkey)""")
def _(t):
    rows = with_group(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), "l_partkey",
                      mean=exact_avg("l_extendedprice"))
    return rows.filter("l_extendedprice > mean").drop("mean")


@query("jn9_home_away_pairs", GAMES + """
SELECT h.game_id, h.team_id AS home_team_id, h.pts AS home_pts, a.team_id AS away_team_id, a.pts AS away_pts
FROM games h JOIN games a USING (game_id) WHERE h.home_flag = 1 AND a.home_flag = 0""")
def _(t):
    return J.role_pairs(G.team_games(t.lineitem, t.orders), ["game_id"], F.col("home_flag") == 1,
                        ["team_id", "pts"], ["team_id", "pts"], "home_", "away_")


@query("jn10_link_list", """
WITH l AS (SELECT p_partkey, i, CASE i WHEN 1 THEN p_size WHEN 2 THEN p_size * 2 ELSE p_partkey % 7 END AS id FROM part, (VALUES (1), (2), (3)) v(i))
SELECT p.p_partkey, x.names AS speakers, n.n_name AS venue
FROM part p LEFT JOIN (SELECT p_partkey, string_agg(s_name, ';' ORDER BY i) AS names FROM l JOIN supplier ON s_suppkey = id GROUP BY 1) x ON x.p_partkey = p.p_partkey
LEFT JOIN nation n ON n.n_nationkey = p.p_size""")
def _(t):
    talks = t.part.select("p_partkey", "p_size", F.array(
        F.col("p_size").cast("bigint"), (F.col("p_size") * 2).cast("bigint"), F.col("p_partkey") % 7).alias("ids"))
    linked = J.link_list(talks, "p_partkey", "ids", t.supplier, "s_suppkey", "s_name", "names")
    return linked.join(t.nation, F.col("p_size") == F.col("n_nationkey"), "left").select(
        "p_partkey", F.array_join("names", ";").alias("speakers"), F.col("n_name").alias("venue"))


@query("jn11_match_rate", """
WITH r AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'),
a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase')
SELECT ROUND(COUNT(a.user_id) / COUNT(*), 4) AS rate FROM r LEFT JOIN a ON r.user_id = a.user_id AND r.day = a.day""")
def _(t):
    days = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return J.match_rate(days.filter("event_type = 'click'").select("user_id", "day").distinct(),
                        days.filter("event_type = 'purchase'"), ["user_id", "day"], 4)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("jn12_product", """
SELECT n_name, a.s AS segment, b.s AS other_segment, COUNT(c_custkey) AS customers FROM nation
CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS s) a
CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS s) b
LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = a.s GROUP BY 1, 2, 3""")
def _(t):
    segments = J.held_values(t.customer, "c_mktsegment", SEGMENTS)
    grid = J.product_with_values(t.nation, segments, "segment")
    grid = J.product_with_values(grid, segments, "other_segment")
    per = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    same = (F.col("n_nationkey") == F.col("c_nationkey")) & F.col("segment").eqNullSafe(F.col("c_mktsegment"))
    return grid.join(per, same, "left").select(
        "n_name", "segment", "other_segment", F.coalesce("n", F.lit(0)).alias("customers"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("jn13_pairs", """
WITH d AS (SELECT DISTINCT o_custkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
  THEN o_orderpriority ELSE 'other' END AS p FROM orders),
v AS (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', 'other']) AS p)
SELECT 'combination' AS kind, x.p AS a, y.p AS b, (SELECT COUNT(*) FROM d m JOIN d n ON m.o_custkey = n.o_custkey WHERE m.p = x.p AND n.p = y.p) AS n
FROM v x, v y WHERE x.p < y.p UNION ALL
SELECT 'permutation', x.p, y.p, (SELECT COUNT(*) FROM d m JOIN d n ON m.o_custkey = n.o_custkey WHERE m.p = x.p AND n.p = y.p) FROM v x, v y WHERE x.p <> y.p""")
def _(t):
    combos = J.pair_counts(t.orders, "o_custkey", "o_orderpriority", PRIORITIES, rest="other")
    perms = J.pair_counts(t.orders, "o_custkey", "o_orderpriority", PRIORITIES, ordered=True, rest="other")
    return (combos.select(F.lit("combination").alias("kind"), "a", "b", "n")
            .unionByName(perms.select(F.lit("permutation").alias("kind"), "a", "b", "n")))


@query("jn15_latest_effective", """
WITH x AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS effective_date,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) + 200 END AS expiration_date,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_totalprice > 50000)
SELECT c_custkey, c_name, o_orderpriority AS code, effective_date, expiration_date FROM customer JOIN x ON o_custkey = c_custkey
WHERE rn = 1 AND (expiration_date IS NULL OR expiration_date > DATE '2001-08-01')""")
def _(t):
    rows = t.orders.select(
        "o_custkey", "o_orderkey", F.col("o_orderpriority").alias("code"), F.col("o_orderdate").cast("date").alias("effective_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), 200)).alias("expiration_date"),
        (F.col("o_totalprice") > 50000).alias("is_active"))
    live = J.latest_effective(rows, "o_custkey", ["effective_date", "o_orderkey"], "expiration_date",
                              F.lit("2001-08-01").cast("date"), F.col("is_active"))
    return live.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "code", "effective_date", "expiration_date")


@query("jn15_effective_at_order", """
WITH x AS (SELECT o_custkey AS k, o_orderdate AS effective, o_orderpriority AS code,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 200 DAY END AS expires FROM orders WHERE o_totalprice > 50000
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN expires IS NULL OR expires > o_orderdate THEN code END AS code,
    CASE WHEN expires IS NULL OR expires > o_orderdate THEN effective END AS effective
FROM orders ASOF LEFT JOIN x ON o_custkey = k AND o_orderdate >= effective""")
def _(t):
    date = F.col("o_orderdate")
    crosswalk = t.orders.filter("o_totalprice > 50000").select(
        "o_custkey", "o_orderkey", date.alias("effective"), F.col("o_orderpriority").alias("code"),
        F.when(F.col("o_orderstatus") != "P", date + F.expr("INTERVAL 200 DAYS")).alias("expires"))
    return J.as_of_join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), crosswalk, ["o_custkey"], "o_orderdate",
                        "effective", ["code", "effective"], until="expires", tie="o_orderkey")


@query("jn16_rows_at_own_time", """
WITH v AS (SELECT user_id AS u, ts AS since, value AS last_value, event_id AS last_id FROM events WHERE event_type = 'purchase'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT event_id, user_id, ts, last_value, last_id FROM events ASOF LEFT JOIN v ON user_id = u AND ts >= since""")
def _(t):
    bought = t.events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("since"), F.col("value").alias("last_value"), F.col("event_id").alias("last_id"))
    return J.as_of_join(t.events.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "since",
                        ["last_value", "last_id"], tie="last_id")


@query("jn16_point_in_time", """
WITH o AS (SELECT o_custkey, o_orderdate, o_orderstatus, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS r FROM orders),
v AS (SELECT *, LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM o WHERE r = 1)
SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from, valid_to FROM v
WHERE o_orderdate <= TIMESTAMP '1998-06-30' AND (valid_to IS NULL OR TIMESTAMP '1998-06-30' < valid_to)""")
def _(t):
    snap = S.versions(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), "o_custkey", "o_orderdate", "o_orderkey")
    return J.as_of(snap, F.lit("1998-06-30").cast("timestamp_ntz")).select("o_custkey", "o_orderstatus", "valid_from", "valid_to")
