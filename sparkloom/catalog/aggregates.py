"""Aggregation."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.operators import aggregates as A
from sparkloom.operators.binning import quantile_bins
from sparkloom.operators.groups import exact_avg, exact_sum, quantiles, top_rows

SUMD = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def s(c):
    return SUMD.format(c)


def r(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("agg1_whole_column", f"""
SELECT COUNT(value) AS n, COUNT(*) AS size, COUNT(DISTINCT value) AS n_unique, ROUND({s('value')} / COUNT(value), 6) AS mean, MAX(value) AS max,
 MIN(value) AS min, {s('value')} AS sum, QUANTILE_CONT(value, 0.5) AS median FROM events""")
def _(t):
    med = quantiles(t.events, [], "value", {"m": 0.5}).scalar()
    return t.events.agg(
        F.count("value").alias("n"), F.count(F.lit(1)).alias("size"), F.count_distinct("value").alias("n_unique"),
        F.round(exact_avg("value"), 6).alias("mean"), F.max("value").alias("max"), F.min("value").alias("min"),
        exact_sum("value").alias("sum")).select("*", med.alias("median"))


@query("agg2_grouped", f"SELECT l_returnflag, l_linestatus, {s('l_extendedprice')} AS total FROM lineitem GROUP BY 1, 2")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(exact_sum("l_extendedprice").alias("total"))


@query("agg3_several_functions", f"""
SELECT p_brand, MIN(p_retailprice) AS lo, MAX(p_retailprice) AS hi, ROUND({s('p_retailprice')} / COUNT(*), 6) AS mean FROM part GROUP BY 1""")
def _(t):
    return t.part.groupBy("p_brand").agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"),
                                         F.round(exact_avg("p_retailprice"), 6).alias("mean"))


@query("agg4_function_map", f"""
SELECT l_suppkey, MIN(l_quantity) AS quantity_min, MAX(l_quantity) AS quantity_max, {s('l_extendedprice')} AS price_sum,
 COUNT(DISTINCT l_partkey) AS part_nunique FROM lineitem GROUP BY 1""")
def _(t):
    wanted = {"quantity": ("l_quantity", {"min": F.min, "max": F.max}), "price": ("l_extendedprice", {"sum": exact_sum}),
              "part": ("l_partkey", {"nunique": F.count_distinct})}
    return t.lineitem.groupBy("l_suppkey").agg(
        *[fn(col).alias(f"{name}_{label}") for name, (col, fns) in wanted.items() for label, fn in fns.items()])


STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("agg5_mean_std_per_entity", "SELECT l_partkey, " + ", ".join(
    f"ROUND(AVG({c}), 4) AS {c}_mean, ROUND(STDDEV_SAMP({c}), 4) AS {c}_std" for c in STATS)
    + " FROM lineitem GROUP BY 1 HAVING COUNT(*) >= 30")
def _(t):
    out = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), *[
        f(c).alias(f"{c}_{m}") for c in STATS for m, f in (("mean", F.avg), ("std", F.stddev_samp))])
    return out.filter("n >= 30").select("l_partkey", *[F.round(f"{c}_{m}", 4).alias(f"{c}_{m}") for c in STATS for m in ("mean", "std")])


@query("agg6_customer_summary", f"""
WITH o AS (SELECT o_custkey, COUNT(*) AS total_orders, {s('o_totalprice')} AS total_revenue, MIN(CAST(o_orderdate AS DATE)) AS first_order_date,
  MAX(CAST(o_orderdate AS DATE)) AS last_order_date FROM orders GROUP BY 1),
m AS (SELECT o_custkey, o_orderpriority, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY COUNT(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2)
SELECT c_custkey, c_name, total_orders, total_revenue, ROUND(total_revenue / total_orders, 8) AS avg_order_value, first_order_date, last_order_date,
  o_orderpriority AS primary_priority, ROUND(CASE WHEN total_revenue > 1000000 THEN total_revenue * 1.2::DOUBLE ELSE total_revenue END, 3) AS customer_lifetime_value
FROM customer JOIN o ON o.o_custkey = c_custkey JOIN m ON m.o_custkey = c_custkey AND rn = 1""")
def _(t):
    from sparkloom.plans.warehouse import customer_summary
    return customer_summary(t.orders, t.customer)


@query("agg7_union_of_channels", f"""
WITH u AS (SELECT o_custkey, {s('o_totalprice')} AS v, MAX(o_orderdate) AS d, COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus)
SELECT c_custkey, ROUND(COALESCE(SUM(v), 0), 4) AS lifetime_value, CAST(MAX(d) AS DATE) AS last_order_date, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_orders
FROM customer LEFT JOIN u ON o_custkey = c_custkey GROUP BY 1""")
def _(t):
    from sparkloom.plans.warehouse import channel_metrics
    return channel_metrics(t.orders, t.customer)


@query("agg8_quantiles", """
SELECT l_returnflag, ROUND(QUANTILE_CONT(l_extendedprice, 0.95), 4) AS p95, ROUND(QUANTILE_CONT(l_extendedprice, 0.5), 4) AS median,
 ROUND(QUANTILE_CONT(l_extendedprice, 0.1), 4) AS p10 FROM lineitem GROUP BY 1""")
def _(t):
    return r(quantiles(t.lineitem, "l_returnflag", "l_extendedprice", {"p95": 0.95, "median": 0.5, "p10": 0.1}), 4, "p95", "median", "p10")


DESCRIBE = """COUNT(value) AS n, ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value), 5) AS mean, ROUND(STDDEV_SAMP(value), 5) AS std, MIN(value) AS min,
 ROUND(QUANTILE_CONT(value, 0.25), 5) AS q25, ROUND(QUANTILE_CONT(value, 0.5), 5) AS q50, ROUND(QUANTILE_CONT(value, 0.75), 5) AS q75, MAX(value) AS max"""


@query("agg9_describe", f"SELECT event_type, {DESCRIBE} FROM events GROUP BY 1 UNION ALL SELECT 'all', {DESCRIBE} FROM events")
def _(t):
    per = A.describe(t.events, "event_type", "value", scale=2)
    whole = A.describe(t.events, [], "value", scale=2).withColumn("event_type", F.lit("all"))
    return r(per.unionByName(whole), 5, "mean", "std", "q25", "q50", "q75")


@query("agg10_value_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def _(t):
    return A.value_counts(t.events, "event_type", 3)


@query("agg11_modes", """
WITH c AS (SELECT l_suppkey, l_quantity, COUNT(*) AS n, RANK() OVER (PARTITION BY l_suppkey ORDER BY COUNT(*) DESC) AS r FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, l_quantity, n FROM c WHERE r = 1""")
def _(t):
    return A.modes(t.lineitem, "l_suppkey", "l_quantity")


@query("agg12_percent_with_word", """
SELECT lang, ROUND(COUNT(*) FILTER (WHERE contains(lower(text), 'the')) * 100.0::DOUBLE / COUNT(*), 6) AS percent_with_word FROM documents GROUP BY 1""")
def _(t):
    return t.documents.groupBy("lang").agg(F.round(A.percent_true(F.lower("text").contains("the")), 6).alias("percent_with_word"))


@query("agg13_second_to_last", """
SELECT user_id, value AS second_to_last FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 2""")
def _(t):
    last = top_rows(t.events.select("user_id", "ts", "event_id", "value"), "user_id", [F.desc("ts"), F.desc("event_id")], 2, rank_as="rn")
    return last.filter("rn = 2").select("user_id", F.col("value").alias("second_to_last"))


@query("agg14_share", "SELECT ROUND(COUNT(*) FILTER (WHERE l_quantity > 20) * 100.0::DOUBLE / COUNT(*), 6) AS percent_large FROM lineitem")
def _(t):
    return t.lineitem.agg(F.round(A.percent_true(F.col("l_quantity") > 20), 6).alias("percent_large"))


@query("agg15_count_of_counts", """
SELECT day, logins, COUNT(*) AS users FROM (SELECT CAST(ts AS DATE) AS day, user_id, COUNT(*) AS logins FROM events GROUP BY 1, 2) GROUP BY 1, 2""")
def _(t):
    per = t.events.groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("logins"))
    return per.groupBy("day", "logins").agg(F.count(F.lit(1)).alias("users"))


@query("agg16_mean_of_totals", f"SELECT ROUND({s('v')} / COUNT(*), 2) AS mean_total FROM (SELECT o_custkey, {s('o_totalprice')} AS v FROM orders GROUP BY 1)")
def _(t):
    per = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("v"))
    return per.agg(F.round(exact_avg("v"), 2).alias("mean_total"))


@query("agg17_string_list", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def _(t):
    # distinct first: a list then holds at most the few codes of the column
    codes = t.orders.select("o_custkey", "o_orderpriority").distinct()
    return codes.groupBy("o_custkey").agg(A.concat_ordered("o_orderpriority", "o_orderpriority", ",").alias("priorities"))


@query("agg18_hash_key", """
SELECT c, key_list, sha256(key_list) AS hash_key FROM (SELECT o_custkey AS c, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS key_list FROM orders GROUP BY 1)""")
def _(t):
    codes = t.orders.select(F.col("o_custkey").alias("c"), "o_orderstatus").distinct()
    lists = codes.groupBy("c").agg(A.concat_ordered("o_orderstatus", "o_orderstatus", ",").alias("key_list"))
    return lists.withColumn("hash_key", F.sha2("key_list", 256))


@query("agg19_ratio_top", """
SELECT o_orderkey, ROUND(o_totalprice / n, 4) AS per_supplier FROM orders JOIN (SELECT l_orderkey, COUNT(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
ORDER BY o_totalprice / n DESC, o_orderkey LIMIT 5""")
def _(t):
    staff = t.lineitem.groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("n"))
    ratio = t.orders.join(staff, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", (F.col("o_totalprice") / F.col("n")).alias("x"))
    return ratio.orderBy(F.desc("x"), "o_orderkey").limit(5).select("o_orderkey", F.round("x", 4).alias("per_supplier"))


@query("agg20_null_counts", "SELECT COUNT(*) AS documents, COUNT(quality) AS assigned, COUNT(*) - COUNT(quality) AS unassigned FROM documents LEFT JOIN labels USING (doc_id)")
def _(t):
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return both.agg(F.count(F.lit(1)).alias("documents"), F.count("quality").alias("assigned"),
                    F.count_if(F.col("quality").isNull()).alias("unassigned"))


@query("agg21_string_sum", """
SELECT conv_id, CAST((rn - 1) // 20 AS BIGINT) AS block, string_agg(substr(role, 1, 1), '' ORDER BY rn) AS turns
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations) GROUP BY 1, 2""")
def _(t):
    letters = t.conversations.withColumn("letter", F.substring("role", 1, 1))
    return A.concat_blocks(letters, "conv_id", ["turn", "role", "text"], "letter", "turns", block=20)


@query("agg22_extreme_row", """
SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders GROUP BY 1""")
def _(t):
    key = F.struct("o_totalprice", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", key).alias("dearest"), F.min_by("o_orderkey", key).alias("cheapest"))


@query("agg23_correlation", "SELECT l_returnflag, ROUND(CORR(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


@query("agg24_histogram", """
WITH b AS (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders)
SELECT CAST(LEAST(FLOOR((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin, COUNT(*) AS n FROM orders, b GROUP BY 1""")
def _(t):
    return A.histogram(t.orders, "o_totalprice", 20)


@query("agg25_box_statistics", """
WITH q AS (SELECT l_linestatus, QUANTILE_CONT(l_quantity, 0.25) AS q25, QUANTILE_CONT(l_quantity, 0.5) AS q50, QUANTILE_CONT(l_quantity, 0.75) AS q75 FROM lineitem GROUP BY 1)
SELECT *, q75 - q25 AS iqr FROM q""")
def _(t):
    return quantiles(t.lineitem, "l_linestatus", "l_quantity", A.QUARTILES).withColumn("iqr", F.col("q75") - F.col("q25"))


@query("agg26_share_within", """
WITH m AS (SELECT CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS m, STDDEV_POP(c_acctbal) AS s FROM customer)
SELECT ROUND(AVG((ABS(c_acctbal - m) < 1 * s)::INT), 6) AS within_1, ROUND(AVG((ABS(c_acctbal - m) < 2 * s)::INT), 6) AS within_2,
 ROUND(AVG((ABS(c_acctbal - m) < 3 * s)::INT), 6) AS within_3 FROM customer, m""")
def _(t):
    return r(A.share_within(t.customer, "c_acctbal", [1, 2, 3], scale=2), 6, "within_1", "within_2", "within_3")


@query("agg27_group_by_function", f"""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, CAST(MONTH(o_orderdate) AS INTEGER) AS month, {s('o_totalprice')} AS total FROM orders GROUP BY 1, 2""")
def _(t):
    parity = F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("parity")
    return t.orders.groupBy(parity, F.month("o_orderdate").alias("month")).agg(exact_sum("o_totalprice").alias("total"))


@query("agg28_bucket_in_group", f"""
WITH q AS (SELECT event_type, QUANTILE_CONT(value, 1/3) AS a, QUANTILE_CONT(value, 2/3) AS b FROM events GROUP BY 1)
SELECT e.event_type, CASE WHEN value <= a THEN 'low' WHEN value <= b THEN 'mid' ELSE 'high' END AS bucket, COUNT(*) AS n, {s('value')} AS total
FROM events e JOIN q USING (event_type) GROUP BY 1, 2""")
def _(t):
    cut = quantile_bins(t.events.select("event_type", "value"), "event_type", "value", "bucket", labels=["low", "mid", "high"])
    return cut.groupBy("event_type", "bucket").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))
