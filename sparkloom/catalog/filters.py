"""Filters and conditionals."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.operators import filters as R
from sparkloom.operators.groups import exact_sum, whole

AS_OF = "1999-06-30"


@query("flt1_comparison", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= 20000")
def _(t):
    return t.orders.filter(F.col("o_totalprice") <= 20000).select("o_orderkey", "o_totalprice")


@query("flt2_and_or_not", """
SELECT p_partkey, p_size, p_type FROM part WHERE ((p_size <= 10 AND p_type = 'PROMO') OR p_size >= 45) AND NOT p_brand = 'Brand#4'""")
def _(t):
    test = ((F.col("p_size") <= 10) & (F.col("p_type") == "PROMO")) | (F.col("p_size") >= 45)
    return t.part.filter(test & ~(F.col("p_brand") == "Brand#4")).select("p_partkey", "p_size", "p_type")


@query("flt3_query_string", "SELECT p_partkey, p_size FROM part WHERE p_size < 10 AND p_brand = 'Brand#2'")
def _(t):
    limit, brand = 10, "Brand#2"
    return t.part.where(f"p_size < {limit} and p_brand = '{brand}'").select("p_partkey", "p_size")


@query("flt4_isin", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def _(t):
    return t.events.filter(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


@query("flt5_not_null", """
SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL AND lang IS NOT NULL""")
def _(t):
    both = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return both.filter(F.col("quality").isNull() & F.col("lang").isNotNull()).select("doc_id", "lang")


@query("flt6_label_slice", "SELECT DISTINCT p_name FROM part WHERE p_name >= 'b' AND p_name < 'h'")
def _(t):
    return t.part.filter((F.col("p_name") >= "b") & (F.col("p_name") < "h")).select("p_name").distinct()


@query("flt7_time_slice", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-18'""")
def _(t):
    # '2024-01-10':'2024-01-17' keeps the whole last day
    return t.events.filter((F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
                           & (F.col("ts") < F.lit("2024-01-18").cast("timestamp_ntz"))).select("event_id", "ts")


@query("flt8_positions", """
WITH p AS (SELECT o_orderkey, o_orderdate, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
SELECT o_orderkey, o_orderdate, 'head' AS part FROM p WHERE pos < 5
UNION ALL SELECT o_orderkey, o_orderdate, 'tail' FROM p WHERE pos >= (SELECT COUNT(*) FROM orders) - 5
UNION ALL SELECT o_orderkey, o_orderdate, 'slice' FROM p WHERE pos >= 100 AND pos < 110
UNION ALL SELECT o_orderkey, o_orderdate, 'every' FROM p WHERE pos % 1000 = 0""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    order = ["o_orderdate", "o_orderkey"]
    head = R.head(rows, order, 5)
    tail = R.head(rows, [F.desc(c) for c in order], 5)
    parts = {"slice": lambda p: (p >= 100) & (p < 110), "every": lambda p: p % 1000 == 0}
    return (head.withColumn("part", F.lit("head")).unionByName(tail.withColumn("part", F.lit("tail")))
            .unionByName(R.parts_at(rows, order, parts, "part")))


@query("flt9_above_mean", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice >= (SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) FROM orders)""")
def _(t):
    stats = whole(t.orders, s=exact_sum("o_totalprice"), n=F.count("o_totalprice"))
    return t.orders.filter(F.col("o_totalprice") >= stats["s"] / stats["n"]).select("o_orderkey", "o_totalprice")


@query("flt10_where_mask", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS kept, CASE WHEN value > 50 THEN 50.0 ELSE value END AS masked FROM events""")
def _(t):
    return t.events.select("event_id", R.where(F.col("value"), F.col("event_type") != "error").alias("kept"),
                           R.mask(F.col("value"), F.col("value") > 50, F.lit(50.0)).alias("masked"))


@query("flt11_case_ladder", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'high_value' WHEN o_totalprice > 100000 THEN 'medium_value' ELSE 'low_value' END AS order_tier FROM orders""")
def _(t):
    price = F.col("o_totalprice")
    return t.orders.select("o_orderkey", R.choose([(price > 400000, "high_value"), (price > 100000, "medium_value")],
                                                  "low_value").alias("order_tier"))


@query("flt12_customer_segment", """
SELECT o_custkey, CASE WHEN SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000 AND COUNT(*) > 10 THEN 'VIP'
  WHEN SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 2000000 THEN 'Premium' WHEN COUNT(*) > 5 THEN 'Frequent' ELSE 'Standard' END AS segment
FROM orders GROUP BY o_custkey""")
def _(t):
    per = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("v"), F.count(F.lit(1)).alias("n"))
    v, n = F.col("v"), F.col("n")
    return per.select("o_custkey", R.choose([((v > 3000000) & (n > 10), "VIP"), (v > 2000000, "Premium"),
                                             (n > 5, "Frequent")], "Standard").alias("segment"))


@query("flt13_recency_band", """
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1999-05-31' THEN 'recent'
  WHEN CAST(o_orderdate AS DATE) >= DATE '1999-04-01' THEN 'moderate' ELSE 'old' END AS order_recency
FROM orders""")
def _(t):
    day, as_of = F.col("o_orderdate").cast("date"), F.lit(AS_OF).cast("date")
    return t.orders.select(
        "o_orderkey", R.recency(day, as_of, [(30, "recent"), (90, "moderate")], "old").alias("order_recency"))


@query("flt14_keep_groups", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
  (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) >= 12 AND MAX(o_totalprice) > 450000)""")
def _(t):
    return R.keep_groups(t.orders, "o_custkey", (F.col("n") >= 12) & (F.col("top") > 450000),
                         n=F.count(F.lit(1)), top=F.max("o_totalprice")).select("o_orderkey", "o_custkey")


@query("flt15_bucket_counts", """
SELECT CAST(COUNT(*) FILTER (WHERE n BETWEEN 5 AND 10) AS BIGINT) AS five_to_ten, CAST(COUNT(*) FILTER (WHERE n > 10) AS BIGINT) AS over_ten
FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)""")
def _(t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count_if(F.col("n").between(5, 10)).alias("five_to_ten"), F.count_if(F.col("n") > 10).alias("over_ten"))


@query("flt16_random_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 100")
def _(t):
    return R.sample_exact(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query("flt17_cluster_sample", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN
  (SELECT c_nationkey FROM (SELECT DISTINCT c_nationkey FROM customer) ORDER BY md5('42:' || c_nationkey), c_nationkey LIMIT 5)""")
def _(t):
    return R.cluster_sample(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", 5)
