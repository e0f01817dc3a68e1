"""Binning, clipping, generalising, sorting and set operations."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.functions.math import clip
from sparkloom.functions.text import strip_marks
from sparkloom.operators import binning as B
from sparkloom.operators.ordered import RowNumber, over_order
from sparkloom.session import checkpointed

Q = "QUANTILE_CONT({0}, {1})"


@query("bin1_cut", """
WITH b AS (SELECT MIN(p_retailprice) AS lo, (MAX(p_retailprice) - MIN(p_retailprice)) / 5 AS w FROM part)
SELECT p_partkey, CAST(CASE WHEN p_retailprice <= lo + w * 1 THEN 0 WHEN p_retailprice <= lo + w * 2 THEN 1 WHEN p_retailprice <= lo + w * 3 THEN 2
 WHEN p_retailprice <= lo + w * 4 THEN 3 ELSE 4 END AS BIGINT) AS width_bin, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 25 THEN 'medium'
 WHEN p_size > 25 AND p_size <= 40 THEN 'large' END AS size_bin FROM part, b""")
def _(t):
    out = B.cut_width(t.part, "p_retailprice", 5, "width_bin")
    return out.select("p_partkey", "width_bin", B.cut(F.col("p_size"), [0, 10, 25, 40], ["small", "medium", "large"]).alias("size_bin"))


@query("bin2_quantile_cut", """
WITH q AS (SELECT QUANTILE_CONT(o_totalprice, 0.25) AS a, QUANTILE_CONT(o_totalprice, 0.5) AS b, QUANTILE_CONT(o_totalprice, 0.75) AS c FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 'q1' WHEN o_totalprice <= b THEN 'q2' WHEN o_totalprice <= c THEN 'q3' ELSE 'q4' END AS quartile FROM orders, q""")
def _(t):
    return B.quantile_bins(t.orders.select("o_orderkey", "o_totalprice"), [], "o_totalprice", "quartile", ["q1", "q2", "q3", "q4"]).drop("o_totalprice")


@query("bin3_clip", """
WITH q AS (SELECT QUANTILE_CONT(c_acctbal, 0.05) AS lo, QUANTILE_CONT(c_acctbal, 0.95) AS hi FROM customer)
SELECT c_custkey, LEAST(GREATEST(c_acctbal, 0), 5000) AS bounded, ROUND(LEAST(GREATEST(c_acctbal, lo), hi), 4) AS trimmed FROM customer, q""")
def _(t):
    out = B.clip_quantiles(t.customer, "c_acctbal", 0.05, 0.95, "x")
    return out.select("c_custkey", clip(F.col("c_acctbal"), 0.0, 5000.0).alias("bounded"), F.round("x", 4).alias("trimmed"))


TOP = "(SELECT p_brand, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_brand) AS r FROM part GROUP BY 1)"


@query("bin4_keep_top", f"SELECT p_partkey, CASE WHEN r <= 5 THEN p_brand ELSE 'Other' END AS brand FROM part JOIN {TOP} USING (p_brand)")
def _(t):
    return B.keep_top(t.part, "p_brand", "brand", [(5, None)]).select("p_partkey", "brand")


@query("bin5_two_levels", f"SELECT p_partkey, CASE WHEN r <= 5 THEN p_brand WHEN r <= 10 THEN 'Top10' ELSE 'Other' END AS brand FROM part JOIN {TOP} USING (p_brand)")
def _(t):
    return B.keep_top(t.part, "p_brand", "brand", [(5, None), (10, "Top10")]).select("p_partkey", "brand")


@query("bin6_substring_rules", """
SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'ring-like' WHEN contains(p_name, 'red') THEN 'reddish' WHEN contains(p_name, 's') THEN 's-word' ELSE 'other' END AS label FROM part""")
def _(t):
    rules = {"s": "s-word", "red": "reddish", "ring": "ring-like"}
    return t.part.select("p_partkey", B.by_substring(F.col("p_name"), rules, "other").alias("label"))


@query("bin7_replace_values", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'promotion' ELSE p_type END AS one, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'not large' ELSE p_type END AS many,
 CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 END AS code FROM part""")
def _(t):
    src = t.part.select("p_partkey", F.col("p_type").alias("one"), F.col("p_type").alias("many"), "p_type")
    out = src.replace("PROMO", "promotion", subset=["one"]).replace(["SMALL", "MEDIUM"], "not large", subset=["many"])
    code = B.mapped(F.col("p_type"), {"SMALL": 1, "MEDIUM": 2, "LARGE": 3}, F.lit(None).cast("int"))
    return out.select("p_partkey", "one", "many", code.alias("code"))


SIZES = ["SMALL", "MEDIUM", "LARGE", "ECONOMY", "STANDARD", "PROMO"]


@query("bin8_ordered_category", """
WITH p AS (SELECT *, list_position(['SMALL', 'MEDIUM', 'LARGE', 'ECONOMY', 'STANDARD', 'PROMO'], p_type) AS k FROM part)
SELECT p_brand, arg_max(p_type, k) AS largest, arg_min(p_type, k) AS smallest, CAST(MAX(k) AS BIGINT) AS place FROM p GROUP BY 1""")
def _(t):
    src = t.part.withColumn("k", B.category_order(F.col("p_type"), SIZES))
    return src.groupBy("p_brand").agg(F.max_by("p_type", "k").alias("largest"), F.min_by("p_type", "k").alias("smallest"),
                                      F.max("k").cast("bigint").alias("place"))


@query("srt1_several_keys", """
SELECT o_orderkey, o_orderpriority, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS place FROM orders""")
def _(t):
    src = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").withColumn("_falling", -F.col("o_totalprice"))
    placed = over_order(src, [], ["o_orderpriority", "_falling", "o_orderkey"], {"place": RowNumber()})
    return placed.drop("_falling").orderBy(F.asc("o_orderpriority"), F.desc("o_totalprice"), "o_orderkey")


@query("srt2_derived_key", """
SELECT p_partkey, p_name, ROW_NUMBER() OVER (ORDER BY right(p_name, 1), length(p_name), p_partkey) AS place FROM part""")
def _(t):
    last, size = F.expr("right(p_name, 1)"), F.length("p_name")
    src = t.part.select("p_partkey", "p_name", last.alias("_last"), size.alias("_size"))
    placed = over_order(src, [], ["_last", "_size", "p_partkey"], {"place": RowNumber()})
    return placed.select("p_partkey", "p_name", "place").orderBy(last, size, "p_partkey")


@query("srt3_next_rows", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 15")
def _(t):
    upcoming = t.orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return upcoming.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").limit(15)


LETTERS = r"\p{L}+"


@query("srt4_accent_sort", f"""
SELECT w AS word, ROW_NUMBER() OVER (ORDER BY strip_accents(w), w) AS place FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{LETTERS}')) AS w FROM documents)""")
def _(t):
    words = t.documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("word")).distinct()
    placed = over_order(checkpointed(words.withColumn("_key", strip_marks("word"))), [], ["_key", "word"], {"place": RowNumber()})
    return placed.select("word", "place")


@query("set1_union_all", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CASE o_orderstatus WHEN 'F' THEN 'ONLINE' WHEN 'O' THEN 'RETAIL' ELSE 'MOBILE' END AS channel,
 ROUND(o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 0 END, 4) AS total_amount FROM orders""")
def _(t):
    from sparkloom.plans.warehouse import multi_channel
    return multi_channel(t.orders).withColumn("total_amount", F.round("total_amount", 4))


@query("set2_union_distinct", "SELECT l_suppkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000")
def _(t):
    a = t.lineitem.filter("l_quantity > 45").select(F.col("l_suppkey").alias("k")).distinct()
    return a.union(t.supplier.filter("s_acctbal > 5000").select("s_suppkey")).distinct()


@query("set3_vertical_concat", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part""")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return a.unionByName(b, allowMissingColumns=True)


@query("set4_set_algebra", """
WITH a AS (SELECT user_id FROM events WHERE event_type = 'click' AND value > 90), b AS (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)
SELECT user_id, 'both' AS part FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL
SELECT user_id, 'one' FROM ((SELECT * FROM a EXCEPT SELECT * FROM b) UNION (SELECT * FROM b EXCEPT SELECT * FROM a))""")
def _(t):
    a = t.events.filter("event_type = 'click' AND value > 90").select("user_id").distinct()
    b = t.events.filter("event_type = 'purchase' AND value > 90").select("user_id").distinct()
    one = a.exceptAll(b).unionByName(b.exceptAll(a))
    return a.intersect(b).withColumn("part", F.lit("both")).unionByName(one.withColumn("part", F.lit("one")))


@query("set5_null_padding", """
SELECT o_orderkey AS id, o_totalprice AS amount, NULL::VARCHAR AS flag FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT l_orderkey, NULL::DOUBLE, l_returnflag FROM lineitem WHERE l_quantity = 50""")
def _(t):
    a = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"),
                                                       F.lit(None).cast("string").alias("flag"))
    b = t.lineitem.filter("l_quantity = 50").select(F.col("l_orderkey").alias("id"), F.lit(None).cast("double").alias("amount"),
                                                    F.col("l_returnflag").alias("flag"))
    return a.unionByName(b)
