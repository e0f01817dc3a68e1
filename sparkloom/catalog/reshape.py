"""Pivot, cross-tab, melt and dummy columns."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.operators import reshape as R
from sparkloom.operators.groups import exact_sum

STATUS = ["F", "O", "P"]
STATUS_TESTS = {**{s: f"o_orderstatus = '{s}'" for s in STATUS}, "other": "o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')"}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
D = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) {0} AS DOUBLE)"


def count_if(test):
    return f"CAST(COUNT(*) FILTER (WHERE {test}) AS BIGINT)"


@query("pvt1_pivot_table", "SELECT o_orderpriority, " + ", ".join(
    D.format(f"FILTER (WHERE {test})") + f' AS "{name}"' for name, test in STATUS_TESTS.items()) + " FROM orders GROUP BY 1")
def _(t):
    return R.pivot(t.orders, "o_orderpriority", "o_orderstatus", STATUS, exact_sum("o_totalprice"))


@query("pvt2_unstack", """SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS y, """ + ", ".join(
    f"{count_if(test)} AS n_{name}" for name, test in STATUS_TESTS.items()) + " FROM orders GROUP BY 1")
def _(t):
    per = t.orders.groupBy(F.year("o_orderdate").alias("y"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    wide = R.pivot(per, "y", "o_orderstatus", STATUS, F.sum("n"))
    return wide.na.fill(0).withColumnsRenamed({s: f"n_{s}" for s in STATUS_TESTS})


@query("pvt3_crosstab", "SELECT l_returnflag || '/' || l_linestatus AS row, " + ", ".join(
    f"{count_if(f'l_linenumber = {i}')} AS \"{i}\"" for i in range(1, 8))
    + f", {count_if('l_linenumber IS NULL OR l_linenumber > 7 OR l_linenumber < 1')} AS other FROM lineitem GROUP BY 1")
def _(t):
    label = F.concat_ws("/", "l_returnflag", "l_linestatus")
    return R.crosstab(t.lineitem, label, "l_linenumber", list(range(1, 8)))


@query("pvt4_crosstab_totals", "SELECT COALESCE(event_type, 'All') AS event_type, " + ", ".join(
    count_if(f"d = '{d}'") + f' AS "{d}"' for d in ("low", "high")) + """, CAST(0 AS BIGINT) AS other, COUNT(*) AS "All"
FROM (SELECT event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS d FROM events) GROUP BY ROLLUP (event_type)""")
def _(t):
    src = t.events.select("event_type", F.when(F.col("value") > 50, "high").otherwise("low").alias("d"))
    return R.crosstab_totals(src, "event_type", "d", ["low", "high"])


@query("pvt5_crosstab_shares", """
WITH c AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, o_orderpriority, ROUND(n / SUM(n) OVER (), 6) AS of_all, ROUND(n / SUM(n) OVER (PARTITION BY o_orderpriority), 6) AS of_column,
 ROUND(n / SUM(n) OVER (PARTITION BY o_orderstatus), 6) AS of_row FROM c""")
def _(t):
    shares = R.crosstab_shares(t.orders, "o_orderstatus", "o_orderpriority")
    return shares.withColumns({c: F.round(c, 6) for c in ("of_all", "of_column", "of_row")})


@query("pvt6_melt", """
SELECT p_partkey, 'size' AS measure, CAST(p_size AS DOUBLE) AS amount FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part""")
def _(t):
    src = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return R.melt(src, ["p_partkey"], ["size", "price"], "measure", "amount")


@query("pvt7_unmelt", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part")
def _(t):
    src = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    long = R.melt(src, ["p_partkey"], ["size", "price"], "measure", "amount")
    return R.unmelt(long, ["p_partkey"], "measure", "amount", ["size", "price"])


@query("pvt8_transpose_head", """
WITH h AS (SELECT ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS i, CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice FROM orders)
SELECT 'o_orderkey' AS key, MAX(o_orderkey) FILTER (i = 1) AS r1, MAX(o_orderkey) FILTER (i = 2) AS r2, MAX(o_orderkey) FILTER (i = 3) AS r3 FROM h WHERE i <= 3
UNION ALL SELECT 'o_totalprice', MAX(o_totalprice) FILTER (i = 1), MAX(o_totalprice) FILTER (i = 2), MAX(o_totalprice) FILTER (i = 3) FROM h WHERE i <= 3""")
def _(t):
    top = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3)
    price = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey"))).alias("a"))
    named = top.withColumn("i", F.concat(F.lit("r"), F.array_position(price.scalar(), F.struct(
        (-F.col("o_totalprice")).alias("p"), "o_orderkey")).cast("string")))
    rows = named.select("i", F.col("o_orderkey").cast("double").alias("o_orderkey"), "o_totalprice")
    return R.transpose_head(rows, [F.desc("o_totalprice"), "o_orderkey"], "i", 3)


@query("pvt9_stack_levels", """
WITH a AS (SELECT l_returnflag, MIN(l_quantity) AS q0, MAX(l_quantity) AS q1, MIN(l_tax) AS t0, MAX(l_tax) AS t1 FROM lineitem GROUP BY 1)
SELECT l_returnflag, 'min' AS level, q0 AS quantity, t0 AS tax FROM a UNION ALL SELECT l_returnflag, 'max', q1, t1 FROM a""")
def _(t):
    flat = t.lineitem.groupBy("l_returnflag").agg(
        F.min("l_quantity").alias("quantity_min"), F.max("l_quantity").alias("quantity_max"),
        F.min("l_tax").alias("tax_min"), F.max("l_tax").alias("tax_max"))
    return flat.select("l_returnflag", F.stack(
        F.lit(2), F.lit("min"), "quantity_min", "tax_min", F.lit("max"), "quantity_max", "tax_max").alias("level", "quantity", "tax"))


@query("pvt10_dummies", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS status_{s}" for s in STATUS)
    + ", CASE WHEN o_orderstatus NOT IN ('F', 'O', 'P') THEN 1 ELSE 0 END AS status_other FROM orders")
def _(t):
    return R.dummies(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", STATUS, "status_").drop("o_orderstatus")


@query("pvt11_undummy", f"""SELECT o_orderkey, CASE WHEN o_orderpriority IN {tuple(PRIORITIES)} THEN o_orderpriority
  WHEN o_orderpriority IS NOT NULL THEN 'other' END AS priority FROM orders""")
def _(t):
    flags = R.dummies(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITIES, "p_").drop("o_orderpriority")
    return R.undummy(flags, "p_", PRIORITIES, "priority").select("o_orderkey", "priority")


@query("pvt12_character_counts", """
SELECT doc_id, character, COUNT(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?s).')) AS character FROM documents) GROUP BY 1, 2""")
def _(t):
    return R.character_counts(t.documents, "doc_id", "text")
