"""Projection, column and schema operators."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.functions.math import charge, discounted
from sparkloom.operators import columns as C


@query("prj1_select", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("prj2_computed_columns", """
SELECT p_partkey, p_retailprice, ROUND(p_retailprice * 1.1, 4) AS marked, ROUND(p_retailprice * 1.1 - p_retailprice, 4) AS uplift FROM part""")
def _(t):
    marked = t.part.select("p_partkey", "p_retailprice", (F.col("p_retailprice") * F.lit(1.1)).alias("m"))
    return marked.select("p_partkey", "p_retailprice", F.round("m", 4).alias("marked"),
                         F.round(F.col("m") - F.col("p_retailprice"), 4).alias("uplift"))


@query("prj3_drop_column", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def _(t):
    return t.supplier.drop("s_acctbal")


@query("prj4_rename", "SELECT c_custkey AS id, c_name AS customer_name, c_acctbal AS balance, c_nationkey, c_mktsegment FROM customer")
def _(t):
    dotted = C.rename_by(t.customer, lambda c: c.replace("_", "."))
    plain = C.rename_by(dotted, lambda c: c.replace(".", "_"))
    return (plain.withColumnRenamed("c_custkey", "id")
            .withColumnsRenamed({"c_name": "customer_name", "c_acctbal": "balance"}))


@query("prj5_prefix_columns", "SELECT o_orderkey, o_orderdate, o_custkey AS home_o_custkey, o_totalprice AS home_o_totalprice FROM orders")
def _(t):
    return C.prefix_columns(t.orders.select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice"),
                            "home_", ["o_orderkey", "o_orderdate"])


@query("prj6_select_dtypes", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(t):
    return C.select_dtypes(t.part)


@query("prj7_select_by_name", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def _(t):
    return C.select_like(C.select_like(t.lineitem, regex="key$"), like="l_")


@query("prj8_repeated_names", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(t):
    return C.drop_repeated_names(t.customer.selectExpr(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal AS c_custkey", "c_mktsegment AS c_name"))


@query("prj9_sort_columns", "SELECT p_brand, p_name, p_partkey, p_retailprice, p_size, p_type FROM part")
def _(t):
    return C.sort_columns(t.part)


@query("prj10_cast", """
SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS quantity, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
       CAST(l_linenumber AS DOUBLE) AS line, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", F.col("l_quantity").cast("int").alias("quantity"),
                             F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
                             F.col("l_linenumber").cast("double").alias("line"),
                             F.col("l_shipdate").cast("date").alias("ship_day"))


@query("prj11_safe_cast", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, TRY_CAST(substr(o_orderpriority, 3, 1) AS INTEGER) AS no_level FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.try_cast(F.substring("o_orderpriority", 1, 1), "int").alias("level"),
                           C.try_cast(F.substring("o_orderpriority", 3, 1), "int").alias("no_level"))


@query("prj12_row_wise", """
SELECT l_orderkey, l_linenumber, l_partkey,
       ROUND(greatest(l_quantity, q, l_tax) - least(l_quantity, q, l_tax), 4) AS spread,
       ROUND(l_quantity + COALESCE(q, 0) + l_tax, 4) AS row_total,
       ROUND((l_quantity + COALESCE(q, 0) + l_tax) / (2 + CASE WHEN q IS NULL THEN 0 ELSE 1 END), 4) AS row_mean
FROM (SELECT *, CASE WHEN l_discount > 0 THEN l_discount END AS q FROM lineitem)""")
def _(t):
    src = t.lineitem.withColumn("q", F.when(F.col("l_discount") > 0, F.col("l_discount")))
    cols = ("l_quantity", "q", "l_tax")
    return src.select("l_orderkey", "l_linenumber", "l_partkey", F.round(C.row_range(*cols), 4).alias("spread"),
                      F.round(C.row_sum(*cols), 4).alias("row_total"), F.round(C.row_mean(*cols), 4).alias("row_mean"))


@query("prj13_pipe_steps", "SELECT o_orderkey, UPPER(TRIM(o_orderstatus)) AS status, YEAR(o_orderdate)::INTEGER AS y FROM orders WHERE o_totalprice > 100000")
def _(t):
    def clean(df):
        return df.withColumn("status", F.upper(F.trim("o_orderstatus")))

    def dated(df):
        return df.withColumn("y", F.year("o_orderdate"))

    return t.orders.transform(clean).transform(dated).filter("o_totalprice > 100000").select("o_orderkey", "status", "y")


@query("prj14_arithmetic", """
SELECT l_orderkey, l_linenumber, l_partkey, ROUND(l_extendedprice * (1 - l_discount), 4) AS net,
       ROUND(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(discounted(), 4).alias("net"),
                             F.round(charge(), 6).alias("charge"))


@query("prj15_aligned_add", """
SELECT COALESCE(a.custkey, b.custkey) AS custkey, ROUND(a.paid + b.owed, 4) AS strict_total,
       ROUND(COALESCE(a.paid, 0) + COALESCE(b.owed, 0), 4) AS filled_total
FROM (SELECT o_custkey AS custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS paid FROM orders
      WHERE o_orderstatus = 'F' AND o_totalprice > 300000 GROUP BY 1) a
FULL OUTER JOIN (SELECT c_custkey AS custkey, c_acctbal AS owed FROM customer WHERE c_acctbal > 0) b ON a.custkey = b.custkey""")
def _(t):
    from sparkloom.operators.groups import exact_sum
    paid = (t.orders.filter("o_orderstatus = 'F' AND o_totalprice > 300000")
            .groupBy(F.col("o_custkey").alias("custkey")).agg(exact_sum("o_totalprice").alias("paid")))
    owed = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("owed"))
    sums = C.aligned_add(paid, owed, "custkey", "paid", "owed", fill=0.0, both="filled")
    return sums.select("custkey", F.round("total", 4).alias("strict_total"), F.round("filled", 4).alias("filled_total"))


@query("prj16_star_distinct_flags", """
SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS home_flag,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS away_flag FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag").distinct()
    back = F.col("l_returnflag") == "R"
    return rows.select("*", F.when(back, 0).otherwise(1).alias("home_flag"), F.when(back, 1).otherwise(0).alias("away_flag"))


@query("prj17_nested_unpack", """
SELECT c_name, c_nationkey - 12 AS lat, ROUND(c_acctbal, 2) AS lon FROM customer WHERE c_acctbal <= 0""")
def _(t):
    metro = t.customer.select(F.struct("c_name", F.struct((F.col("c_nationkey") - 12).alias("lat"),
                                                          F.col("c_acctbal").alias("lon")).alias("at")).alias("m"))
    return metro.filter("m.at.lon <= 0").select("m.c_name", "m.at.lat", F.round("m.at.lon", 2).alias("lon"))
