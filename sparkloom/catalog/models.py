"""The layered order models end to end."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.operators.filters import choose
from sparkloom.plans import snapshots as S
from sparkloom.plans import warehouse as H

AS_OF = "2001-08-01"
WORK = """
WITH stg AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, COALESCE(o_totalprice, 0) AS order_amount,
  UPPER(TRIM(o_orderstatus)) AS order_status, o_orderpriority AS category FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'),
wrk AS (SELECT order_id, customer_id, TRIM(c_name) AS customer_name, order_date, order_amount, category,
  CASE WHEN order_amount > 400000 THEN 'high_value' WHEN order_amount > 100000 THEN 'medium_value' ELSE 'low_value' END AS order_tier
  FROM stg JOIN customer ON c_custkey = customer_id WHERE order_status = 'F' AND c_mktsegment IS NOT NULL)
"""


def work(t):
    return H.work_orders(H.stage_orders(t.orders), H.stage_customers(t.customer))


def as_of():
    return F.lit(AS_OF).cast("date")


@query("mdl_fct_customer_orders", WORK + """,
m AS (SELECT customer_id, category, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC, category) AS rn FROM wrk GROUP BY 1, 2),
s AS (SELECT customer_id, customer_name, COUNT(*) AS total_orders, CAST(SUM(CAST(order_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, MIN(order_date) AS first_order_date,
  MAX(order_date) AS last_order_date FROM wrk GROUP BY 1, 2),
v AS (SELECT s.*, category AS primary_category, CASE WHEN total_revenue > 1000000 THEN total_revenue * 1.2::DOUBLE ELSE total_revenue END AS clv FROM s JOIN m USING (customer_id) WHERE rn = 1)
SELECT customer_id, customer_name, total_orders, total_revenue, first_order_date, last_order_date, ROUND(clv, 3) AS customer_lifetime_value, primary_category,
  ROUND(total_revenue / total_orders, 8) AS avg_order_value, CASE WHEN clv > 2000000 AND total_orders > 6 THEN 'VIP' WHEN clv > 1000000 THEN 'Premium' WHEN total_orders > 5 THEN 'Frequent' ELSE 'Standard' END AS customer_segment
FROM v WHERE last_order_date >= DATE '2001-08-01' - 90""")
def fct_customer_orders(t):
    out = H.customer_orders(H.order_summary(work(t), as_of())).drop("is_active")
    return out.withColumns({"customer_lifetime_value": F.round("customer_lifetime_value", 3), "avg_order_value": F.round("avg_order_value", 8)})


@query("mdl_fct_order_details", WORK + """
SELECT *, CASE WHEN category = '1-URGENT' AND order_tier = 'high_value' THEN 'premium_tech' WHEN category = '1-URGENT' THEN 'standard_tech' WHEN order_tier = 'high_value' THEN 'premium_other' ELSE 'standard' END AS order_value_tier,
 CASE WHEN order_date >= DATE '2001-08-01' - 30 THEN 'recent' WHEN order_date >= DATE '2001-08-01' - 90 THEN 'moderate' ELSE 'old' END AS order_recency FROM wrk""")
def _(t):
    return H.order_details(work(t), as_of()).drop("order_status")


@query("mdl_dim_customers", """
WITH v AS (SELECT o_custkey, o_orderdate, o_orderstatus, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn, COUNT(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT c_custkey, c_name, n AS total_orders, o_orderstatus AS last_status, CASE WHEN n >= 20 THEN 'VIP' WHEN n >= 12 THEN 'LOYAL' WHEN n >= 5 THEN 'REGULAR' ELSE 'NEW' END AS customer_segment
FROM customer JOIN v ON o_custkey = c_custkey WHERE rn = 1""")
def _(t):
    snap = S.versions(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), "o_custkey", "o_orderdate", "o_orderkey")
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total_orders"))
    live = S.current(snap).select("o_custkey", F.col("o_orderstatus").alias("last_status"))
    n = F.col("total_orders")
    return (t.customer.join(live, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
            .join(counts, F.col("c_custkey") == F.col("o_custkey"))
            .select("c_custkey", "c_name", "total_orders", "last_status",
                    choose([(n >= 20, "VIP"), (n >= 12, "LOYAL"), (n >= 5, "REGULAR")], "NEW").alias("customer_segment")))
