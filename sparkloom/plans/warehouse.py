"""Layered order models: staging, work, mart and presentation, as functions over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.aggregates import modes
from sparkloom.operators.filters import choose, recency
from sparkloom.operators.groups import exact_sum


def stage_orders(orders: DataFrame, since: str = "1995-01-01") -> DataFrame:
    """Typed and trimmed orders from a start date on."""
    return orders.filter((F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz")) & F.col("o_orderkey").isNotNull()).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.coalesce("o_totalprice", F.lit(0.0)).alias("order_amount"),
        F.upper(F.trim("o_orderstatus")).alias("order_status"), F.col("o_orderpriority").alias("category"))


def stage_customers(customer: DataFrame) -> DataFrame:
    balance = F.col("c_acctbal")
    return customer.filter("c_custkey IS NOT NULL AND c_mktsegment IS NOT NULL").select(
        F.col("c_custkey").alias("customer_id"), F.trim("c_name").alias("customer_name"),
        F.lower("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_id"),
        choose([(balance >= 7500, "PREMIUM"), (balance >= 5000, "GOLD"), (balance >= 1000, "SILVER")], "BRONZE").alias("customer_tier"))


def order_tier(amount: Column) -> Column:
    return choose([(amount > 400000, "high_value"), (amount > 100000, "medium_value")], "low_value")


def work_orders(staged: DataFrame, customers: DataFrame, status: str = "F") -> DataFrame:
    """Finished orders with customer name and value tier."""
    done = staged.filter(F.col("order_status") == status)
    return done.join(customers.select("customer_id", "customer_name"), "customer_id").withColumn(
        "order_tier", order_tier(F.col("order_amount")))


def order_summary(work: DataFrame, as_of: Column, active_days: int = 90) -> DataFrame:
    """Per customer: totals, dates, most frequent category, uplifted value and activity flag."""
    per = work.groupBy("customer_id", "customer_name").agg(
        F.count("order_id").alias("total_orders"), exact_sum("order_amount").alias("total_revenue"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    mode = modes(work, "customer_id", "category", all_ties=False).select("customer_id", F.col("category").alias("primary_category"))
    revenue = F.col("total_revenue")
    return per.join(mode, "customer_id", "left").withColumns({
        "avg_order_value": revenue / F.col("total_orders"),
        "customer_lifetime_value": F.when(revenue > 1000000, revenue * F.lit(1.2)).otherwise(revenue),
        "is_active": (F.col("last_order_date") >= F.date_sub(as_of, active_days)).cast("int")})


def customer_orders(summary: DataFrame) -> DataFrame:
    """Active customers with their segment."""
    value, n = F.col("customer_lifetime_value"), F.col("total_orders")
    return summary.filter("is_active = 1").withColumn("customer_segment", choose(
        [((value > 2000000) & (n > 6), "VIP"), (value > 1000000, "Premium"), (n > 5, "Frequent")], "Standard"))


def order_details(work: DataFrame, as_of: Column) -> DataFrame:
    urgent, high = F.col("category") == "1-URGENT", F.col("order_tier") == "high_value"
    return work.filter(F.col("order_tier").isNotNull()).withColumns({
        "order_value_tier": choose([(urgent & high, "premium_tech"), (urgent, "standard_tech"), (high, "premium_other")], "standard"),
        "order_recency": recency(F.col("order_date"), as_of, [(30, "recent"), (90, "moderate")], "old")})


def customer_summary(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Summary over all orders, whatever their status."""
    totals = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total_orders"), exact_sum("o_totalprice").alias("total_revenue"),
        F.min(F.col("o_orderdate").cast("date")).alias("first_order_date"),
        F.max(F.col("o_orderdate").cast("date")).alias("last_order_date"))
    mode = modes(orders, "o_custkey", "o_orderpriority", all_ties=False).select("o_custkey", F.col("o_orderpriority").alias("primary_priority"))
    revenue = F.col("total_revenue")
    uplift = F.when(revenue > 1000000, revenue * F.lit(1.2)).otherwise(revenue)
    per = totals.join(mode, "o_custkey")
    return per.join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "total_orders", "total_revenue",
        F.round(revenue / F.col("total_orders"), 8).alias("avg_order_value"), "first_order_date", "last_order_date",
        "primary_priority", F.round(uplift, 3).alias("customer_lifetime_value"))


CHANNELS = {"F": "online", "O": "retail", "P": "mobile"}


def channel_metrics(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Totals per channel, united and summed up again per customer; order status stands for the channel."""
    status, parts = F.coalesce("o_orderstatus", F.lit("")), None
    tests = [status == s for s in CHANNELS] + [~status.isin(*CHANNELS)]  # all other states are one more channel
    for test in tests:
        part = orders.filter(test).groupBy("o_custkey").agg(
            exact_sum("o_totalprice").alias("v"), F.max("o_orderdate").alias("d"), F.count(F.lit(1)).alias("n"))
        parts = part if parts is None else parts.unionByName(part)
    per = parts.groupBy("o_custkey").agg(exact_sum("v").alias("v"), F.max("d").alias("d"), F.sum("n").alias("n"))
    return customer.select("c_custkey").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.round(F.coalesce("v", F.lit(0.0)), 4).alias("lifetime_value"),
        F.col("d").cast("date").alias("last_order_date"), F.coalesce("n", F.lit(0)).cast("bigint").alias("total_orders"))


def multi_channel(orders: DataFrame) -> DataFrame:
    """Three channels with their own column names, aligned and united; any state but F and O is mobile."""
    online = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("ONLINE").alias("channel"), (F.col("o_totalprice") + 5).alias("total_amount"))
    retail = orders.filter("o_orderstatus = 'O'").selectExpr(
        "o_orderkey AS transaction_id", "o_custkey AS cust_id", "o_totalprice AS purchase_amount")
    retail = retail.withColumnsRenamed({"transaction_id": "order_id", "cust_id": "customer_id", "purchase_amount": "total_amount"})
    mobile = orders.filter("coalesce(o_orderstatus, '') NOT IN ('F', 'O')").selectExpr(
        "o_orderkey AS mobile_order_id", "o_custkey AS user_id", "o_totalprice AS order_total")
    mobile = mobile.withColumnsRenamed({"mobile_order_id": "order_id", "user_id": "customer_id", "order_total": "total_amount"})
    return (online.unionByName(retail.withColumn("channel", F.lit("RETAIL")))
            .unionByName(mobile.withColumn("channel", F.lit("MOBILE"))))
