"""Sources and sinks: tables written to the shared folder in a file format and read back."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.sources import files, sinks
from sparkloom.sources.tables import SCHEMAS


@query("src1_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = sinks.scratch(t.spark, "customer-csv")
    sinks.write_csv(t.customer, path)
    return files.read_csv(t.spark, path, SCHEMAS["customer"])


@query("src2_delimited_no_header", "SELECT lang AS label, source AS origin, doc_id, text FROM documents")
def _(t):
    path = sinks.scratch(t.spark, "labels-tsv")
    rows = t.documents.select("lang", "source", "doc_id", files.escaped(F.col("text")).alias("text"))
    sinks.write_csv(rows, path, sep="\t", header=False)
    back = files.read_delimited(t.spark, path, "label string, origin string, doc_id bigint, text string")
    return back.withColumn("text", files.unescaped(F.col("text")))


@query("src3_preamble_scan", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    lines = t.events.select(F.concat_ws("\t", "event_id", "user_id", "event_type", "value").alias("value"))
    head = t.spark.createDataFrame(
        [("# gauge notes",), ("event_id\tuser_id\tevent_type\tvalue",), ("5s\t15s\t20d\t6s",)], "value string")
    path = sinks.scratch(t.spark, "gauge")
    head.unionByName(lines).write.text(path)
    return files.read_with_preamble(t.spark, path, "event_id bigint, user_id bigint, event_type string, value double")


@query("src4_nested_feed", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey * 2 + side AS game_id, o_orderpriority AS text,
       o_custkey AS home_id, o_totalprice AS home_score, o_custkey + 1 AS away_id,
       CASE WHEN side = 0 THEN 0.0 ELSE o_totalprice END AS away_score
FROM orders, (VALUES (0), (1)) s(side)""")
def _(t):
    def game(side, score):
        return F.struct((F.col("o_orderkey") * 2 + side).alias("game_id"), F.col("o_orderpriority").alias("text"),
                        F.struct(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("score")).alias("home"),
                        F.struct((F.col("o_custkey") + 1).alias("id"), score.alias("score")).alias("away"))
    feed = t.orders.select(F.col("o_orderdate").cast("date").cast("string").alias("day"),
                           F.array(game(0, F.lit(0.0)), game(1, F.col("o_totalprice"))).alias("games"))
    path = sinks.scratch(t.spark, "feed")
    sinks.write_json(feed, path)
    team = "struct<id:bigint,score:double>"
    return files.flatten_games(files.read_feed(
        t.spark, path, f"day string, games array<struct<game_id:bigint,text:string,home:{team},away:{team}>>"))


@query("src4_open_feed", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey AS game_id,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS text,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'c' || o_custkey END AS code,
       CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice > 200000 END AS late,
       CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS score,
       o_custkey AS home_id, o_custkey + 1 AS away_id
FROM orders""")
def _(t):
    day = F.col("o_orderdate").cast("date").cast("string").alias("day")
    teams = [F.struct(F.col("o_custkey").alias("id")).alias("home"), F.struct((F.col("o_custkey") + 1).alias("id")).alias("away")]
    key = F.col("o_orderkey").alias("game_id")
    first = F.struct(key, F.col("o_orderpriority").alias("text"), F.col("o_custkey").alias("code"),
                     F.array("o_orderstatus").alias("tags"), *teams)
    later = F.struct(key, F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("code"),
                     (F.col("o_totalprice") > 200000).alias("late"), F.col("o_totalprice").alias("score"), *teams)
    path = sinks.scratch(t.spark, "feed")
    for i, game in enumerate((first, later)):  # the later part of the feed drops, adds and retypes keys
        t.orders.filter(F.col("o_orderkey") % 2 == i).select(day, F.array(game).alias("games")).write.mode("append").json(path)
    return files.flatten_feed(files.read_open_feed(t.spark, path), "$.games", {"day": "string"},
                              {"home_id": ("$.home.id", "bigint"), "away_id": ("$.away.id", "bigint")})


@query("src5_vector_file", """
SELECT 'w' || vec_id AS word, CAST(len(embedding) AS INTEGER) AS dims,
       CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[len(embedding)] AS DOUBLE) AS last_value
FROM embeddings""")
def _(t):
    path = sinks.scratch(t.spark, "vectors")
    t.embeddings.select(F.concat_ws(" ", F.concat(F.lit("w"), "vec_id"),
                                    F.transform("embedding", lambda x: x.cast("string"))).alias("value")).write.text(path)
    v = files.read_vectors(t.spark, path)
    return v.select("word", F.size("vector").alias("dims"),
                    F.element_at("vector", 1).cast("double").alias("first_value"),
                    F.element_at("vector", -1).cast("double").alias("last_value"))


@query("src6_query_scan", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def _(t):
    t.orders.createOrReplaceTempView("orders_scan")
    return t.spark.sql("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done
                          FROM orders_scan WHERE o_orderdate >= TIMESTAMP_NTZ '1998-01-01'""")


@query("src7_html_rows", """
SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS link FROM pages""")
def _(t):
    return files.html_rows(t.pages, "html", '<li><a href="([^"]*)">', "link")


@query("src8_load_stamp", "SELECT o_orderkey, true AS stamped FROM orders")
def _(t):
    stamped = t.orders.withColumn("loaded_at", F.current_timestamp())
    return stamped.select("o_orderkey", F.col("loaded_at").isNotNull().alias("stamped"))


@query("snk1_csv_resume", """
SELECT o_custkey, COUNT(*) AS n_orders, o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS resumed
FROM orders GROUP BY o_custkey""")
def _(t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    first = t.orders.filter("o_orderstatus = 'P'").select("o_custkey").distinct()
    path = sinks.scratch(t.spark, "resume-csv")
    schema = "o_custkey bigint, n_orders bigint"
    sinks.write_csv(per.join(first, "o_custkey", "left_semi"), path)
    done = files.read_csv(t.spark, path, schema)
    rest = sinks.unseen(per, done, ["o_custkey"])
    return (done.withColumn("resumed", F.lit(True))
            .unionByName(rest.withColumn("resumed", F.lit(False))))


@query("snk2_append_table", "SELECT s_nationkey, COUNT(*) AS n FROM supplier GROUP BY s_nationkey")
def _(t):
    path = sinks.scratch(t.spark, "append")
    sinks.append_parquet(t.supplier.filter("s_acctbal >= 0"), path)
    sinks.append_parquet(t.supplier.filter("s_acctbal < 0 OR s_acctbal IS NULL"), path)
    back = t.spark.read.schema(SCHEMAS["supplier"]).parquet(path)
    return back.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("snk3_truncate_reload", "SELECT p_partkey, p_brand, p_size FROM part")
def _(t):
    path = sinks.scratch(t.spark, "reload")
    parts = t.part.select("p_partkey", "p_brand", "p_size")
    sinks.reload_parquet(parts, path)
    sinks.reload_parquet(parts, path)
    return t.spark.read.schema(parts.schema).parquet(path)


@query("snk4_json_records", "SELECT n_nationkey, n_name, n_regionkey, n_customers FROM nation JOIN "
       "(SELECT c_nationkey, COUNT(*) AS n_customers FROM customer GROUP BY 1) ON n_nationkey = c_nationkey")
def _(t):
    per = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"))
    out = t.nation.join(per, F.col("n_nationkey") == F.col("c_nationkey")).drop("c_nationkey")
    path = sinks.scratch(t.spark, "records")
    sinks.write_json(out, path)
    return t.spark.read.schema(out.schema).json(path)


@query("snk5_named_view", "SELECT c_mktsegment, COUNT(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def _(t):
    t.customer.filter("c_acctbal > 0").createOrReplaceTempView("vw_customer_in_credit")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS n FROM vw_customer_in_credit GROUP BY c_mktsegment")
