"""Lineage graph. The tables hold no edges, so each part key k > 0 is a column built from
column k div 2; eight keys make a table, and the number of bits of the table gives its layer."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.operators import lineage as G

PREFIX = ("CASE WHEN {0} = 0 THEN 'raw_' WHEN {0} < 4 THEN 'stg_' WHEN {0} < 32 THEN 'wrk_' WHEN {0} < 128 THEN 'dim_' ELSE 'fct_' END "
          "|| 'table_' || CAST({0} AS VARCHAR)")
EDGES = f"""
WITH RECURSIVE e AS (SELECT p_partkey // 2 AS s, p_partkey AS d, {PREFIX.format('(p_partkey // 16)')} AS src_table, 'c' || (p_partkey // 2) AS src_col,
  {PREFIX.format('(p_partkey // 8)')} AS dst_table, 'c' || p_partkey AS dst_col, CASE p_size % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'calculated' WHEN 2 THEN 'constant' ELSE 'star' END AS kind,
  CASE WHEN p_size % 3 = 0 THEN 'control' ELSE 'data' END AS role FROM part WHERE p_partkey > 0)
"""


def name(number):
    prefix = F.when(number == 0, "raw_").when(number < 4, "stg_").when(number < 32, "wrk_").when(number < 128, "dim_").otherwise("fct_")
    return F.concat(prefix, F.lit("table_"), number.cast("string"))


def edges(t):
    key = F.col("p_partkey")
    source = F.floor(key / 2)
    size = F.col("p_size")
    return t.part.filter("p_partkey > 0").select(
        name(F.floor(source / 8)).alias("src_table"), F.concat(F.lit("c"), source.cast("string")).alias("src_col"),
        name(F.floor(key / 8)).alias("dst_table"), F.concat(F.lit("c"), key.cast("string")).alias("dst_col"),
        F.when(size % 4 == 0, "direct").when(size % 4 == 1, "calculated").when(size % 4 == 2, "constant").otherwise("star").alias("kind"),
        F.when(size % 3 == 0, "control").otherwise("data").alias("role"))


def nodes(e):
    return e.select(G.node("src_table", "src_col").alias("src"), G.node("dst_table", "dst_col").alias("dst"), "role")


def working_columns(t):
    """The columns of the tables of the working layer, part keys 32 to 255 at every size."""
    return nodes(edges(t)).filter("dst LIKE 'wrk%'").select("dst")


def built_columns(t):
    """All columns that are built from others; they grow with part."""
    return nodes(edges(t)).select("dst")


@query("lin1_edge_kinds", EDGES + "SELECT kind, COUNT(*) AS n FROM e GROUP BY 1")
def _(t):
    return G.count_kinds(edges(t))


CLOSE = ", c(a, b) AS (SELECT s, d FROM e {0} UNION SELECT e.s, c.b FROM c JOIN e ON e.d = c.a {1})"
NAMES = ", n AS (SELECT s AS k, src_table || '.' || src_col AS name FROM e UNION SELECT d, dst_table || '.' || dst_col FROM e)"


@query("lin2_upstream_closure", EDGES + CLOSE.format("", "") + NAMES
       + "SELECT x.name AS ancestor, y.name AS descendant FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE b >= 32 AND b < 256")
def _(t):
    return G.ancestors(nodes(edges(t)), working_columns(t))


@query("lin2_upstream_closure_all", EDGES + CLOSE.format("", "") + NAMES
       + "SELECT x.name AS ancestor, y.name AS descendant FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b")
def _(t):
    return G.ancestors(nodes(edges(t)), built_columns(t))


@query("lin2_upstream_of_column", EDGES + """, u(k, distance) AS (SELECT s, 1 FROM e WHERE d = 150 UNION SELECT e.s, u.distance + 1 FROM u JOIN e ON e.d = u.k)""" + NAMES
       + "SELECT name AS node, CAST(distance AS BIGINT) AS distance FROM u JOIN n USING (k)")
def _(t):
    return G.upstream(nodes(edges(t)), "wrk_table_18.c150")


@query("lin3_sources", EDGES + """
SELECT DISTINCT src_table, src_col, NOT EXISTS (SELECT 1 FROM e x WHERE x.dst_table = e.src_table AND x.dst_col = e.src_col) AS no_model,
 src_table LIKE 'raw%' AS outside FROM e WHERE src_table LIKE 'raw%' OR NOT EXISTS (SELECT 1 FROM e x WHERE x.dst_table = e.src_table AND x.dst_col = e.src_col)""")
def _(t):
    return G.sources(edges(t), ["stg_", "wrk_", "dim_", "fct_"])


@query("lin4_table_rollup", EDGES + "SELECT dst_table, src_table, COUNT(*) AS columns FROM e WHERE src_table <> dst_table GROUP BY 1, 2")
def _(t):
    return G.table_edges(edges(t))


@query("lin5_layers", EDGES + """, t AS (SELECT DISTINCT src_table AS s, dst_table AS d FROM e WHERE src_table <> dst_table),
p(node, level) AS (SELECT DISTINCT s, 0 FROM t WHERE s NOT IN (SELECT d FROM t) UNION SELECT t.d, p.level + 1 FROM p JOIN t ON t.s = p.node),
l AS (SELECT node, CAST(MAX(level) AS BIGINT) AS level, CAST(CASE left(node, 4) WHEN 'stg_' THEN 1 WHEN 'wrk_' THEN 2 WHEN 'dim_' THEN 3 WHEN 'fct_' THEN 4 ELSE 0 END AS INTEGER) AS layer FROM p GROUP BY 1, 3)
SELECT *, ROW_NUMBER() OVER (PARTITION BY layer ORDER BY level, node) AS place FROM l""")
def _(t):
    return G.layered(G.levels(G.table_edges(edges(t)), "src_table", "dst_table"))


@query("lin6_definitions", EDGES + """
SELECT dst_table AS table_name, dst_col AS column_name, CASE WHEN p_size > 25 THEN p_name END AS description, CASE WHEN p_size > 25 THEN p_type END AS data_type FROM e JOIN part ON p_partkey = d""")
def _(t):
    columns = edges(t).select(F.col("dst_table").alias("table_name"), F.col("dst_col").alias("column_name"))
    key = F.col("p_partkey")
    known = t.part.filter("p_partkey > 0 AND p_size > 25").select(
        name(F.floor(key / 8)).alias("table_name"), F.concat(F.lit("c"), key.cast("string")).alias("column_name"),
        F.col("p_name").alias("description"), F.col("p_type").alias("data_type"))
    return G.with_definitions(columns, known)


@query("lin7_snapshot_bridge", """
SELECT lower(c_name) AS model, 'snp_' || c_custkey AS snapshot FROM customer WHERE c_mktsegment = 'BUILDING'""")
def _(t):
    models = t.customer.select(F.lower("c_name").alias("model"))
    snaps = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.upper("c_name").alias("relation"), F.concat(F.lit("snp_"), F.col("c_custkey").cast("string")).alias("snapshot"))
    return G.bridge_snapshots(models, snaps)


@query("lin8_data_flow_closure", EDGES + CLOSE.format("WHERE role = 'data'", "AND e.role = 'data'") + NAMES
       + "SELECT x.name AS ancestor, y.name AS descendant FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE b >= 32 AND b < 256")
def _(t):
    return G.ancestors(nodes(edges(t)).filter("role = 'data'"), working_columns(t))


@query("lin8_data_flow_closure_all", EDGES + CLOSE.format("WHERE role = 'data'", "AND e.role = 'data'") + NAMES
       + "SELECT x.name AS ancestor, y.name AS descendant FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b")
def _(t):
    return G.ancestors(nodes(edges(t)).filter("role = 'data'"), built_columns(t))


@query("lin8_table_roles", EDGES + """
SELECT dst_table, src_table, CASE WHEN bool_or(role = 'data') THEN 'joined' ELSE 'filter only' END AS table_role FROM e GROUP BY 1, 2""")
def _(t):
    return G.table_roles(edges(t))
