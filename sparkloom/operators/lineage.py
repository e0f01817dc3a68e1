"""Column lineage as a table of edges: kinds, closure, sources, layers.

An edge has src_table, src_col, dst_table, dst_col, kind (direct, calculated, constant,
star) and role (data for values, control for conditions and window keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.ordered import RowNumber, over_order
from sparkloom.session import checkpointed

LAYERS = {"stg_": 1, "wrk_": 2, "dim_": 3, "fct_": 4}


def count_kinds(edges: DataFrame) -> DataFrame:
    return edges.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def node(table: str, col: str):
    return F.concat_ws(".", table, col)


def reach(links: DataFrame, asked: DataFrame) -> DataFrame:
    """(a, b, distance): each node ``a`` that leads to an asked node ``b``, with the fewest edges between them.

    ``links`` has a and b (an edge from a to b), ``asked`` has b. Paths double: ``found`` holds the pairs at most n
    edges apart, ``jumps`` those joined by a walk of exactly n edges, so found with found continued by one jump are
    the pairs at most 2n apart. The rounds are the logarithm of the longest of the shortest paths. It ends when no
    walk is that long, or, on cycles, when a round finds no new pair: a node further away would have one of distance
    n + 1 on its path. An asked node on a cycle reaches itself. Null ends are dropped, repeated edges count once.
    Jumps start from all nodes, so a round costs as much as the graph has pairs so far apart; shared hubs are split
    by adaptive execution, as both sides of the join are plain pairs.
    """
    jumps = checkpointed(links.select("a", "b").dropna().distinct(), "jumps")
    found = checkpointed(jumps.join(asked.select("b").dropna().distinct(), "b").select("a", "b", F.lit(1).cast("bigint").alias("distance")), "reach")
    size, n = found.count(), 1  # counts of written tables, from their footers
    while size and not jumps.isEmpty():
        steps = jumps.select("a", F.col("b").alias("m"))
        more = found.select(F.col("a").alias("m"), "b", "distance").join(steps, "m")
        found = checkpointed(found.unionByName(more.select("a", "b", (F.col("distance") + n).alias("distance")))
                             .groupBy("a", "b").agg(F.min("distance").alias("distance")), "reach")
        before, size = size, found.count()
        if size == before:
            break
        jumps = checkpointed(steps.join(jumps.withColumnsRenamed({"a": "m"}), "m").select("a", "b").distinct(), "jumps")
        n *= 2
    return found


def ancestors(edges: DataFrame, targets: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(ancestor, descendant) pairs of the asked nodes, the first column of ``targets``; see ``reach``."""
    asked = targets.select(F.col(targets.columns[0]).alias("b"))
    pairs = reach(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")), asked)
    return pairs.select(F.col("a").alias("ancestor"), F.col("b").alias("descendant"))


def upstream(edges: DataFrame, target: str, src: str = "src", dst: str = "dst") -> DataFrame:
    """All other nodes that lead to one node, with their distance; see ``reach``."""
    links = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    pairs = reach(links, links.select("b").filter(F.col("b") == target))
    return pairs.filter(F.col("a") != F.col("b")).select(F.col("a").alias("node"), "distance")


def sources(edges: DataFrame, internal_prefixes: list[str]) -> DataFrame:
    """Source columns: those nothing leads to, or of a table outside the internal prefixes."""
    outside = ~F.greatest(*[F.col("src_table").startswith(p) for p in internal_prefixes], F.lit(False))
    built = edges.select(F.col("dst_table").alias("src_table"), F.col("dst_col").alias("src_col"), F.lit(1).alias("_built")).distinct()
    used = edges.select("src_table", "src_col").distinct().join(built, ["src_table", "src_col"], "left")
    return used.filter(F.col("_built").isNull() | outside).select(
        "src_table", "src_col", F.col("_built").isNull().alias("no_model"), outside.alias("outside"))


def table_edges(edges: DataFrame) -> DataFrame:
    """Which table each table is built from, with the number of column edges."""
    return (edges.filter("src_table <> dst_table").groupBy("dst_table", "src_table")
            .agg(F.count(F.lit(1)).alias("columns")))


def _peeled(links: DataFrame, rest: DataFrame) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """(node, level) of the nodes no cycle leads to, by longest path, then the edges and nodes that are left.

    Each round takes the nodes that nothing left leads to and removes their edges: as many rounds as the graph is deep.
    """
    found, number = None, 0
    while True:
        ready = rest.join(links.select(F.col("b").alias("node")).distinct(), "node", "left_anti")
        ready = checkpointed(ready.withColumn("level", F.lit(number).cast("bigint")))
        if ready.isEmpty():
            return found, links, rest
        found = ready if found is None else found.unionByName(ready)
        links = checkpointed(links.join(ready.select(F.col("node").alias("a")), "a", "left_anti"))
        rest = checkpointed(rest.join(ready.select("node"), "node", "left_anti"))
        number += 1


def _spread(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(node, color): the largest color that reaches each node along ``links`` (a, b), its own among them.

    Only nodes whose color grew send it on in the next round.
    """
    colors = fresh = seeds
    while not fresh.isEmpty():
        sent = fresh.withColumnRenamed("node", "a").join(links, "a").groupBy(F.col("b").alias("node")).agg(F.max("color").alias("_sent"))
        colors = checkpointed(colors.select("node", "color").join(sent, "node", "left").select(
            "node", F.greatest("color", "_sent").alias("color"), (F.col("_sent") > F.col("color")).alias("_grew")))
        fresh = colors.filter("_grew").select("node", "color")
    return colors.select("node", "color")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the strongly connected components of two or more nodes, named by their largest node.

    Forward-backward colouring: each node takes the largest node that leads to it as color, then the nodes that lead
    back to the node their color is named after, along nodes of that color, are its component. What is found goes, and
    so does what nothing leads to or what leads nowhere; the rest is coloured again. ``links`` has a and b.
    """
    links = checkpointed(links.select("a", "b").dropna().filter("a <> b").distinct())
    found = None
    while True:
        size = -1
        while links.count() != size:  # edges from a node without sources or to a node without targets lie on no cycle
            size = links.count()
            links = checkpointed(links.join(links.select(F.col("b").alias("a")), "a", "left_semi")
                                 .join(links.select(F.col("a").alias("b")), "b", "left_semi"))
        if not size:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")) if found is None else found
        nodes = links.select(F.col("a").alias("node")).distinct()
        colors = _spread(checkpointed(nodes.withColumn("color", F.col("node"))), links)
        of_a, of_b = (colors.withColumnsRenamed({"node": end, "color": "_" + end}) for end in "ab")
        inner = checkpointed(links.join(of_a, "a").join(of_b, "b").filter("_a = _b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = checkpointed(colors.select("node", F.when(F.col("color") == F.col("node"), F.col("color")).alias("color")))
        whole = checkpointed(_reached(roots, inner).select("node", F.col("color").alias("component")))
        shared = whole.join(whole.groupBy("component").count().filter("count > 1"), "component", "left_semi").select("node", "component")
        found = shared if found is None else found.unionByName(shared)
        links = checkpointed(links.join(whole.select(F.col("node").alias("a")), "a", "left_anti")
                             .join(whole.select(F.col("node").alias("b")), "b", "left_anti"))


def _reached(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, color) of the nodes that a node with a color reaches along ``links``, where edges keep within a color."""
    colors, fresh = roots, roots.dropna()
    while not fresh.isEmpty():
        sent = fresh.withColumnRenamed("node", "a").join(links, "a").select(F.col("b").alias("node"), F.col("color").alias("_sent")).distinct()
        colors = checkpointed(colors.select("node", "color").join(sent, "node", "left").select(
            "node", F.coalesce("color", "_sent").alias("color"), (F.col("color").isNull() & F.col("_sent").isNotNull()).alias("_new")))
        fresh = colors.filter("_new").select("node", "color")
    return colors.select("node", "color").dropna()


def levels(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Longest path from a source to each node; the nodes of a cycle share a level, as if they were one.

    Where a cycle is left, its components are put together and the graph of components, which has none, is peeled
    from the start. An edge from a node to itself counts for nothing; null ends are dropped.
    """
    pairs = checkpointed(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna().distinct())
    nodes = checkpointed(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    links = pairs.filter("a <> b")
    found, caught, rest = _peeled(links, nodes)
    if rest.isEmpty():
        return nodes.withColumn("level", F.lit(0).cast("bigint")) if found is None else found
    member = checkpointed(nodes.join(checkpointed(components(caught)), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")))
    of_a, of_b = (member.withColumnsRenamed({"node": end, "component": "_" + end}) for end in "ab")
    joined = checkpointed(links.join(of_a, "a").join(of_b, "b").filter("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    found, _, _ = _peeled(joined, checkpointed(member.select(F.col("component").alias("node")).distinct()))
    return member.join(found.withColumnRenamed("node", "component"), "component").select("node", "level")


def layered(tables: DataFrame, table: str = "node", level: str = "level") -> DataFrame:
    """Layer by name prefix, and the place inside the layer by dependency level and name."""
    layer = F.lit(0)
    for prefix, number in LAYERS.items():
        layer = F.when(F.col(table).startswith(prefix), number).otherwise(layer)
    return over_order(checkpointed(tables.withColumn("layer", layer)), "layer", [level, table], {"place": RowNumber()})


def with_definitions(columns: DataFrame, definitions: DataFrame) -> DataFrame:
    """Attach description and type by table and column; unknown columns keep nulls."""
    return columns.join(definitions, ["table_name", "column_name"], "left")


def bridge_snapshots(models: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Edge from each model to the snapshot of its relation, whatever the letter case."""
    held = snapshots.select(F.lower("relation").alias("_key"), "snapshot")
    return models.join(held, F.lower("model") == F.col("_key")).drop("_key")


def table_roles(edges: DataFrame) -> DataFrame:
    """Source tables per target: joined when any of their columns carries values, else filter only."""
    return edges.groupBy("dst_table", "src_table").agg(
        F.when(F.bool_or(F.col("role") == "data"), "joined").otherwise("filter only").alias("table_role"))
