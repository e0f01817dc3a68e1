"""Vectors, search, rules and user functions."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.functions import arrays as A
from sparkloom.functions import generators as U
from sparkloom.functions.text import initial
from sparkloom.operators import kept_index as KI
from sparkloom.operators import search as S
from sparkloom.operators import vectors as V
from sparkloom.operators.groups import exact_avg, joined_on, with_group
from sparkloom.sources import sinks

DIMS = 64
E = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
WORDS = r"list_filter(regexp_split_to_array(upper(replace(replace(text, '-', ' '), 'ß', 'ss')), '\s+'), lambda x: x <> '')"


@query("vec1_nearest", f"""
SELECT x.vec_id, ROUND(list_cosine_similarity(x.v, q.v), 6) AS similarity FROM {E} x, {E} q WHERE q.vec_id = 7 AND x.vec_id <> 7
ORDER BY list_cosine_similarity(x.v, q.v) DESC, x.vec_id LIMIT 10""")
def _(t):
    query_vector = V.vector_of(t.embeddings, "vec_id", 7, "embedding")
    return V.nearest(t.embeddings, "vec_id", "embedding", query_vector, 10, exclude=[7]).withColumn("similarity", F.round("similarity", 6))


ANALOGY = f"""(SELECT list_transform(list_zip(a.v, b.v, c.v), lambda z: z[1] - z[2] + z[3]) AS v FROM {E} a, {E} b, {E} c WHERE a.vec_id = 3 AND b.vec_id = 5 AND c.vec_id = 8)"""


@query("vec2_analogy", f"""
(SELECT x.vec_id, ROUND(list_cosine_similarity(x.v, q.v), 6) AS similarity, 'without inputs' AS variant FROM {E} x, {ANALOGY} q WHERE x.vec_id NOT IN (3, 5, 8)
ORDER BY list_cosine_similarity(x.v, q.v) DESC, x.vec_id LIMIT 5) UNION ALL
(SELECT x.vec_id, ROUND(list_cosine_similarity(x.v, q.v), 6), 'with inputs' FROM {E} x, {ANALOGY} q ORDER BY list_cosine_similarity(x.v, q.v) DESC, x.vec_id LIMIT 5)""")
def _(t):
    out = V.analogy(t.embeddings, "vec_id", "embedding", 3, 5, 8, 5).withColumn("variant", F.lit("without inputs"))
    kept = V.analogy(t.embeddings, "vec_id", "embedding", 3, 5, 8, 5, keep_inputs=True).withColumn("variant", F.lit("with inputs"))
    return out.unionByName(kept).withColumn("similarity", F.round("similarity", 6))


@query("vec3_sentence_vectors", f"""
WITH w AS (SELECT doc_id, unnest({WORDS}) AS w FROM documents), k AS (SELECT doc_id, (ascii(w) * 31 + ascii(right(w, 1)) * 7 + length(w)) % (SELECT COUNT(*) FROM embeddings) AS vec_id FROM w),
j AS (SELECT k.doc_id, e.v FROM k JOIN {E} e USING (vec_id))
SELECT doc_id, COALESCE(n, 0) AS known_tokens, """ + ", ".join(f"ROUND(d{i}, 6) AS d{i}" for i in range(DIMS)) + """ FROM documents
LEFT JOIN (SELECT doc_id, COUNT(*) AS n, """ + ", ".join(f"AVG(v[{i + 1}]) AS d{i}" for i in range(DIMS)) + """ FROM j GROUP BY 1) USING (doc_id)""")
def _(t):
    from sparkloom.catalog.ml import word_rows
    vocabulary = t.embeddings.select(F.col("vec_id").alias("word"), "embedding")
    words = word_rows(t.documents, t.embeddings)
    out = V.sentence_vectors(t.documents, words, "doc_id", vocabulary, "word", "embedding", DIMS)
    return out.select("doc_id", F.col("weight").alias("known_tokens"),
                      *[F.round(F.get("mean", F.lit(i)), 6).alias(f"d{i}") for i in range(DIMS)])


@query("vec4_distances", f"""
WITH c AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, AVG(v[i]) AS m FROM {E}, generate_series(1, 64) g(i) GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id, ROUND(list_distance(v, c), 5) AS euclidean, ROUND(1 - list_cosine_similarity(v, c), 5) AS cosine FROM {E} JOIN c USING (label)""")
def _(t):
    centres = V.mean_vectors(t.embeddings, "label", "embedding", DIMS).select("label", F.col("mean").alias("centre"))
    out = joined_on(t.embeddings, centres, "label")
    return out.select("vec_id", F.round(A.euclidean(F.col("embedding"), F.col("centre")), 5).alias("euclidean"),
                      F.round(1 - A.cosine(F.col("embedding"), F.col("centre")), 5).alias("cosine"))


@query("srch1_inverted_index", f"""
SELECT token, COUNT(DISTINCT doc_id) AS n_docs, MIN(doc_id) AS first_doc, MAX(doc_id) AS last_doc FROM (SELECT doc_id, unnest({WORDS}) AS token FROM documents) GROUP BY 1""")
def _(t):
    index = S.postings(t.documents, "doc_id", "text")
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


@query("srch1_and_query", f"""
SELECT doc_id FROM (SELECT doc_id, unnest({WORDS}) AS token FROM documents) WHERE token IN ('THE', 'AND', 'ON') GROUP BY 1 HAVING COUNT(DISTINCT token) = 3""")
def _(t):
    return S.all_tokens(S.postings(t.documents, "doc_id", "text"), "doc_id", "the and-on")


def kept(t):
    """Index of the documents, written in two batches."""
    folder = sinks.scratch(t.spark, "index")
    longer = F.col("n_chars") > 400
    for part in (longer, ~F.coalesce(longer, F.lit(False))):
        KI.append(t.documents.filter(part), "doc_id", "text", folder)
    return KI.open_index(t.spark, folder)


@query("srch1_kept_index", f"""
SELECT token, COUNT(DISTINCT doc_id) AS n_docs, MIN(doc_id) AS first_doc, MAX(doc_id) AS last_doc FROM (SELECT doc_id, unnest({WORDS}) AS token FROM documents) GROUP BY 1""")
def _(t):
    return kept(t).groupBy("token").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first_doc"), F.max("last").alias("last_doc"))


@query("srch1_kept_and_query", f"""
SELECT doc_id FROM (SELECT doc_id, unnest({WORDS}) AS token FROM documents) WHERE token IN ('THE', 'AND', 'ON') GROUP BY 1 HAVING COUNT(DISTINCT token) = 3""")
def _(t):
    return KI.search(kept(t), "doc_id", "the and-on")


@query("rule1_discounts", """
WITH o AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS total, SUM(CASE WHEN l_quantity >= 20 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * 0.10 ELSE 0 END)::DOUBLE AS bulk,
  COUNT(DISTINCT l_partkey) AS items FROM lineitem GROUP BY 1),
d AS (SELECT o_orderkey, total, CASE WHEN c_acctbal >= 1000 THEN total * 0.05::DOUBLE ELSE 0 END AS loyalty, bulk, CASE WHEN items >= 10 THEN total * 0.07::DOUBLE ELSE 0 END AS large
  FROM o JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)
SELECT o_orderkey, ROUND(total, 4) AS total, ROUND(loyalty, 6) AS loyalty, ROUND(bulk, 6) AS bulk, ROUND(large, 6) AS large, ROUND(GREATEST(loyalty, bulk, large), 6) AS best,
 ROUND(total - GREATEST(loyalty, bulk, large), 6) AS due FROM d""")
def _(t):
    points = t.orders.join(t.customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_acctbal")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    out = S.discounts(lines, "o_orderkey", "l_partkey", "l_quantity", "l_extendedprice", points, "c_acctbal", scale=2)
    return out.select("o_orderkey", F.round("total", 4).alias("total"), *[F.round(c, 6).alias(c) for c in ("loyalty", "bulk", "large", "best", "due")])


@query("udf1_row_function", "SELECT c_custkey, substr(c_name, 1, 1) || '. ' || split_part(c_name, '#', 2) AS short_name, c_acctbal > 5000 AS rich FROM customer")
def _(t):
    return t.customer.select("c_custkey", initial(F.col("c_name")).alias("short_name"), (F.col("c_acctbal") > 5000).alias("rich"))


@query("udf2_custom_aggregate", "SELECT l_suppkey, ROUND(EXP(AVG(LN(l_extendedprice))), 4) AS geometric_mean FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(U.geometric_mean(F.col("l_extendedprice")), 4).alias("geometric_mean"))


@query("udf3_generator", f"""
SELECT conv_id, turn, word, COUNT(*) AS n FROM (SELECT conv_id, turn, unnest({WORDS}) AS word FROM conversations) GROUP BY 1, 2, 3""")
def _(t):
    src = t.conversations.select(F.struct("conv_id", "turn").alias("id"), "text")
    words = U.words_by_explode(src, "id", "text")
    return words.groupBy("id", "word").agg(F.count(F.lit(1)).alias("n")).select("id.conv_id", "id.turn", "word", "n")


@query("udf4_group_transform", """
SELECT event_id, ROUND(value - CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY user_id), 8) AS demeaned FROM events""")
def _(t):
    out = with_group(t.events.select("event_id", "user_id", "value"), "user_id", mean=exact_avg("value"))
    return out.select("event_id", F.round(U.demeaned(F.col("value"), F.col("mean")), 8).alias("demeaned"))
