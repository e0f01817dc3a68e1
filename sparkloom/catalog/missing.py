"""Missing values and duplicates. Error events carry no reading, which gives the nulls."""

from pyspark.sql import functions as F

from sparkloom.catalog.registry import query
from sparkloom.operators import dedup as D
from sparkloom.operators import nulls as N

READ = "(SELECT event_id, ts, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS reading FROM events)"
FILLED = """
WITH e AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM """ + READ + """),
n AS (SELECT *, LAST_VALUE(reading IGNORE NULLS) OVER p AS pv, LAST_VALUE(CASE WHEN reading IS NOT NULL THEN i END IGNORE NULLS) OVER p AS pi,
  FIRST_VALUE(reading IGNORE NULLS) OVER f AS nv, FIRST_VALUE(CASE WHEN reading IS NOT NULL THEN i END IGNORE NULLS) OVER f AS ni
  FROM e WINDOW p AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                f AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""
LINEAR = "COALESCE(reading, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL THEN pv + (nv - pv) * ((i - pi) / (ni - pi)) ELSE pv END)"


def readings(t):
    return t.events.select("event_id", "ts", "user_id", "event_type",
                           F.when(F.col("event_type") != "error", F.col("value")).alias("reading"))


ORDER = ["ts", "event_id"]


@query("nul1_drop_rows", """
WITH s AS (SELECT doc_id, quality, toxic, CASE WHEN lang = 'en' THEN lang END AS lang FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, 'any' AS how FROM s WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL
UNION ALL SELECT doc_id, 'all' FROM s WHERE quality IS NOT NULL OR toxic IS NOT NULL OR lang IS NOT NULL
UNION ALL SELECT doc_id, 'thresh' FROM s WHERE (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT + (lang IS NOT NULL)::INT >= 2
UNION ALL SELECT doc_id, 'subset' FROM s WHERE lang IS NOT NULL""")
def _(t):
    src = (t.documents.select("doc_id", F.when(F.col("lang") == "en", F.col("lang")).alias("lang"))
           .join(t.labels, "doc_id", "left"))
    cols = ["quality", "toxic", "lang"]
    cuts = {"any": src.na.drop("any", subset=cols), "all": src.na.drop("all", subset=cols),
            "thresh": src.na.drop(thresh=2, subset=cols), "subset": src.na.drop(subset=["lang"])}
    out = None
    for how, df in cuts.items():
        part = df.select("doc_id", F.lit(how).alias("how"))
        out = part if out is None else out.unionByName(part)
    return out


@query("nul2_fill_constant", """
SELECT doc_id, COALESCE(quality, -1) AS quality, COALESCE(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").na.fill({"quality": -1, "toxic": 0})


@query("nul3_fill_statistic", f"""
WITH r AS {READ}, s AS (SELECT CAST(SUM(CAST(reading AS DECIMAL(18,2))) AS DOUBLE) / COUNT(reading) AS m, QUANTILE_CONT(reading, 0.5) AS md FROM r),
mo AS (SELECT reading AS v FROM r WHERE reading IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
SELECT event_id, ROUND(COALESCE(reading, m), 6) AS with_mean, ROUND(COALESCE(reading, md), 6) AS with_median, COALESCE(reading, v) AS with_mode FROM r, s, mo""")
def _(t):
    df = N.fill_exact_mean(readings(t), "reading", "with_mean", scale=2)
    df = N.fill_statistic(df, "reading", "median", "with_median")
    df = N.fill_statistic(df, "reading", "mode", "with_mode")
    return df.select("event_id", F.round("with_mean", 6).alias("with_mean"), F.round("with_median", 6).alias("with_median"), "with_mode")


@query("nul4_fill_ordered", FILLED + "SELECT event_id, user_id, pv AS forward, nv AS backward FROM n")
def _(t):
    return N.fill_ordered(readings(t), "user_id", ORDER, "reading", "forward", "backward").select(
        "event_id", "user_id", "forward", "backward")


@query("nul5_interpolate_linear", FILLED + f"SELECT event_id, user_id, ROUND({LINEAR}, 5) AS filled FROM n")
def _(t):
    return N.interpolate(readings(t), "user_id", ORDER, "reading", "filled").select(
        "event_id", "user_id", F.round("filled", 5).alias("filled"))


@query("nul6_conditional_fill", FILLED + f"""
SELECT event_id, user_id, ROUND(CASE WHEN reading IS NOT NULL THEN reading WHEN DAY(ts) <= 10 OR DAY(ts) > 20 THEN {LINEAR} ELSE 0.0 END, 5) AS filled FROM n""")
def _(t):
    season = ~F.dayofmonth("ts").between(11, 20)
    return N.interpolate(readings(t), "user_id", ORDER, "reading", "filled", when=season, otherwise=F.lit(0.0)).select(
        "event_id", "user_id", F.round("filled", 5).alias("filled"))


@query("nul7_interpolate_nearest", FILLED + """
SELECT event_id, user_id, COALESCE(reading, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL THEN CASE WHEN i - pi <= ni - i THEN pv ELSE nv END END) AS filled FROM n""")
def _(t):
    return N.interpolate(readings(t), "user_id", ORDER, "reading", "filled", method="nearest").select(
        "event_id", "user_id", "filled")


@query("nul8_null_profile", f"""
WITH r AS {READ}, c AS (SELECT COUNT(*) AS n, COUNT(reading) AS a, COUNT(user_id) AS b FROM r)
SELECT 'reading' AS column_name, n - a AS nulls, ROUND((n - a) / n, 6) AS null_share FROM c
UNION ALL SELECT 'user_id', n - b, ROUND((n - b) / n, 6) FROM c""")
def _(t):
    return N.null_profile(readings(t), ["reading", "user_id"]).withColumn("null_share", F.round("null_share", 6))


@query("nul9_null_functions", """
SELECT doc_id, NULLIF(lang, 'en') AS not_en, COALESCE(NULLIF(lang, 'en'), source) AS lang_or_source, COALESCE(quality, -1) AS quality
FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left").selectExpr(
        "doc_id", "nullif(lang, 'en') AS not_en", "nvl(nullif(lang, 'en'), source) AS lang_or_source", "ifnull(quality, -1) AS quality")


@query("dup1_distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber").distinct()


@query("dup2_keep_first_last", """
WITH r AS (SELECT user_id, event_type, event_id, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS a,
  ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS b FROM events)
SELECT user_id, event_type, event_id, 'first' AS kept FROM r WHERE a = 1 UNION ALL SELECT user_id, event_type, event_id, 'last' FROM r WHERE b = 1""")
def _(t):
    cols, keys = ["user_id", "event_type", "event_id"], ["user_id", "event_type"]
    first = D.keep_one(t.events.select(*cols, "ts"), keys, ORDER).select(*cols, F.lit("first").alias("kept"))
    last = D.keep_one(t.events.select(*cols, "ts"), keys, ORDER, "last").select(*cols, F.lit("last").alias("kept"))
    return first.unionByName(last)


@query("dup3_run_starts", """
SELECT event_id, user_id, event_type FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
WHERE p IS DISTINCT FROM event_type""")
def _(t):
    return D.run_starts(t.events.select("event_id", "user_id", "event_type", "ts"), "user_id", ORDER, "event_type").drop("ts")


@query("dup4_list_dedup", """
WITH w AS (SELECT p_partkey, unnest(string_split(p_name || ' ' || lower(p_type) || ' ' || p_name, ' ')) AS x,
  generate_subscripts(string_split(p_name || ' ' || lower(p_type) || ' ' || p_name, ' '), 1) AS i FROM part),
f AS (SELECT p_partkey, x, MIN(i) AS i FROM w GROUP BY 1, 2)
SELECT p_partkey, string_agg(x, ' ' ORDER BY i) AS words FROM f GROUP BY 1""")
def _(t):
    words = F.split(F.concat_ws(" ", "p_name", F.lower("p_type"), "p_name"), " ")
    return t.part.select("p_partkey", F.array_join(F.array_distinct(words), " ").alias("words"))


@query("dup5_key_checks", """
SELECT COUNT(*) = COUNT(DISTINCT event_id) AS key_unique, bool_and(value >= p) AS never_falls
FROM (SELECT event_id, value, LAG(value) OVER (ORDER BY ts, event_id) AS p FROM events)""")
def _(t):
    return D.key_checks(t.events, "event_id", ORDER, "value")
