"""Feature builds and machine learning on tables."""

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkloom.catalog.games_sql import MATCH, V1, V2, rounded
from sparkloom.catalog.registry import query
from sparkloom.functions import text as T
from sparkloom.operators import ml as L
from sparkloom.operators.nulls import null_profile
from sparkloom.operators.pivots import pruned_neighbours
from sparkloom.operators.vectors import sentence_vectors, vote
from sparkloom.plans import games as G
from sparkloom.plans import registry as REG
from sparkloom.session import checkpointed

SIDES = [f"{s}_{c}" for s in ("home", "away") for c in G.FEATURES]


def round_doubles(df, digits=6):
    return df.select([F.round(c, digits).alias(c) if d == "double" else F.col(c) for c, d in df.dtypes])


def games(t):
    return G.team_games(t.lineitem, t.orders)


def matched(t):
    return G.matchups(G.features(games(t), ["team_id", "season"]))


@query("ml1_feature_build", V1 + MATCH)
def _(t):
    return round_doubles(matched(t))


@query("ml2_feature_build_second", V2 + MATCH)
def _(t):
    return round_doubles(G.matchups(G.features(games(t).distinct(), ["team_id"], extra_game=1, drop_incomplete=True)))


LATEST = V1 + """, lg AS (SELECT team_id, game_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY game_date DESC, game_id DESC) AS rn FROM games) WHERE rn = 1)
"""


@query("ml3_latest_features", LATEST + "SELECT f.team_id, f.game_id, f.game_date, f.season, " + rounded("f")
       + " FROM feat f JOIN lg ON f.team_id = lg.team_id AND f.game_id = lg.game_id")
def _(t):
    rows = checkpointed(games(t))
    pairs = checkpointed(G.matchups(G.features(rows, ["team_id", "season"], written=True)))  # read for each side
    return round_doubles(G.latest_features(pairs, rows))


@query("ml4_split", """
SELECT o_orderkey, CASE WHEN ('0x' || substr(md5('42:' || o_orderkey), 1, 2))::INTEGER < 204 THEN 'train' ELSE 'test' END AS part FROM orders""")
def _(t):
    train, test = L.split(t.orders.select("o_orderkey"), "o_orderkey", 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("ml5_time_window_set", """
SELECT event_id, CAST(HOUR(ts) AS INTEGER) AS hour, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value AS target FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""")
def _(t):
    inside = (F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return t.events.filter(inside).select("event_id", F.hour("ts").alias("hour"), F.get_json_object("props", "$.k").cast("double").alias("k"),
                                          F.col("value").alias("target"))


@query("ml6_scalers", """
WITH o AS (SELECT o_orderkey, o_totalprice AS x, ('0x' || substr(md5('42:' || o_orderkey), 1, 2))::INTEGER < 204 AS tr FROM orders),
s AS (SELECT AVG(x) AS m, STDDEV_POP(x) AS sd, MIN(x) AS lo, MAX(x) AS hi FROM o WHERE tr)
SELECT o_orderkey, ROUND((x - m) / sd, 5) AS standard, ROUND((x - lo) / (hi - lo), 6) AS minmax, ROUND(LN(x), 6) AS log FROM o, s WHERE NOT tr""")
def _(t):
    src = t.orders.select("o_orderkey", *[F.col("o_totalprice").alias(c) for c in ("standard", "minmax", "log")])
    train, test = L.split(src, "o_orderkey", 0.8)
    for method in ("standard", "minmax", "log"):
        test = L.scaled(test, train, [method], method)
    return test.select("o_orderkey", F.round("standard", 5).alias("standard"), F.round("minmax", 6).alias("minmax"), F.round("log", 6).alias("log"))


def text_rows(t):
    """Documents with a quality label and cheap numeric traits of the text."""
    text = F.col("text")
    words = F.size(T.tokens(text))
    lines = F.size(F.split(text, "\n"))
    traits = t.documents.select(
        "doc_id", F.length(text).cast("double").alias("chars"), words.cast("double").alias("words"),
        (F.length(text) / F.greatest(words, F.lit(1))).alias("word_length"), lines.cast("double").alias("lines"),
        F.regexp_count(text, F.lit("[0-9]")).cast("double").alias("digits"),
        F.regexp_count(text, F.lit(r"[.,;:!?]")).cast("double").alias("marks"))
    rows = traits.join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    return checkpointed(rows)  # training reads them many times; the texts are parsed once


TRAITS = ["chars", "words", "word_length", "lines", "digits", "marks"]


SPLIT = "('0x' || substr(md5('42:' || {0}), 1, 2))::INTEGER < 204"


@query("ml7_one_flag", f"""
WITH r AS (SELECT doc_id, quality AS label, CASE WHEN regexp_matches(text, '[0-9]') THEN 1 ELSE 0 END AS flag, {SPLIT.format('doc_id')} AS tr
  FROM documents JOIN labels USING (doc_id)),
p AS (SELECT flag, ROUND(AVG(label), 6) AS share FROM r WHERE tr GROUP BY 1)
SELECT doc_id, CAST(label AS DOUBLE) AS label, share, true AS met FROM r JOIN p USING (flag) WHERE NOT tr""")
def _(t):
    # with one 0/1 feature and no penalty the model gives the share of each group
    rows = t.documents.select("doc_id", F.col("text").rlike("[0-9]").cast("double").alias("flag")).join(
        t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    train, test = L.split(checkpointed(rows), "doc_id", 0.8)
    model = L.fit(train, ["flag"], L.estimator("logistic", "label", tol=1e-9))
    shares = train.groupBy("flag").agg(F.avg("label").alias("share"))
    return model.transform(test).join(shares, "flag").select(
        "doc_id", "label", F.round("share", 6).alias("share"), (F.abs(L.probability() - F.col("share")) < 0.005).alias("met"))


@query("ml7_logistic_regression")
def _(t):
    train, test = L.split(text_rows(t), "doc_id", 0.8)
    model = L.fit(L.scaled(train, train, TRAITS), TRAITS, L.estimator("logistic", "label", regParam=L.ridge_strength(train.count())))
    return model.transform(L.scaled(test, train, TRAITS)).select("doc_id", "label", "prediction", L.probability().alias("probability"))


TRAIT_SQL = f"""
WITH w AS (SELECT doc_id, quality::DOUBLE AS label, {SPLIT.format('doc_id')} AS tr, text,
  len(list_filter(regexp_split_to_array(upper(replace(replace(text, '-', ' '), 'ß', 'ss')), '\\s+'), lambda x: x <> ''))::DOUBLE AS words
  FROM documents JOIN labels USING (doc_id)),
f AS (SELECT doc_id, label, tr, length(text)::DOUBLE AS chars, words, length(text) / GREATEST(words, 1) AS word_length,
  len(string_split(text, chr(10)))::DOUBLE AS lines, len(regexp_extract_all(text, '[0-9]'))::DOUBLE AS digits,
  len(regexp_extract_all(text, '[.,;:!?]'))::DOUBLE AS marks FROM w),
u AS (UNPIVOT f ON chars, words, word_length, lines, digits, marks INTO NAME trait VALUE v),
s AS (SELECT trait, MIN(v) AS lo, MAX(v) AS hi FROM u WHERE tr GROUP BY 1),
x AS (SELECT doc_id, label, tr, trait, GREATEST((v - lo) / (hi - lo), 0.0) AS v FROM u JOIN s USING (trait)),
n AS (SELECT label AS c, COUNT(*) AS n FROM f WHERE tr GROUP BY 1),
t AS (SELECT label AS c, trait, SUM(v) AS weight, COUNT(*) FILTER (WHERE v > 0.1::DOUBLE) AS n_set FROM x WHERE tr GROUP BY 1, 2),
a AS (SELECT c, SUM(weight) AS total FROM t GROUP BY 1),
g AS (SELECT doc_id, label, c, LN(MAX(n) + 1) + SUM(v * (LN(weight + 1) - LN(total + 6))) AS multinomial,
  LN(MAX(n) + 1) + SUM(CASE WHEN v > 0.1::DOUBLE THEN LN(n_set + 1) ELSE LN(n - n_set + 1) END - LN(n + 2)) AS bernoulli
  FROM x JOIN t USING (trait) JOIN n USING (c) JOIN a USING (c) WHERE NOT tr GROUP BY 1, 2, 3)
"""


@query("ml8_naive_bayes", TRAIT_SQL + """
SELECT 'nb_multinomial' AS model, doc_id, label, arg_max(c, multinomial) AS prediction FROM g GROUP BY 2, 3
UNION ALL SELECT 'nb_bernoulli', doc_id, label, arg_max(c, bernoulli) FROM g GROUP BY 2, 3""")
def _(t):
    train, test = L.split(text_rows(t), "doc_id", 0.8)
    train, test = (d.withColumns({c: F.greatest(F.col(c), F.lit(0.0)) for c in TRAITS}) for d in (
        L.scaled(train, train, TRAITS, "minmax"), L.scaled(test, train, TRAITS, "minmax")))
    flags = [f"{c}_set" for c in TRAITS]
    train, test = (d.withColumns({f"{c}_set": (F.col(c) > 0.1).cast("double") for c in TRAITS}) for d in (train, test))
    scored = [L.fit(train, cols, L.estimator(name, "label")).transform(test).select(F.lit(name).alias("model"), "doc_id", "label", "prediction")
              for name, cols in (("nb_multinomial", TRAITS), ("nb_bernoulli", flags))]
    return scored[0].unionByName(scored[1])


@query("ml8_classifiers")
def _(t):
    train, test = L.split(text_rows(t), "doc_id", 0.8)
    train, test = L.scaled(train, train, TRAITS, "minmax"), L.scaled(test, train, TRAITS, "minmax")
    # naive Bayes needs non-negative (multinomial) or 0/1 (Bernoulli) features
    train, test = (d.withColumns({c: F.greatest(F.col(c), F.lit(0.0)) for c in TRAITS}) for d in (train, test))
    flags = [f"{c}_set" for c in TRAITS]
    train, test = (d.withColumns({f"{c}_set": (F.col(c) > 0.1).cast("double") for c in TRAITS}) for d in (train, test))
    parts = []
    for name in L.CLASSIFIERS:
        if name == "logistic":
            continue
        cols = flags if name == "nb_bernoulli" else TRAITS
        scored = L.fit(train, cols, L.estimator(name, "label")).transform(test)
        parts.append(scored.select(F.lit(name).alias("model"), "doc_id", "label", "prediction"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def price_rows(t):
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("list_price"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
                             F.col("l_tax").alias("tax"), F.col("l_extendedprice").alias("price")).join(parts, "l_partkey")


PRICE_COLS = ["quantity", "discount", "tax", "size", "list_price"]


ONE_FEATURE = f"""
WITH r AS (SELECT l_extendedprice AS y, l_quantity AS x, {SPLIT.format('l_orderkey')} AS tr FROM lineitem)
"""


def one_feature(t, **params):
    """Slope, intercept and R² on the test rows of a line fitted to the training rows."""
    rows = t.lineitem.select("l_orderkey", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    train, test = L.split(rows, "l_orderkey", 0.8)
    model = L.fit(train, ["x"], L.estimator("regressor.linear", "y", **params))
    line = model.stages[-1]
    return L.r2_score(model.transform(test), "y", "prediction").select(
        F.lit(round(float(line.coefficients[0]), 4)).alias("slope"), F.lit(round(float(line.intercept), 3)).alias("intercept"),
        F.round("r2", 6).alias("r2"))


@query("ml9_one_feature", ONE_FEATURE + """, m AS (SELECT REGR_SLOPE(y, x) AS a, REGR_INTERCEPT(y, x) AS b FROM r WHERE tr)
SELECT ROUND(a, 4) AS slope, ROUND(b, 3) AS intercept, ROUND(1 - SUM((y - a * x - b) * (y - a * x - b)) / (VAR_POP(y) * COUNT(*)), 6) AS r2 FROM r, m WHERE NOT tr GROUP BY a, b""")
def _(t):
    return one_feature(t)


@query("ml13_without_intercept", ONE_FEATURE + """, m AS (SELECT SUM(x * y) / SUM(x * x) AS a FROM r WHERE tr)
SELECT ROUND(a, 4) AS slope, 0.0::DOUBLE AS intercept, ROUND(1 - SUM((y - a * x) * (y - a * x)) / (VAR_POP(y) * COUNT(*)), 6) AS r2 FROM r, m WHERE NOT tr GROUP BY a""")
def _(t):
    return one_feature(t, fitIntercept=False)


@query("ml9_regressors")
def _(t):
    rows = price_rows(t).select(*PRICE_COLS, "price", L.in_train("l_orderkey").alias("train"))
    rows = checkpointed(rows)  # joined and split once; the models read them several times
    models = {name: L.estimator(f"regressor.{name}", "price") for name in L.REGRESSORS}
    return L.regressors(rows.filter("train"), rows.filter("not train"), PRICE_COLS, "price", models)


@query("ml10_nearest_neighbours", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, label, ('0x' || substr(md5('42:' || vec_id), 1, 2))::INTEGER < 204 AS tr FROM embeddings),
d AS (SELECT q.vec_id AS q, q.label AS y, x.label, ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, x.v), x.vec_id) AS rn FROM e q, e x WHERE NOT q.tr AND x.tr),
c AS (SELECT q, y, label, COUNT(*) AS n FROM d WHERE rn <= 5 GROUP BY 1, 2, 3)
SELECT q AS vec_id, y AS label, arg_max(label, (n, -label)) AS predicted, ROUND(SUM(label * n) / SUM(n), 6) AS regressed FROM c GROUP BY 1, 2""")
def _(t):
    train, test = L.split(t.embeddings, "vec_id", 0.8)
    found = vote(pruned_neighbours(test, train, "vec_id", "embedding", 5), train, "vec_id", "label")
    return test.select("vec_id", "label").join(found, F.col("vec_id") == F.col("query_vec_id")).select(
        "vec_id", "label", "predicted", F.round("regressed", 6).alias("regressed"))


REPORT = """
WITH p AS (SELECT quality AS y, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS p FROM labels JOIN documents USING (doc_id)),
c AS (SELECT k AS class, COUNT(*) FILTER (WHERE y = k AND p = k) AS hit, COUNT(*) FILTER (WHERE y = k) AS support, COUNT(*) FILTER (WHERE p = k) AS guessed FROM p, (VALUES (0), (1)) v(k) GROUP BY 1),
m AS (SELECT *, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS pr, hit / support AS rc FROM c), f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f1 FROM m)
SELECT CAST(class AS VARCHAR) AS class, ROUND(pr, 6) AS precision, ROUND(rc, 6) AS recall, ROUND(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'accuracy', ROUND(SUM(hit) / SUM(support), 6), ROUND(SUM(hit) / SUM(support), 6), ROUND(SUM(hit) / SUM(support), 6), SUM(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', ROUND(AVG(pr), 6), ROUND(AVG(rc), 6), ROUND(AVG(f1), 6), SUM(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', ROUND(SUM(pr * support) / SUM(support), 6), ROUND(SUM(rc * support) / SUM(support), 6), ROUND(SUM(f1 * support) / SUM(support), 6), SUM(support)::BIGINT FROM f"""


@query("ml11_classification_report", REPORT)
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").alias("y"), (F.col("n_chars") > 400).cast("int").alias("p"))
    return round_doubles(L.classification_report(rows, "y", "p"), 6)


@query("ml12_r2_score", """
WITH x AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * p_retailprice AS p FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_returnflag, ROUND(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 6) AS r2 FROM x GROUP BY 1""")
def _(t):
    rows = t.lineitem.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey")).select(
        "l_returnflag", "l_extendedprice", (F.col("l_quantity") * F.col("p_retailprice")).alias("guess"))
    return L.r2_score(rows, "l_extendedprice", "guess", ["l_returnflag"]).withColumn("r2", F.round("r2", 6))


@query("ml13_parameters_by_name")
def _(t):
    train, test = L.split(price_rows(t), "l_orderkey", 0.8)
    shallow = L.fit(train, PRICE_COLS, L.estimator("regressor.tree", "price", maxDepth=2, maxBins=16))
    deep = L.fit(train, PRICE_COLS, L.estimator("regressor.tree", "price", maxDepth=6, maxBins=64))
    a = L.r2_score(shallow.transform(test), "price", "prediction").withColumn("max_depth", F.lit(shallow.stages[-1].getMaxDepth()))
    b = L.r2_score(deep.transform(test), "price", "prediction").withColumn("max_depth", F.lit(deep.stages[-1].getMaxDepth()))
    return a.unionByName(b)


@query("ml14_score_upcoming")
def _(t):
    rows = checkpointed(games(t))
    pairs = checkpointed(G.matchups(G.features(rows, ["team_id", "season"], written=True)))
    train = pairs.na.drop()
    model = L.fit(L.scaled(train, train, SIDES), SIDES, L.estimator("logistic", "home_w"))
    # each team next plays at home against the team it last met
    last = G.last_game(rows).select("game_id", F.col("team_id").alias("home_team_id"))
    met = rows.select("game_id", F.col("team_id").alias("away_team_id"))
    upcoming = last.join(met, "game_id").filter("home_team_id <> away_team_id")
    scored = model.transform(L.scaled(G.score_inputs(upcoming, G.latest_features(pairs, rows)), train, SIDES))
    return scored.select("game_id", "home_team_id", "away_team_id",
                         F.when(F.col("prediction") == 1, "HOME TEAM").otherwise("AWAY TEAM").alias("model_prediction"))


@query("ml15_model_registry", """
WITH w AS (SELECT i AS window_id, TIMESTAMP '1995-01-01' + INTERVAL 1 MONTH * (12 * i) AS beg, TIMESTAMP '1995-01-01' + INTERVAL 1 MONTH * (12 * (i + 1)) AS "end" FROM generate_series(0, 4) g(i))
SELECT CAST(window_id AS INTEGER) AS window_id, beg, "end", window_id < 2 AS run, CASE WHEN window_id < 2 THEN (SELECT COUNT(*) FROM orders WHERE o_orderdate >= beg AND o_orderdate < "end") END AS n_rows FROM w""")
def _(t):
    data = t.orders.select("o_orderdate", F.col("o_totalprice").alias("y"), F.dayofyear("o_orderdate").cast("double").alias("x"),
                           F.month("o_orderdate").cast("double").alias("m"))
    reg = REG.windows(t.spark, "1995-01-01", 12, 4)
    reg = REG.append_window(reg, F.expr("TIMESTAMP_NTZ '1999-01-01'"), F.expr("TIMESTAMP_NTZ '2000-01-01'"))
    for _ in range(2):
        reg = REG.train_next(reg, data, "o_orderdate", ["x", "m"], "y")
    return reg.select("window_id", "beg", "end", "run", "n_rows")


def word_rows(docs, embeddings):
    """Tokens with a vector key: the tables hold no word vectors, so a token's letters pick one of all vectors."""
    vectors = embeddings.agg(F.count(F.lit(1))).scalar()
    rows = T.token_rows(docs, "doc_id", "text", out="w")
    w = F.col("w")
    return rows.select("doc_id", ((F.ascii(w) * 31 + F.ascii(F.substring(w, -1, 1)) * 7 + F.length(w)) % vectors).cast("bigint").alias("word"))


@query("ml16_text_forest")
def _(t):
    docs = t.documents.join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    vocabulary = t.embeddings.select(F.col("vec_id").alias("word"), "embedding")
    vectors = sentence_vectors(docs, word_rows(docs, t.embeddings), "doc_id", vocabulary, "word", "embedding", 64)
    known = vectors.filter("weight > 0").select("doc_id", array_to_vector("mean").alias("features"))
    train, test = L.split(checkpointed(docs.select("doc_id", "label").join(known, "doc_id")), "doc_id", 0.67)
    return L.estimator("forest", "label").fit(train).transform(test).select("doc_id", "label", "prediction")


@query("ml17_simple_regression", """
SELECT CAST(YEAR(l_shipdate) AS INTEGER) AS y, ROUND(REGR_SLOPE(l_extendedprice, l_quantity), 4) AS slope, ROUND(REGR_INTERCEPT(l_extendedprice, l_quantity), 4) AS intercept,
 ROUND(REGR_R2(l_extendedprice, l_quantity), 6) AS r2, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    out = L.simple_regression(t.lineitem.withColumn("y", F.year("l_shipdate")), ["y"], "l_quantity", "l_extendedprice")
    return out.select("y", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


@query("nul10_known_kept", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax > 0 THEN l_extendedprice END AS known, true AS has_value FROM lineitem""")
def _(t):
    rows = price_rows(t).withColumn("known", F.when(F.col("tax") > 0, F.col("price")))
    out = L.model_fill(rows, "known", ["quantity", "discount", "size", "list_price"], "filled",
                       L.estimator("regressor.boosted", "known", maxIter=5))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("tax") > 0, F.col("filled")).alias("known"),
                      F.col("filled").isNotNull().alias("has_value"))


@query("nul10_model_fill")
def _(t):
    rows = price_rows(t).withColumn("known", F.when(F.col("tax") > 0, F.col("price")))
    return L.model_fill(rows, "known", ["quantity", "discount", "size", "list_price"], "filled",
                        L.estimator("regressor.boosted", "known", maxIter=5)).select("l_orderkey", "l_linenumber", "l_partkey", "filled")


@query("nul3_imputer", """
SELECT 'reading' AS column_name, COUNT(*) FILTER (WHERE event_type = 'error') AS nulls, ROUND(COUNT(*) FILTER (WHERE event_type = 'error') / COUNT(*), 6) AS null_share FROM events
UNION ALL SELECT 'reading_imputed', 0, 0.0""")
def _(t):
    src = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("reading"))
    return round_doubles(null_profile(L.impute(src, ["reading"], "mean"), ["reading", "reading_imputed"]))
