"""Text, date, numeric, array, map and JSON expressions."""

from pyspark.sql import functions as F

from sparkloom.catalog.games_sql import GAMES
from sparkloom.catalog.registry import query
from sparkloom.functions import arrays as A
from sparkloom.functions import dates as D
from sparkloom.functions import math as M
from sparkloom.functions import text as T
from sparkloom.operators.groups import exact_avg, whole
from sparkloom.plans import games as G


@query("str1_case_trim", """
SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, trim('  ' || p_name || ' ') AS trimmed, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS title FROM part""")
def _(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
                         F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"), F.initcap("p_type").alias("title"))


@query("str2_find_slice", """
SELECT p_partkey, CAST(instr(p_name, 'r') - 1 AS INTEGER) AS at, substr(p_name, 1, 3) AS head, right(p_name, 2) AS tail, substr(p_name, 3, 4) AS middle FROM part""")
def _(t):
    return t.part.select("p_partkey", T.find(F.col("p_name"), "r").alias("at"), F.substring("p_name", 1, 3).alias("head"),
                         F.expr("right(p_name, 2)").alias("tail"), F.substring("p_name", 3, 4).alias("middle"))


@query("str3_contains_extract", """
SELECT page_id, regexp_matches(url, 'page=') AS paged, CASE WHEN regexp_matches(url, '/([a-z]{2})/(\\d+)') THEN regexp_extract(url, '/([a-z]{2})/(\\d+)', 1) END AS lang,
 TRY_CAST(CASE WHEN regexp_matches(url, '/([a-z]{2})/(\\d+)') THEN regexp_extract(url, '/([a-z]{2})/(\\d+)', 2) END AS INTEGER) AS number FROM pages""")
def _(t):
    url, pattern = F.col("url"), r"/([a-z]{2})/(\d+)"
    return t.pages.select("page_id", url.rlike("page=").alias("paged"), T.extract(url, pattern, 1).alias("lang"),
                          T.extract(url, pattern, 2).try_cast("int").alias("number"))


@query("str4_split_parts", """
SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS level, split_part(o_orderpriority, '-', 2) AS word, (o_orderkey % 7 + o_orderkey % 11) / 2 AS middle FROM orders""")
def _(t):
    span = F.concat_ws("-", F.col("o_orderkey") % 7, F.col("o_orderkey") % 11)
    src = t.orders.withColumn("span", span)
    low, high = (T.part_of(F.col("span"), "-", i).cast("int") for i in (0, 1))
    return src.select("o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("level"),
                      T.part_of(F.col("o_orderpriority"), "-", 1).alias("word"), ((low + high) / 2).alias("middle"))


@query("str5_replace", r"""
SELECT c_custkey, replace(c_name, '#', '-') AS plain, regexp_replace(c_name, '(\w+)#0*(\d+)', '\2 \1') AS swapped FROM customer""")
def _(t):
    return t.customer.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("-")).alias("plain"),
                             F.regexp_replace("c_name", r"(\w+)#0*(\d+)", "$2 $1").alias("swapped"))


@query("str6_concat_key", """
SELECT doc_id, COALESCE(CAST(quality AS VARCHAR), '') || '~' || COALESCE(lang, '') || '~' || COALESCE(source, '') AS doc_key, concat_ws('~', CAST(quality AS VARCHAR), lang) AS short_key
FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    both = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return both.select("doc_id", T.key_of("quality", "lang", "source").alias("doc_key"), F.concat_ws("~", "quality", "lang").alias("short_key"))


@query("str7_recompose_address", """
SELECT c_custkey, split_part(c_name, '#', 1) || ', ' || r_name || ', ' || n_name || ' ' || ltrim(split_part(c_name, '#', 2), '0') AS full_address
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def _(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    src = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    parts = F.split("c_name", "#")
    tail = F.concat_ws(" ", "n_name", F.regexp_replace(parts[1], "^0+", ""))
    return src.select("c_custkey", F.concat_ws(", ", parts[0], "r_name", tail).alias("full_address"))


@query("str9_unicode", """SELECT doc_id, md5(strip_accents(text)) AS plain, md5(nfc_normalize(text)) AS composed,
 md5(replace(lower(nfc_normalize(text)), 'ß', 'ss')) AS folded FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(T.strip_marks("text")).alias("plain"), F.md5(T.nfc("text")).alias("composed"),
                              F.md5(T.fold("text")).alias("folded"))


@query("str10_tokenize", r"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, w[1] AS first_token FROM
 (SELECT doc_id, list_filter(regexp_split_to_array(upper(replace(replace(text, '-', ' '), 'ß', 'ss')), '\s+'), lambda x: x <> '') AS w FROM documents)""")
def _(t):
    words = t.documents.select("doc_id", T.tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").alias("n_tokens"), F.get("w", F.lit(0)).alias("first_token"))


@query("str11_initial", "SELECT c_custkey, substr(c_name, 1, 1) || '. ' || split_part(c_name, '#', 2) AS short_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", T.initial(F.col("c_name")).alias("short_name"))


@query("dat1_parse_date", """
SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS parsed FROM orders""")
def _(t):
    raw = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t.orders.select("o_orderkey", F.try_to_date(raw, "dd/MM/yyyy").alias("parsed"))


@query("dat2_zones", """
SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Denver' AS denver, ts AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC' AS from_berlin FROM events""")
def _(t):
    ts = F.col("ts")
    return t.events.select("event_id", D.to_zone(ts, "UTC", "America/Denver").alias("denver"),
                           D.to_zone(ts, "Europe/Berlin", "UTC").alias("from_berlin"))


@query("dat3_names", """
SELECT o_orderkey, dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name, last_day(o_orderdate) = CAST(o_orderdate AS DATE) AS month_end,
 strftime(o_orderdate, '%d.%m.%y') AS text FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"),
                           (F.last_day(d.cast("date")) == d.cast("date")).alias("month_end"), F.date_format(d, "dd.MM.yy").alias("text"))


@query("dat4_calendar", """
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INTEGER) AS y, CAST(MONTH(o_orderdate) AS INTEGER) AS m, CAST(QUARTER(o_orderdate) AS INTEGER) AS q,
 CAST(YEAR(o_orderdate) + CASE WHEN MONTH(o_orderdate) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS season FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.quarter(d).alias("q"), D.season(d).alias("season"))


@query("dat5_add_days", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 90 AS before, CAST(o_orderdate AS DATE) + 30 AS after FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.expr("CAST(dateadd(DAY, -90, o_orderdate) AS DATE)").alias("before"),
                           F.date_add(F.col("o_orderdate").cast("date"), 30).alias("after"))


@query("dat6_epoch", "SELECT event_id, CAST(FLOOR(epoch(ts)) AS BIGINT) AS seconds FROM events")
def _(t):
    return t.events.select("event_id", D.epoch(F.col("ts")).alias("seconds"))


@query("mth1_scaling", """
WITH s AS (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS m, STDDEV_POP(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, ROUND(LN(o_totalprice), 6) AS log_price, ROUND((o_totalprice - m) / sd, 6) AS z, ROUND((o_totalprice - lo) / (hi - lo), 6) AS unit FROM orders, s""")
def _(t):
    s = whole(t.orders, lo=F.min("o_totalprice"), hi=F.max("o_totalprice"), m=exact_avg("o_totalprice"), sd=F.stddev_pop("o_totalprice"))
    x = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.round(F.log(x), 6).alias("log_price"), F.round(M.z_score(x, s["m"], s["sd"]), 6).alias("z"),
                           F.round(M.min_max(x, s["lo"], s["hi"]), 6).alias("unit"))


@query("mth2_rounding", """
SELECT c_custkey, ROUND(c_acctbal / 7, 3) AS rounded, ABS(c_acctbal) AS size, ROUND(SQRT(ABS(c_acctbal)), 6) AS root,
 ROUND(SQRT(c_acctbal * c_acctbal + c_nationkey * c_nationkey), 6) AS hyp, ROUND(ATAN2(c_acctbal, c_nationkey), 6) AS angle FROM customer""")
def _(t):
    b = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.round(b / 7, 3).alias("rounded"), F.abs(b).alias("size"), F.round(F.sqrt(F.abs(b)), 6).alias("root"),
                             F.round(F.hypot(b, F.col("c_nationkey")), 6).alias("hyp"), F.round(F.atan2(b, F.col("c_nationkey")), 6).alias("angle"))


@query("mth3_efficiency", GAMES + "SELECT game_id, team_id, ROUND(oe, 6) AS offensive_efficiency, ROUND(scoring_margin, 4) AS scoring_margin FROM games")
def _(t):
    return G.team_games(t.lineitem, t.orders).select("game_id", "team_id", F.round("oe", 6).alias("offensive_efficiency"),
                                                     F.round("scoring_margin", 4).alias("scoring_margin"))


@query("mth4_order_total", """
SELECT l_orderkey, l_linenumber, l_partkey, ROUND(l_extendedprice - l_extendedprice * l_discount + l_extendedprice * l_tax + COALESCE(CASE WHEN l_returnflag = 'N' THEN 4.5::DOUBLE END, 0), 6) AS total_amount FROM lineitem""")
def _(t):
    price = F.col("l_extendedprice")
    shipping = F.when(F.col("l_returnflag") == "N", F.lit(4.5))
    total = M.order_total(price, price * F.col("l_discount"), price * F.col("l_tax"), shipping)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(total, 6).alias("total_amount"))


@query("arr1_vector_algebra", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
SELECT vec_id, ROUND(list_sum(list_transform(e, lambda x: x * x)), 6) AS dot, ROUND(SQRT(list_sum(list_transform(e, lambda x: x * x))), 6) AS norm, ROUND(e[1] + e[2], 6) AS first_sum,
 ROUND(e[64], 6) AS padded_tail, ROUND(e[3] * 2.5, 6) AS scaled FROM v""")
def _(t):
    e = F.col("embedding")
    shifted = F.slice(e, 2, 63)
    total = A.add(e, shifted)
    return t.embeddings.select("vec_id", F.round(A.dot(e, e), 6).alias("dot"), F.round(A.norm(e), 6).alias("norm"),
                               F.round(total[0], 6).alias("first_sum"), F.round(total[63], 6).alias("padded_tail"),
                               F.round(A.scale(e, 2.5)[2], 6).alias("scaled"))


@query("arr2_explode_collect", """
SELECT p_partkey, string_agg(DISTINCT w, '|' ORDER BY w) AS words, COUNT(*) AS n FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1""")
def _(t):
    words = t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("w"))
    # counted first: a list then holds each word of the vocabulary at most once
    counts = words.groupBy("p_partkey", "w").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("p_partkey").agg(F.array_join(F.array_sort(F.collect_list("w")), "|").alias("words"), F.sum("n").alias("n"))


@query("arr3_list_functions", """
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings)
SELECT vec_id, ROUND(list_sort(e)[1]::DOUBLE, 6) AS smallest, ROUND(list_sort(e)[len(e) - 1]::DOUBLE, 6) AS second_largest, len(list_filter(e, lambda x: x > 0.2)) > 0 AS any_large,
 len(list_filter(e, lambda x: x > -1)) = len(e) AS all_above, CAST(len(list_filter(e, lambda x: x > 0)) AS INTEGER) AS positives FROM v""")
def _(t):
    e = F.col("embedding")
    ordered = F.array_sort(e)
    return t.embeddings.select(
        "vec_id", F.round(ordered[0].cast("double"), 6).alias("smallest"), F.round(F.element_at(ordered, -2).cast("double"), 6).alias("second_largest"),
        F.exists(e, lambda x: x > 0.2).alias("any_large"), F.forall(e, lambda x: x > -1).alias("all_above"),
        F.size(F.filter(e, lambda x: x > 0)).alias("positives"))


@query("map1_lookup", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status_name,
 CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 20 WHEN '5-LOW' THEN 5 END AS code FROM orders""")
def _(t):
    def lit_map(d):
        return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    names = lit_map({"F": "finished", "O": "open"})
    merged = A.merge_maps(lit_map({"1-URGENT": 1, "2-HIGH": 2}), lit_map({"2-HIGH": 20, "5-LOW": 5}))
    return t.orders.select("o_orderkey", A.lookup(F.col("o_orderstatus"), names, default="unknown").alias("status_name"),
                           A.lookup(F.col("o_orderpriority"), merged).alias("code"))


@query("jsn1_object_paths", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type || '_' || json_extract_string(props, '$.k') AS ver_name, value AS coef FROM events""")
def _(t):
    made = t.events.withColumn("v", F.to_json(F.struct(
        F.concat_ws("_", "event_type", F.get_json_object("props", "$.k")).alias("VER_NAME"),
        F.col("value").alias("COEF"))))
    variant = F.parse_json("v")
    return made.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                       F.variant_get(variant, "$.VER_NAME", "string").alias("ver_name"),
                       F.variant_get(variant, "$.COEF", "double").alias("coef"))
