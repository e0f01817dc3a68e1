"""Small frames with expected rows written by hand: nulls, ties, edges."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import arrays as A
from sparkloom.functions import dates as D
from sparkloom.functions import generators as U
from sparkloom.functions import text as T
from sparkloom.functions.math import clip
from sparkloom.operators import aggregates as G
from sparkloom.operators import binning as B
from sparkloom.operators import columns as C
from sparkloom.operators import dedup as DD
from sparkloom.operators import filters as R
from sparkloom.operators import joins as J
from sparkloom.operators import lineage as LG
from sparkloom.operators import ml as L
from sparkloom.operators import nulls as N
from sparkloom.operators import reshape as P
from sparkloom.operators import search as S
from sparkloom.operators import timeseries as TS
from sparkloom.operators import vectors as V
from sparkloom.operators.groups import exact_sum, top_rows, whole, with_group
from sparkloom.plans import warehouse as W
from sparkloom.sources import files as SF


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "3")], "a int, b double, c string")
    assert C.prefix_columns(df, "p_", ["a"]).columns == ["a", "p_b", "p_c"]
    assert C.select_dtypes(df).columns == ["a", "b"]
    assert C.select_like(df, regex="^[ab]$").columns == ["a", "b"]
    assert rows(df.select(C.try_cast("c", "int"))) == [(3,), (None,)]
    assert rows(df.select(C.row_sum("a", "b"), C.row_mean("a", "b"))) == [(2.0, 2.0), (3.0, 1.5)]
    assert C.drop_repeated_names(df.selectExpr("a", "b", "c AS a")).columns == ["a", "b"]


def test_aligned_add_keeps_both_sides(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, x double")
    b = spark.createDataFrame([(2, 1.0), (3, 2.0)], "k int, y double")
    assert rows(C.aligned_add(a, b, "k", "x", "y")) == [(1, None), (2, 21.0), (3, None)]
    assert rows(C.aligned_add(a, b, "k", "x", "y", 0.0)) == [(1, 10.0), (2, 21.0), (3, 2.0)]


def test_where_mask_choose(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "v int")
    out = df.select(R.where(F.col("v"), F.col("v") > 5, F.lit(0)), R.mask(F.col("v"), F.col("v") > 5, F.lit(0)),
                    R.choose([(F.col("v") > 8, "big"), (F.col("v") > 0, "small")], "none"))
    assert rows(out) == [(0, 1, "small"), (0, None, "none"), (9, 0, "big")]


def test_keep_groups_with_null_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    out = R.keep_groups(df, "k", F.col("n") >= 2, n=F.count(F.lit(1)))
    assert rows(out.select("id")) == [(1,), (2,), (3,), (4,)]


def test_regressors_read_rows_once_and_agree_with_models_of_rows(spark, monkeypatch):
    r = random.Random(3)
    data = [(float(r.randint(0, 50)), r.random(), r.choice([0.0, 1.5, -2.0, None]), 7.0) for _ in range(20_000)]  # sampled beyond 10,000
    data = [(i, a, b, c, d, None if i % 50 == 0 else 3 * a - 40 * b * b + (c or 0) * a + r.gauss(0, 5)) for i, (a, b, c, d) in enumerate(data)]
    table = spark.createDataFrame(data, "i int, a double, b double, c double, d double, y double").coalesce(2)
    train, test, cols = table.filter("i % 5 > 0"), table.filter("i % 5 = 0"), ["a", "b", "c", "d"]
    models = {k: L.estimator(f"regressor.{k}", "y") for k in L.REGRESSORS}
    want = {k: L.r2_score(L.fit(train, cols, m).transform(test), "y", "prediction").first().r2 for k, m in models.items()}
    fitted, fit = [], L.fit
    monkeypatch.setattr(L, "fit", lambda t, c, m: (fitted.append(type(m).__name__), fit(t, c, m))[1])
    out = L.regressors(train, test, cols, "y", models)
    assert out.columns == ["r2", "model"] and {m: v for v, m in out.collect()} == pytest.approx(want, abs=1e-9)
    assert fitted == ["RandomForestRegressor"]  # the others need sums of rows alone
    few, n = L.same_moments(train.na.drop(), cols, "y")
    assert few.count() == 10 and n == train.na.drop().count()
    assert L.same_moments(train.withColumn("y", F.lit(float("inf"))), cols, "y")[0] is None
    with pytest.raises(ValueError, match="no rows"):
        L.regressors(train.limit(0), test, cols, "y", models)
    with pytest.raises(ValueError, match="draws rows"):
        L.on_cells(train, cols, [[1.0]] * 4, [L.estimator("regressor.boosted", "y", subsamplingRate=0.5)])


def test_bins_put_a_value_at_a_limit_on_the_lower_side(spark):
    df = spark.createDataFrame([(-0.0, 1.0), (0.0, 2.0), (0.5, 3.0), (1.0, 4.0), (1.1, 5.0), (float("inf"), 6.0)], "x double, y double")
    got = [r.x_bin for r in L.with_bins(df, ["x"], [[0.0, 1.0]], ["x_bin"]).orderBy("y").collect()]
    assert got == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0]
    assert rows(L.cells(df, ["x"], "y", [[0.0, 1.0]])) == [(1.0, 1.5, 2.0), (2.0, 3.5, 2.0), (3.0, 5.5, 2.0)]


def test_models_that_keep_rows_read_few_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_TASK", 100, raising=False)
    held, fitted = [], L.Pipeline.fit

    def fit(self, df):
        held.append(df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first())
        return fitted(self, df)

    monkeypatch.setattr(L.Pipeline, "fit", fit)
    rows = spark.range(0, 1000, 1, 1).select("id", (F.col("id") % 7).cast("double").alias("x"), F.expr("if(id % 10 > 0, double(id % 7) * 2, null)").alias("y"),
                                             F.lit("t").alias("extra"))
    out = L.model_fill(rows, "y", ["x"], "filled", L.estimator("regressor.boosted", "y", maxIter=2)).collect()
    assert held[0][1] == 900 and held[0][0] <= 110
    assert len(out) == 1000 and all(r.extra == "t" and abs(r.filled - 2 * r.x) < 1e-6 for r in out)
    L.fit(rows, ["x"], L.estimator("regressor.linear", "y"))  # reads its rows once and keeps none
    assert held[1][1] == 900
    assert L.spread(rows, 1000) is rows and L.spread(rows.limit(0), 1000).count() == 0


def test_fill_and_interpolate(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, None), (4, None), (5, 4.0), (6, None)], "i int, v double")
    assert rows(N.interpolate(df, [], "i", "v", "f").select("i", "f")) == [(1, None), (2, 1.0), (3, 2.0), (4, 3.0), (5, 4.0), (6, 4.0)]
    near = N.interpolate(df, [], "i", "v", "f", method="nearest").select("i", "f")
    assert rows(near) == [(1, None), (2, 1.0), (3, 1.0), (4, 4.0), (5, 4.0), (6, None)]
    assert rows(N.fill_ordered(df, [], "i", "v", "fw", "bw").select("i", "fw", "bw"))[2] == (3, 1.0, 4.0)
    assert rows(N.fill_statistic(df, "v", "median", "m").select("m"))[0] == (1.0,)
    assert rows(N.null_profile(df, ["i", "v"])) == [("i", 0, 0.0), ("v", 4, pytest.approx(4 / 6))]


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "a")], "i int, k string")
    assert rows(DD.run_starts(df, [], "i", "k")) == [(1, "a"), (3, None), (5, "a")]
    assert [r[2] for r in rows(DD.runs(df, [], "i", "k"))] == [1, 1, 2, 2, 3]
    assert rows(DD.keep_one(df, ["k"], ["i"], "last")) == [(4, None), (5, "a")]
    assert rows(DD.key_checks(df, "i", ["i"], "i")) == [(True, True)]


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    some = spark.createDataFrame([(1,)], "b int")
    holed = spark.createDataFrame([(1,), (None,)], "b int")
    assert rows(J.not_in(df, "a", some, "b")) == [(2,)]
    assert rows(J.not_in(df, "a", holed, "b")) == []


def test_friend_acceptance(spark):
    asked = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (4, 5)], "a int, b int")
    taken = spark.createDataFrame([(1, 2), (2, 3), (2, 3)], "a int, b int")
    assert J.match_rate(asked, taken, ["a", "b"]).first()[0] == 0.5


def test_pairs_and_links(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x"), (3, "y")], "k int, c string")
    assert rows(J.pair_counts(df, "k", "c", ["x", "y"])) == [("x", "y", 1)]
    assert len(rows(J.pair_counts(df, "k", "c", ["x", "y"], ordered=True))) == 2
    talks = spark.createDataFrame([(1, [3, 1]), (2, [9])], "t int, ids array<int>")
    people = spark.createDataFrame([(1, "Ann"), (3, "Cy")], "p int, name string")
    assert rows(J.link_list(talks, "t", "ids", people, "p", "name", "who")) == [(1, ["Cy", "Ann"]), (2, None)]
    many = spark.createDataFrame([(1, list(range(1, 40)) * 3)], "t int, ids array<int>")
    assert rows(J.link_list(many, "t", "ids", people, "p", "name", "who")) == [(1, ["Ann", "Cy"] * 3)]
    assert rows(J.pair_counts(df, "k", "c", ["x"], rest="other")) == [("x", "other", 1)]
    assert rows(J.product_with_values(people, ["u", "v"], "w").select("p", "w")) == [(1, "u"), (1, "v"), (3, "u"), (3, "v")]


def test_latest_effective_row(spark):
    df = spark.createDataFrame([("x", 1, None, True), ("x", 3, 4, True), ("y", 2, 9, True), ("y", 5, 9, False)],
                               "k string, eff int, exp int, active boolean")
    out = J.latest_effective(df, "k", ["eff"], "exp", F.lit(6), F.col("active"))
    assert rows(out.select("k", "eff")) == [("y", 2)]


def test_aggregates(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, 0.3), (2, None)], "k int, v double")
    assert rows(df.groupBy("k").agg(exact_sum("v"))) == [(1, 0.3), (2, 0.3)]
    assert rows(G.count_of_counts(df, "k")) == [(2, 2)]
    assert rows(G.modes(df, "k", "v")) == [(1, 0.1, 1), (1, 0.2, 1), (2, 0.3, 1)]
    assert rows(with_group(df, [], n=F.count("v")).select("n").distinct()) == [(3,)]
    assert df.select((F.col("v") - whole(df, m=F.max("v"))["m"]).alias("x")).agg(F.max("x")).first()[0] == 0.0
    assert rows(top_rows(df, "k", [F.desc("v")], 1, ties="min").select("k", "v")) == [(1, 0.2), (2, 0.3)]
    hist = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    assert rows(G.histogram(hist, "v", 5)) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]


def test_login_counts(spark):
    df = spark.createDataFrame([(u, "2024-01-01") for u in (1, 1, 2, 3, 3, 4)], "user_id int, login string")
    assert rows(G.count_of_counts(df, "user_id", "logins", "users")) == [(1, 2), (2, 2)]


def test_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in (0, 1, 5, 10)], "v double")
    assert rows(B.cut_width(df, "v", 2, "b")) == [(0.0, 0), (1.0, 0), (10.0, 1), (5.0, 0)]
    assert rows(df.select(B.cut(F.col("v"), [0, 5, 9], ["lo", "hi"]))) == [("lo",), ("lo",), (None,), (None,)]
    assert [r[1] for r in rows(B.quantile_bins(df, [], "v", "q", ["a", "b"]))] == ["a", "a", "b", "b"]
    assert rows(df.select(clip(F.col("v"), 1, 6))) == [(1.0,), (1.0,), (5.0,), (6.0,)]
    names = spark.createDataFrame([(c,) for c in "aaabbccd"], "c string")
    out = B.keep_top(names, "c", "g", [(1, None), (2, "second")], "rest").distinct()
    assert rows(out) == [("a", "a"), ("b", "second"), ("c", "rest"), ("d", "rest")]
    label = B.by_substring(F.col("c"), {"a": "first", "aa": "last"}, "none")
    assert rows(spark.createDataFrame([("aa",), ("a",), ("z",)], "c string").select(label)) == [("first",), ("last",), ("none",)]


def test_melt_and_back(spark):
    df = spark.createDataFrame([("Ann", 95, 80), ("Bob", None, 60)], "name string, t1 int, t2 int")
    long = P.melt(df, ["name"], ["t1", "t2"], "test", "score")
    assert long.count() == 4
    assert rows(P.unmelt(long, ["name"], "test", "score", ["t1", "t2"])) == rows(df)


def test_crosstab_totals_and_shares(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "r string, c string")
    assert rows(P.crosstab_totals(df, "r", "c", ["x", "y"])) == [("All", 2, 1, 0, 3), ("a", 1, 1, 0, 2), ("b", 1, 0, 0, 1)]
    shares = P.crosstab_shares(df, "r", "c")
    assert shares.agg(F.sum("of_all")).first()[0] == pytest.approx(1.0)
    assert rows(P.crosstab(df, "r", "c", ["x", "y"])) == [("a", 1, 1, 0), ("b", 1, 0, 0)]
    more = df.union(spark.createDataFrame([("a", "z"), ("a", None)], "r string, c string"))
    assert rows(P.crosstab(more, "r", "c", ["x", "y"])) == [("a", 1, 1, 2), ("b", 1, 0, 0)]
    assert rows(P.crosstab_totals(more, "r", "c", ["x"])) == [("All", 2, 3, 5), ("a", 1, 3, 4), ("b", 1, 0, 1)]
    named = spark.createDataFrame([("All", "x"), ("All", "All"), ("b", "other")], "r string, c string")
    assert rows(P.crosstab_totals(named, "r", "c", ["x"])) == [("All", 1, 1, 2), ("All", 1, 2, 3), ("b", 0, 1, 1)]
    for call in (lambda: P.crosstab(named, "r", "c", ["x", "other"]), lambda: P.crosstab_totals(named, "r", "c", ["All"]),
                 lambda: P.pivot(named, "r", "c", ["other"], F.count("*"))):
        with pytest.raises(ValueError):
            call()
    assert rows(P.pivot(more, "r", "c", ["x"], F.count(F.lit(1)))) == [("a", 1, 3), ("b", 1, None)]


def test_dummies_round_trip(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "i int, c string")
    wide = P.dummies(df, "c", ["x", "y"], "d_").drop("c")
    assert rows(P.undummy(wide, "d_", ["x", "y"], "c").select("i", "c")) == rows(df)
    short = P.undummy(P.dummies(df, "c", ["x"], "d_").drop("c"), "d_", ["x"], "c").select("i", "c")
    assert rows(short) == [(1, "x"), (2, "other"), (3, None)]


def test_general_numbers(spark):
    small = spark.createDataFrame([(0.001,), (0.002,), (0.004,)], "v double")
    assert G.describe(small, [], "v").first()["mean"] == pytest.approx(0.007 / 3)
    same = spark.createDataFrame([(2.0, 2.0), (2.0, 1.0)], "v double, p double")
    assert rows(G.histogram(same, "v", 5)) == [(0, 2)]
    assert L.r2_score(same, "v", "p").first()["r2"] is None
    guess = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "y int, p int")
    out = {r["class"]: r for r in L.classification_report(guess, "y", "p").collect()}
    assert out["macro avg"]["precision"] == pytest.approx(2 / 3) and out["2"]["support"] == 0 == out["2"]["recall"]
    huge = spark.createDataFrame([(9e16,)] * 1200, "v double")
    assert huge.agg(exact_sum("v")).first()[0] == 9e16 * 1200


def test_channels_keep_every_state(spark):
    orders = spark.createDataFrame([(1, 7, "F", 10.0), (2, 7, "X", 5.0), (3, 7, None, 2.0)],
                                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double") \
        .withColumn("o_orderdate", F.expr("TIMESTAMP_NTZ '2020-01-01'"))
    buyer = spark.createDataFrame([(7,)], "c_custkey bigint")
    assert W.channel_metrics(orders, buyer).first()["lifetime_value"] == 17.0
    assert W.multi_channel(orders).count() == 3


def test_vectors_of_another_size_are_refused(spark):
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "k int, v array<double>")
    with pytest.raises(Exception, match="has not 2 elements"):
        V.mean_vectors(odd, "k", "v", 2).collect()


def test_delimited_text_round_trip(spark):
    from sparkloom.sources import files, sinks
    texts = ["a\tb", "line\nend\r\n", "back\\slash\\t", "\\", "\\\\n", "plain 'quoted' \"text\"", "é"]
    path = sinks.scratch(spark, "delimited")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("text", files.escaped(F.col("text")))
    sinks.write_csv(df, path, sep="\t", header=False)
    back = files.read_delimited(spark, path, "i int, text string").withColumn("text", files.unescaped(F.col("text")))
    assert rows(back) == list(enumerate(texts))


def test_text(spark):
    df = spark.createDataFrame([("Café-bar  no", "café GROß")], "a string, b string")
    out = df.select(T.tokens(F.col("a")), T.strip_marks("b"), T.fold("b"), T.nfc("b"), T.find(F.col("a"), "zz"),
                    T.extract(F.col("a"), r"(\d+)")).first()
    assert out[0] == ["CAFÉ", "BAR", "NO"]
    assert (out[1], out[2]) == ("cafe GROß", "café gross")
    assert (out[3], out[4], out[5]) == ("café GROß", -1, None)
    keys = spark.createDataFrame([("x", None, "z")], "a string, b string, c string")
    assert keys.select(T.key_of("a", "b", "c")).first()[0] == "x~~z"


def test_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 10, 2, 1, 30),)], "t timestamp_ntz")
    t = F.col("t")
    out = df.select(D.season(t), D.year_ending(t, 9), D.year_ending(t, 5), D.to_zone(t, "UTC", "America/Denver"),
                    D.epoch(t), D.month_block(t, F.lit("2016-07-15").cast("timestamp_ntz"), 2)).first()
    assert tuple(out) == (2017, dt.date(2017, 9, 30), dt.date(2017, 5, 31), dt.datetime(2016, 10, 1, 19, 30),
                          1475371800, dt.date(2016, 9, 1))


def test_arrays_and_maps(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0, 2.0])], "a array<float>, b array<float>")
    out = df.select(A.add(F.col("a"), F.col("b")), A.norm(F.col("a")), A.cosine(F.col("a"), F.col("a"))).first()
    assert tuple(out) == ([4.0, 4.0, 2.0], 5.0, pytest.approx(1.0))
    one = F.create_map(F.lit("x"), F.lit(1))
    two = F.create_map(F.lit("x"), F.lit(2), F.lit("y"), F.lit(3))
    got = df.select(A.merge_maps(one, two), A.lookup(F.lit("y"), one, two), A.lookup(F.lit("q"), one, default=0)).first()
    assert tuple(got) == ({"x": 2, "y": 3}, 3, 0)


def test_resample_keeps_empty_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), 1.0), (dt.datetime(2024, 1, 1, 9), 3.0), (dt.datetime(2024, 1, 3), 5.0)],
                               "t timestamp_ntz, v double")
    out = rows(TS.resample(df, "t", "v", "day").select("period", "sum", "mean", "median", "n"))
    assert out == [(dt.date(2024, 1, 1), 4.0, 2.0, 2.0, 2), (dt.date(2024, 1, 2), 0.0, None, None, 0), (dt.date(2024, 1, 3), 5.0, 5.0, 5.0, 1)]
    share = TS.month_share(df, "t", "v")
    assert share.first()["share"] == 1.0


def test_discount_rules(spark):
    lines = spark.createDataFrame([(1, i, 1.0, 10.0) for i in range(10)] + [(2, 1, 30.0, 15.0), (2, 2, 1.0, 5.0)],
                                  "o int, p int, q double, a double")
    points = spark.createDataFrame([(1, 0), (2, 1100)], "o int, f int")
    out = rows(S.discounts(lines, "o", "p", "q", "a", points, "f"))
    assert out == [(1, 100.0, 0.0, 0.0, pytest.approx(7.0), pytest.approx(7.0), pytest.approx(93.0)),
                   (2, 20.0, 1.0, 1.5, 0.0, 1.5, 18.5)]


def test_index(spark):
    docs = spark.createDataFrame([(1, "black cat"), (2, "Cat-black dog"), (3, "dog")], "id int, t string")
    index = S.postings(docs, "id", "t")
    assert rows(S.all_tokens(index, "id", "cat black")) == [(1,), (2,)]
    assert rows(U.words_by_generator(docs, "id", "t")) == rows(U.words_by_explode(docs, "id", "t"))


def test_vectors(spark):
    words = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1]), (4, [-1.0, 0.0])], "w bigint, v array<float>")
    query = V.vector_of(words, "w", 1, "v")
    assert [r[0] for r in V.nearest(words, "w", "v", query, 2, exclude=[1]).collect()] == [3, 2]
    assert V.analogy(words, "w", "v", 1, 2, 2, 1, keep_inputs=True).first()[0] == 1
    train = words.filter("w > 1")
    found = V.neighbours(words.filter("w = 1"), train, "w", "v", 2)
    assert rows(found.select("query_w", "w")) == [(1, 2), (1, 3)]
    many = V.neighbours(words, words, "w", "v", 2, per_pass=1)
    assert rows(many) == rows(V.neighbours(words, words, "w", "v", 2))
    docs = spark.createDataFrame([(1, [1, 1, 2]), (2, [9])], "d int, ws array<bigint>")
    tokens = docs.select("d", F.explode("ws").alias("w"))
    out = rows(V.sentence_vectors(docs, tokens, "d", words, "w", "v", 2).select("d", "mean", "weight"))
    assert out == [(1, [pytest.approx(2 / 3), pytest.approx(1 / 3)], 3), (2, None, 0)]


def test_lineage(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "c")], "src string, dst string")
    asked = spark.createDataFrame([("a",), ("x",)], "node string")
    pairs = set(map(tuple, LG.ancestors(edges, asked).collect()))
    assert pairs == {(s, "a") for s in "abcx"}
    assert rows(LG.upstream(edges.filter("src <> 'c'"), "c")) == [("a", 2), ("b", 1), ("x", 1)]
    dag = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "s string, d string")
    assert rows(LG.levels(dag, "s", "d")) == [("a", 0), ("b", 1), ("c", 2)]
    ring = spark.createDataFrame([("a", "b"), ("b", "a"), ("x", "a"), ("b", "c")], "s string, d string")
    assert rows(LG.levels(ring, "s", "d")) == [("a", 1), ("b", 1), ("c", 2), ("x", 0)]


def test_feed_of_unknown_keys(spark, tmp_path):
    lines = ['{"day": "d1", "games": [{"id": 1, "Tag": "x", "home": {"id": 7, "name": "H"}, "n": 1, "list": [1], "a.b\'c": true}]}',
             '{"day": "d2", "games": [{"id": 2, "tag": "y", "n": 1.5, "big": 12345678901234567890, "home": 5, "none": null}, 3]}',
             '{"day": "d3", "games": [{"id": "z", "n": {"k": 1}, "Day": "no", "home": {"id": "q"}}]}',
             '{"day": "d4"}', '{"games": []}']
    (tmp_path / "feed.json").write_text("\n".join(lines))
    feed = SF.read_open_feed(spark, str(tmp_path))
    out = SF.flatten_feed(feed, "$.games", {"day": "string"}, {"home_id": ("$.home.id", "bigint")})
    assert out.dtypes == [("day", "string"), ("a.b'c", "boolean"), ("big", "decimal(20,0)"), ("home", "bigint"), ("id", "string"),
                          ("n", "double"), ("Tag", "string"), ("home_id", "bigint")]
    assert rows(out) == [("d1", True, None, None, "1", 1.0, "x", 7),
                         ("d2", None, Decimal("12345678901234567890"), 5, "2", 1.5, "y", None),
                         ("d2", None, None, None, None, None, None, None),
                         ("d3", None, None, None, "z", None, None, None)]
    assert SF.flatten_feed(feed.limit(0), "$.games", {"day": "string"}, {}).columns == ["day"]


def test_closure_doubles_its_paths(spark, monkeypatch):
    written = []
    plain = LG.checkpointed
    monkeypatch.setattr(LG, "checkpointed", lambda df, name="stage": written.append(name) or plain(df, name))
    chain = spark.range(1, 1000).selectExpr("id - 1 AS src", "id AS dst")
    got = LG.ancestors(chain, spark.createDataFrame([(999,), (5,), (None,)], "node bigint"))
    assert got.count() == 999 + 5 and written.count("reach") <= 12
    assert rows(LG.upstream(chain, 700).agg(F.count("*"), F.max("distance"), F.sum("distance"))) == [(700, 700, 700 * 701 // 2)]


def test_closure_on_random_graphs(spark):
    for seed, n, m in ((1, 30, 25), (2, 16, 24)):
        rng = random.Random(seed)
        pairs = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
        edges = spark.createDataFrame([*pairs, *pairs, (None, 1), (2, None)], "src bigint, dst bigint")
        into = {b: {a for a, x in pairs if x == b} for b in range(n)}

        def above(b):
            seen, frontier, d = {}, {b}, 0
            while frontier:
                d += 1
                frontier = {a for x in frontier for a in into[x]} - set(seen)
                seen |= dict.fromkeys(frontier, d)
            return seen

        reach = {b: above(b) for b in range(n)}
        asked = spark.createDataFrame([(b,) for b in range(0, n, 2)], "node bigint")
        assert set(map(tuple, LG.ancestors(edges, asked).collect())) == {(a, b) for b in range(0, n, 2) for a in reach[b]}
        assert dict(map(tuple, LG.upstream(edges, 3).collect())) == {a: d for a, d in reach[3].items() if a != 3}
        held = {x for p in pairs for x in p}
        part = {x: max([x, *[y for y in held if y in reach[x] and x in reach[y]]]) for x in held}
        got = dict(map(tuple, LG.components(edges.toDF("a", "b")).collect()))
        assert got == {x: part[x] for x in held if any(part[y] == part[x] for y in held - {x})}
        level = {}
        while len(level) < len(held):
            for x in held - set(level):
                before = {part[a] for y in held if part[y] == part[x] for a in into[y]} - {part[x]}
                if all(y in level for y in held if part[y] in before):
                    level[x] = max([level[y] + 1 for y in held if part[y] in before], default=0)
        assert dict(map(tuple, LG.levels(edges, "src", "dst").collect())) == level


def test_levels_of_nothing(spark):
    assert rows(LG.levels(spark.createDataFrame([], "s string, d string"), "s", "d")) == []
    assert rows(LG.levels(spark.createDataFrame([("a", "a")], "s string, d string"), "s", "d")) == [("a", 0)]


def test_report_and_split(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, p int")
    out = {r["class"]: r for r in L.classification_report(df, "y", "p").collect()}
    assert out["1"]["precision"] == 0.5 and out["0"]["recall"] == pytest.approx(2 / 3)
    assert out["accuracy"]["f1"] == 0.6 and out["0"]["support"] == 3
    ids = spark.range(1000)
    train, test = L.split(ids, "id", 0.8)
    assert train.count() + test.count() == 1000 and 150 < test.count() < 250
    assert train.intersect(test).isEmpty()
    with pytest.raises(ValueError):
        L.estimator("tree", "y", depth=3)


def test_samples_are_repeatable(spark):
    ids = spark.range(500)
    assert rows(R.sample_exact(ids, "id", 10)) == rows(R.sample_exact(ids.repartition(7), "id", 10))
    marked = ids.withColumn("c", F.col("id") % 7)
    got = R.cluster_sample(marked, "c", 2)
    assert got.select("c").distinct().count() == 2
    assert got.count() == marked.join(got.select("c").distinct(), "c").count()


def test_batches_of_long_texts_are_bounded(spark):
    from pyspark.sql.types import LongType

    from sparkloom.session import prepare

    @F.pandas_udf(LongType())
    def held(text: pd.Series) -> pd.Series:
        return pd.Series([int(text.str.len().sum())] * len(text), dtype="int64")

    texts = prepare(spark).range(0, 400, 1, 1).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("é"), 50_000)).alias("t"))
    assert texts.select(held("t").alias("n")).agg(F.max("n")).first()[0] <= 4 << 20


def test_sentence_vectors_by_blocks(spark):
    docs = spark.createDataFrame([(i,) for i in (1, 2, 3, None)], "d bigint")
    words = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "z"), (2, None), (None, "b"), (3, "n")], "d bigint, w string")
    nan = float("nan")
    held = spark.createDataFrame([("a", [1.0, None]), ("b", [4.0, 6.0]), ("b", [0.0, nan]), ("n", None), ("n", [None, 2.0])], "w string, v array<float>")
    for per_block in (1, 2, 100):
        out = V.sentence_vectors(docs, words, "d", held, "w", "v", 2, per_block=per_block)
        got = {r["d"]: (r["weight"], r["mean"] and [str(x) for x in r["mean"]]) for r in out.collect()}
        assert got == {1: (4, ["1.5", "nan"]), 2: (0, None), 3: (2, ["None", "1.0"]), None: (2, ["2.0", "nan"])}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(get(" not in plan  # no task holds sums of the texts of all blocks


def test_quantile_levels_read_tables_of_known_size(spark):
    from sparkloom.operators.groups import quantiles
    rows = spark.range(2000).select((F.col("id") % 3).alias("k"), (F.col("id") * 0.25).alias("v"))
    out = quantiles(rows, "k", "v", {"m": 0.5})
    assert "BroadcastHashJoin" in out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
