"""Snapshots, incremental loads, streams, registry and the game features."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from sparkloom.plans import games as G
from sparkloom.plans import registry as REG
from sparkloom.plans import snapshots as S
from sparkloom.sources import files, sinks
from sparkloom.streaming import micro_batches as M


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_snapshot_maintenance(spark):
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "x", 2)], "k int, v string, at int")
    snap = S.versions(first, "k", "at")
    assert rows(snap.select("k", "v", "valid_from", "valid_to")) == [(1, "a", 1, 3), (1, "b", 3, None), (2, "x", 2, None)]
    load = spark.createDataFrame([(1, "c", 5), (2, "old", 1), (3, "new", 4)], "k int, v string, at int")
    after = S.maintain(snap, load, "k", "at")
    assert rows(after.select("k", "v", "valid_from", "valid_to")) == [
        (1, "a", 1, 3), (1, "b", 3, 5), (1, "c", 5, None), (2, "x", 2, None), (3, "new", 4, None)]
    again = S.maintain(after, load, "k", "at")
    assert rows(again.select("k", "v", "valid_from", "valid_to")) == rows(after.select("k", "v", "valid_from", "valid_to"))


def test_load_unseen_is_repeatable(spark):
    path = sinks.scratch(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    sinks.append_parquet(df.filter("k = 1"), path)
    for _ in range(2):
        sinks.load_unseen(df, path, ["k"])
    assert rows(spark.read.parquet(path)) == rows(df)


def test_preamble_and_vectors(spark):
    path = sinks.scratch(spark, "t")
    spark.createDataFrame([("# note",), ("a\tb",), ("5s\t15d",), ("1\tx",), ("2\t",)], "value string").write.text(path)
    assert rows(files.read_with_preamble(spark, path, "a int, b string")) == [(1, "x"), (2, None)]
    path = sinks.scratch(spark, "t")
    spark.createDataFrame([("cat 1.5 -2",)], "value string").write.text(path)
    assert rows(files.read_vectors(spark, path)) == [("cat", [1.5, -2.0])]


@pytest.fixture()
def events(spark):
    """Several files in time order, one per day."""
    path = sinks.scratch(spark, "events")
    for day in range(1, 6):
        spark.createDataFrame([(day * 10 + i, dt.datetime(2024, 1, day, 3 * i), i % 3, float(day)) for i in range(6)],
                              "id bigint, ts timestamp_ntz, u int, v double").coalesce(1).write.mode("append").parquet(path)
    return path, "id bigint, ts timestamp_ntz, u int, v double"


def test_streams_equal_batch(spark, events):
    path, schema = events
    batch = spark.read.schema(schema).parquet(path)
    stream = M.read_files(spark, path, schema, files_per_batch=2)
    totals = M.updated(stream.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")), ["u"], "a")
    assert rows(totals) == rows(batch.groupBy("u").agg(F.count(F.lit(1)), F.sum("v")))
    timed = M.timed(M.read_files(spark, path, schema, files_per_batch=2), "ts")
    days = M.updated(M.windowed(timed, "ts", "1 day", None, ["u"], n=F.count(F.lit(1))), ["window_start", "u"], "b")
    assert rows(days) == rows(batch.groupBy(F.date_trunc("day", "ts").alias("d"), "u").count())
    assert rows(M.appended(M.first_seen(M.read_files(spark, path, schema, files_per_batch=1), ["u"]), "c")) == [(0,), (1,), (2,)]


def test_files_in_reversed_time_order(spark):
    path, schema = sinks.scratch(spark, "reversed"), "id bigint, ts timestamp_ntz, u int, v double"
    for day in range(9, 0, -2):
        spark.createDataFrame([(day, dt.datetime(2024, day, 1, 5), day % 2, 1.0)], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times
    batch = spark.read.schema(schema).parquet(path)
    timed = M.timed(M.read_files(spark, path, schema, files_per_batch=1), "ts")
    days = M.updated(M.windowed(timed, "ts", "1 day", None, [], n=F.count(F.lit(1))), ["window_start"], "r")
    assert rows(days) == rows(batch.groupBy(F.date_trunc("day", "ts").alias("d")).count())
    keys = M.appended(M.first_seen(M.read_files(spark, path, schema, files_per_batch=1), ["u"]), "k")
    assert rows(keys) == [(1,)]


def test_append_keeps_earlier_loads(spark):
    target, schema = sinks.scratch(spark, "kept"), "id bigint, v int"
    spark.createDataFrame([(0, 0)], schema).write.parquet(f"{target}/load=first/batch=0")
    folders = [sinks.scratch(spark, "delivery") for _ in range(2)]
    for n, folder in enumerate(folders):
        spark.createDataFrame([(2 * n + 1, n), (2 * n + 2, n), (0, 9)], schema).write.parquet(folder)
    for folder in (folders[0], folders[1], folders[1], folders[0]):
        M.append_unseen(M.read_files(spark, f"{folder}/", schema), target, ["id"])
    assert rows(spark.read.parquet(target).select("id", "v")) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]
    spark.createDataFrame([(5, 5)], schema).write.mode("append").parquet(folders[0])  # goes on after a restart
    M.append_unseen(M.read_files(spark, f"{folders[0]}/", schema), target, ["id"])
    assert rows(spark.read.parquet(target).select("id")) == [(i,) for i in range(6)]


def test_stream_append_skips_held_keys(spark, events):
    path, schema = events
    target = sinks.scratch(spark, "target")
    held = spark.read.schema(schema).parquet(path).filter("u = 0")
    held.write.parquet(f"{target}/load=first/batch=0")
    for run in range(2):
        M.append_unseen(M.read_files(spark, path, schema, files_per_batch=2), target, ["id"], f"{target}-state{run}")
        assert spark.read.parquet(target).count() == 30
    assert spark.read.parquet(target).select("id").distinct().count() == 30


def test_registry(spark):
    data = spark.range(720).select(
        (F.expr("TIMESTAMP_NTZ '2020-01-01'") + F.make_dt_interval(F.col("id").cast("int"))).alias("ts"),
        F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    reg = REG.windows(spark, "2020-01-01", 6, 2)
    reg = REG.append_window(reg, F.expr("TIMESTAMP_NTZ '2021-01-01'"), F.expr("TIMESTAMP_NTZ '2021-07-01'"))
    assert REG.next_window(reg).first()["window_id"] == 0
    reg = REG.train_next(REG.train_next(reg, data, "ts", ["x"], "y"), data, "ts", ["x"], "y")
    state = {r["window_id"]: r for r in reg.collect()}
    assert [state[i]["run"] for i in range(3)] == [True, True, False]
    assert state[0]["n_rows"] == 182 and state[1]["r2"] == pytest.approx(1.0)
    assert state[0]["path"] != state[1]["path"] and REG.latest_path(reg) == state[1]["path"]
    assert REG.check_version(spark, REG.latest_path(reg))
    assert REG.load_latest(reg).transform(data.limit(1)).first()["prediction"] == pytest.approx(1.0, abs=1e-6)


def test_game_features(spark):
    day = [dt.date(2023, 1, d) for d in (1, 3, 6, 6)]
    game = "game_id int, team_id int, home_flag int, away_flag int, pts double, oe double, scoring_margin double, w int, season int, game_date date"
    data = []
    for i, w in enumerate((1, 0, 1, 1)):
        data.append((i, 1, 1 - i % 2, i % 2, 1.0, 0.1 * (i + 1), float(w * 2 - 1), w, 2023, day[i]))
        data.append((i, 2, i % 2, 1 - i % 2, 1.0, 0.5, float(1 - 2 * w), 1 - w, 2023, day[i]))
    df = spark.createDataFrame(data, game)
    pct = {r["game_id"]: r for r in G.win_percentages(df).filter("team_id = 1").collect()}
    # games of one day share the average rank: 3.5
    assert [pct[i]["total_win_pctg"] for i in range(4)] == pytest.approx([1.0, 0.5, 2 / 3.5, 3 / 3.5])
    assert pct[0]["away_win_pctg"] is None and pct[1]["away_win_pctg"] == 0.0
    feats = {r["game_id"]: r for r in G.features(df, ["team_id", "season"]).filter("team_id = 1").collect()}
    assert feats[0]["last_game_oe"] is None and feats[1]["num_rest_days"] == 2
    assert feats[3]["last_game_rolling_oe"] == pytest.approx(0.2)
    matched = G.matchups(G.features(df, ["team_id", "season"]))
    assert matched.count() == 4 and len([c for c in matched.columns if "last_game" in c or "rest" in c]) == 14
    second = G.features(df, ["team_id"], extra_game=1, drop_incomplete=True)
    assert second.filter("team_id = 1").count() == 3


def test_features_are_worked_out_once_for_both_sides(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    orders = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "o_orderkey bigint, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame([(i, s, n, 2.0, 10.0 * s + i, "N") for i in range(3) for n, s in ((1, 5), (2, 7))],
                                  "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string")
    games = G.team_games(lines, orders)
    pairs = G.matchups(G.features(games, ["team_id", "season"]))
    assert "Window" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(pairs.select("game_id", "home_team_id", "away_team_id", "home_last_game_total_win_pctg", "away_last_game_total_win_pctg").collect())
    assert [tuple(r) for r in got] == [(0, 5, 7, None, None), (1, 5, 7, 0.0, 1.0), (2, 5, 7, 0.0, 1.0)]
