"""Game statistics and the win-loss feature build.

The tables have no games, so an order with lines of at least two suppliers stands for
one: its lowest supplier key is the home team, its highest the away team, and points
are the supplier's line prices in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.math import offensive_efficiency
from sparkloom.operators.columns import prefix_columns
from sparkloom.operators.groups import exact_sum, joined_on, ranked, top_rows
from sparkloom.operators.ordered import Rolling, Running, Shift, over_order
from sparkloom.session import checkpointed

SHIFTED = ["oe", "home_win_pctg", "away_win_pctg", "total_win_pctg", "rolling_scoring_margin", "rolling_oe"]
FEATURES = ["last_game_oe", "last_game_home_win_pctg", "num_rest_days", "last_game_away_win_pctg",
            "last_game_total_win_pctg", "last_game_rolling_scoring_margin", "last_game_rolling_oe"]


def team_games(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Two rows per game, one per side, with box scores, efficiency and scoring margin."""
    flag = F.col("l_returnflag")
    stats = lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(F.when(flag == "N", F.col("l_quantity")).otherwise(0.0)).alias("fg"),
        F.count(F.lit(1)).alias("ast"), F.sum("l_quantity").alias("fga"),
        F.count_if(flag == "R").alias("oreb"), F.sum("l_linenumber").alias("tov"),
        exact_sum("l_extendedprice").alias("pts"))
    box = F.struct("l_suppkey", "fg", "ast", "fga", "oreb", "tov", "pts")
    sides = (stats.groupBy("l_orderkey").agg(F.min(box).alias("h"), F.max(box).alias("a"))
             .filter("h.l_suppkey <> a.l_suppkey"))

    def side(mine: str, other: str, home: int):
        return F.struct(
            F.col(f"{mine}.l_suppkey").alias("team_id"), F.lit(home).alias("home_flag"),
            F.lit(1 - home).alias("away_flag"), F.col(f"{mine}.pts").alias("pts"),
            offensive_efficiency(*[F.col(f"{mine}.{c}") for c in ("fg", "ast", "fga", "oreb", "tov")]).alias("oe"),
            (F.col(f"{mine}.pts") - F.col(f"{other}.pts")).alias("scoring_margin"),
            (F.col(f"{mine}.pts") > F.col(f"{other}.pts")).cast("int").alias("w"))

    games = sides.select(F.col("l_orderkey").alias("game_id"),
                         F.inline(F.array(side("h", "a", 1), side("a", "h", 0))))
    dates = orders.select(F.col("o_orderkey").alias("game_id"), F.year("o_orderdate").alias("season"),
                          F.col("o_orderdate").cast("date").alias("game_date"))
    return games.join(dates, "game_id")


def win_percentages(games: DataFrame, extra_game: int = 0, **more: object) -> DataFrame:
    """Running win shares per team and season: home, away, total (games by average date rank)."""
    by, order = ["team_id", "season"], ["game_date", "game_id"]
    flagged = ranked(games, by, "game_date", prefix="_played").withColumns({"_hw": F.col("w") * F.col("home_flag"), "_aw": F.col("w") * F.col("away_flag")})
    run = over_order(checkpointed(flagged), by, order, {
        "_hg": Running("sum", "home_flag"), "_ag": Running("sum", "away_flag"),
        "_hws": Running("sum", "_hw"), "_aws": Running("sum", "_aw"), "_ws": Running("sum", "w"), **more},
        base=games)
    share: dict[str, Column] = {
        "home_win_pctg": F.try_divide(F.col("_hws").cast("double"), F.col("_hg") + extra_game),
        "away_win_pctg": F.try_divide(F.col("_aws").cast("double"), F.col("_ag") + extra_game),
        "total_win_pctg": F.try_divide(F.col("_ws").cast("double"), F.col("_played_avg"))}
    return run.withColumns(share).select(*games.columns, *share, *more)


def features(games: DataFrame, by: list[str], extra_game: int = 0, drop_incomplete: bool = False,
             written: bool = False) -> DataFrame:
    """Team rows with the values known before the game, as a written table, since both sides of a game read it.

    ``by`` is team and season, or team alone; version two also counts one extra home and
    away game and drops a team's first row before shifting. ``written`` says that ``games`` is a table already.
    """
    games = games if written else checkpointed(games)  # read several times below
    order = ["game_date", "game_id"]
    rolling = {"rolling_oe": Rolling("avg", "oe", 3), "rolling_scoring_margin": Rolling("avg", "scoring_margin", 3),
               "_last_date": Shift("game_date")}
    if by == ["team_id", "season"]:
        rows = win_percentages(games, extra_game, **rolling)
    else:
        rows = over_order(checkpointed(win_percentages(games, extra_game)), by, order, rolling, base=games)
    rows = rows.withColumn("num_rest_days", F.date_diff("game_date", "_last_date"))
    if drop_incomplete:
        rows = rows.na.drop("any")
    shifted = over_order(checkpointed(rows), by, order, {"last_game_" + c: Shift(c) for c in SHIFTED}, base=games)
    return checkpointed(shifted.select(*games.columns, *FEATURES))


def matchups(rows: DataFrame) -> DataFrame:
    """Home row next to away row of the same game: 14 features and the label."""
    keys = ["game_id", "season", "game_date"]
    home = rows.filter("home_flag = 1").select(*keys, "team_id", "w", *FEATURES)
    away = rows.filter("home_flag = 0").select("game_id", "season", "team_id", *FEATURES)
    return prefix_columns(home, "home_", keys).join(prefix_columns(away, "away_", keys), ["game_id", "season"])


def last_game(games: DataFrame) -> DataFrame:
    """Latest game of each team."""
    return top_rows(games, "team_id", [F.desc("game_date"), F.desc("game_id")])


def latest_features(matched: DataFrame, games: DataFrame) -> DataFrame:
    """Features of each team in its latest game, whichever side it played on."""
    latest = last_game(games).select("team_id", "game_id")

    def side(name: str) -> DataFrame:
        return matched.select(F.col(f"{name}_team_id").alias("team_id"), "game_id", "game_date", "season",
                              *[F.col(f"{name}_{c}").alias(c) for c in FEATURES]).join(latest, ["team_id", "game_id"])

    return side("away").unionByName(side("home")).distinct()


def score_inputs(upcoming: DataFrame, latest: DataFrame) -> DataFrame:
    """Upcoming games with the latest features of both sides."""
    table = latest.select("team_id", *FEATURES)
    out = upcoming
    for side in ("home", "away"):
        looked = table.select(F.col("team_id").alias(f"{side}_team_id"), *[F.col(c).alias(f"{side}_{c}") for c in FEATURES])
        out = joined_on(out, looked, f"{side}_team_id", "inner")
    return out
