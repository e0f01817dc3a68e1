"""SQL of the game rows shared by several queries."""

GAMES = """
WITH stats AS (SELECT l_orderkey, l_suppkey, SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS fg, COUNT(*) AS ast,
    SUM(l_quantity) AS fga, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS oreb, SUM(l_linenumber) AS tov,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS pts FROM lineitem GROUP BY 1, 2),
ends AS (SELECT l_orderkey, MIN(l_suppkey) AS h, MAX(l_suppkey) AS a FROM stats GROUP BY 1 HAVING MIN(l_suppkey) <> MAX(l_suppkey)),
sides AS (SELECT l_orderkey, h AS mine, a AS other, 1 AS home_flag FROM ends UNION ALL SELECT l_orderkey, a, h, 0 FROM ends),
games AS (SELECT s.l_orderkey AS game_id, s.mine AS team_id, s.home_flag, 1 - s.home_flag AS away_flag, m.pts,
    (m.fg + m.ast) / (m.fga - m.oreb + m.ast + m.tov) AS oe, m.pts - o.pts AS scoring_margin, CASE WHEN m.pts > o.pts THEN 1 ELSE 0 END AS w,
    CAST(YEAR(d.o_orderdate) AS INTEGER) AS season, CAST(d.o_orderdate AS DATE) AS game_date
  FROM sides s JOIN stats m ON m.l_orderkey = s.l_orderkey AND m.l_suppkey = s.mine
  JOIN stats o ON o.l_orderkey = s.l_orderkey AND o.l_suppkey = s.other JOIN orders d ON d.o_orderkey = s.l_orderkey)
"""

PCTG = GAMES + """,
rnk AS (SELECT *, RANK() OVER (PARTITION BY team_id, season ORDER BY game_date) + (COUNT(*) OVER (PARTITION BY team_id, season, game_date) - 1) / 2 AS played FROM games),
pct AS (SELECT *, SUM(w * home_flag) OVER ts / NULLIF({plus} + SUM(home_flag) OVER ts, 0) AS home_win_pctg,
    SUM(w * away_flag) OVER ts / NULLIF({plus} + SUM(away_flag) OVER ts, 0) AS away_win_pctg, SUM(w) OVER ts / played AS total_win_pctg
  FROM rnk WINDOW ts AS (PARTITION BY team_id, season ORDER BY game_date, game_id ROWS UNBOUNDED PRECEDING))
"""

FEATURE = PCTG + """,
roll AS (SELECT *, AVG(oe) OVER r AS rolling_oe, AVG(scoring_margin) OVER r AS rolling_scoring_margin,
    game_date - LAG(game_date) OVER (PARTITION BY {by} ORDER BY game_date, game_id) AS num_rest_days
  FROM pct WINDOW r AS (PARTITION BY {by} ORDER BY game_date, game_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
kept AS (SELECT * FROM roll WHERE {keep}),
feat AS (SELECT game_id, team_id, home_flag, w, season, game_date, CAST(num_rest_days AS INTEGER) AS num_rest_days, LAG(oe) OVER l AS last_game_oe,
    LAG(home_win_pctg) OVER l AS last_game_home_win_pctg, LAG(away_win_pctg) OVER l AS last_game_away_win_pctg,
    LAG(total_win_pctg) OVER l AS last_game_total_win_pctg, LAG(rolling_scoring_margin) OVER l AS last_game_rolling_scoring_margin,
    LAG(rolling_oe) OVER l AS last_game_rolling_oe FROM kept WINDOW l AS (PARTITION BY {by} ORDER BY game_date, game_id))
"""

F7 = ["last_game_oe", "last_game_home_win_pctg", "num_rest_days", "last_game_away_win_pctg",
      "last_game_total_win_pctg", "last_game_rolling_scoring_margin", "last_game_rolling_oe"]


def rounded(alias: str, prefix: str = "") -> str:
    return ", ".join(f"{alias}.{c} AS {prefix}{c}" if c == "num_rest_days" else f"ROUND({alias}.{c}, 6) AS {prefix}{c}" for c in F7)


V1 = FEATURE.format(plus=0, by="team_id, season", keep="true")
V2 = FEATURE.format(plus=1, by="team_id", keep="num_rest_days IS NOT NULL AND oe IS NOT NULL")
MATCH = ("SELECT h.game_id, h.season, h.game_date, h.team_id AS home_team_id, h.w AS home_w, " + rounded("h", "home_")
         + ", a.team_id AS away_team_id, " + rounded("a", "away_")
         + " FROM feat h JOIN feat a ON h.game_id = a.game_id AND h.season = a.season WHERE h.home_flag = 1 AND a.home_flag = 0")
