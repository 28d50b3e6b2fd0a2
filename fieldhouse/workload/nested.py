"""Nested-document queries: JSON and HTML built from the tables, then read back by the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse import schemas as sc
from fieldhouse.operators import nested as ns
from fieldhouse.operators import odds_match as om
from fieldhouse.operators.cleaning import clean_player_boxscores, clean_team_boxscores
from fieldhouse.session import pinned, stored
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, games, table


def parsed(df: DataFrame, doc: Column, ddl: str) -> DataFrame:
    """The document as JSON text, read back under its landing schema.

    Text and fields come out of generators, as later conditions on the fields are not moved below those: they would write and
    parse the document again, once per condition.
    """
    texts = df.select(F.explode(F.array(F.to_json(doc))).alias("json"))
    return texts.select(F.inline(F.array(F.from_json("json", ddl))))


def spread(games: DataFrame) -> DataFrame:
    """Games dealt evenly over as many tasks as shuffles have, before large documents are made of them.

    Adaptive execution sizes tasks by the bytes of the small rows, which leaves few tasks of uneven length.
    """
    tasks = int(games.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return games.repartition(tasks, F.xxhash64("gameId", "gameDate"))


def _side(side: str, name: str) -> Column:
    return F.col(f"{side}{name}")


def team_docs(spark, d):
    def doc(side: str, other: str) -> Column:
        runs = _side(side, "Runs").cast("long")
        stats = F.struct(
            (runs + 40).alias("possessions"), _side(side, "Hits").alias("rating"),
            (_side(side, "Hits") / 7).alias("gameScore"), _side(side, "OBP").alias("trueShooting"),
            F.struct(runs.alias("total"), F.array(runs, runs).alias("byPeriod"), (runs + 1).alias("offTurnovers")).alias("points"),
            F.struct(_side(side, "ERA").alias("offensiveReboundPct")).alias("fourFactors"))
        return F.struct(
            "gameId", _side(side, "TeamId").alias("teamId"), _side(other, "TeamId").alias("opponentId"),
            (_side(side, "Runs") * 1.5).alias("pace"), F.when(F.col("gameId") % 10 != 0, stats).alias("teamStats"))

    both = games(spark, d).select(F.explode(F.array(doc("home", "away"), doc("away", "home"))).alias("doc"))
    return parsed(both, F.col("doc"), sc.TEAM_BOXSCORE_JSON)


_TEAM_BOX = " UNION ALL ".join(f"""
SELECT gameId::VARCHAR AS gameId, {s}TeamId::VARCHAR AS teamId, {o}TeamId::VARCHAR AS opponentId, {s}Runs * 1.5::DOUBLE AS pace,
  ({s}Runs + 40)::BIGINT AS possessions, round({s}Hits, 6) AS rating, {s}OBP AS trueShooting, {s}Runs::BIGINT AS pointsTotal,
  ({s}Runs + 1)::BIGINT AS pointsOffTurnovers, {s}ERA AS fourFactorsOffensiveReboundPct FROM games WHERE gameId % 10 <> 0"""
                               for s, o in (("home", "away"), ("away", "home")))


@query("team_boxscore_documents", f"WITH {GAMES_CTE} {_TEAM_BOX}")
def team_boxscore_documents(spark, d):
    flat = ns.college_team_boxscores(ns.team_boxscores(team_docs(spark, d)))
    return flat.select("gameId", "teamId", "opponentId", "pace", "possessions", r6("rating"), "trueShooting",
                       "pointsTotal", "pointsOffTurnovers", "fourFactorsOffensiveReboundPct")


def player_docs(spark, d):
    def player(side: str) -> Column:
        return F.struct(
            F.concat(_side(side, "StartingPitcherId").cast("string"), F.lit(".0")).alias("athleteId"),
            F.concat(F.lit("Player "), _side(side, "StartingPitcherId")).alias("name"),
            (F.col("gameId") % 2 == 0).alias("starter"), _side(side, "Runs").cast("long").alias("points"),
            _side(side, "OBP").alias("usage"), F.struct(_side(side, "Runs").cast("long").alias("made"),
                                                        _side(side, "ERA").alias("pct")).alias("fieldGoals"))

    missing = F.lit(None).cast(games(spark, d).select(player("home").alias("p")).schema["p"].dataType)
    doc = F.struct("gameId", F.col("homeTeamId").alias("teamId"), F.col("awayTeamId").alias("opponentId"),
                   F.array(player("home"), missing, player("away")).alias("players"))
    return parsed(games(spark, d), doc, sc.PLAYER_BOXSCORE_JSON)


@query("player_boxscore_documents", f"""
WITH {GAMES_CTE} SELECT DISTINCT * FROM ({" UNION ALL ".join(f'''SELECT gameId::VARCHAR AS gameId, homeTeamId::VARCHAR AS teamId,
  {s}StartingPitcherId::VARCHAR AS athleteId, 'Player ' || {s}StartingPitcherId AS name, (gameId % 2 = 0)::INTEGER AS starter,
  {s}Runs::BIGINT AS points, {s}OBP AS usage, {s}Runs::BIGINT AS fieldGoalsMade, {s}ERA AS fieldGoalsPct FROM games'''
                                                         for s in ("home", "away"))})""")
def player_boxscore_documents(spark, d):
    return ns.college_player_boxscores(ns.player_boxscores(player_docs(spark, d))).select(
        "gameId", "teamId", "athleteId", "name", "starter", "points", "usage", "fieldGoalsMade", "fieldGoalsPct")


def line_docs(spark, d):
    def line(provider: Column, shift: int) -> Column:
        return F.struct(
            provider.alias("provider"), (F.col("homeSpread") + shift).alias("spread"),
            F.col("overUnder").cast("double").alias("overUnder"), F.col("homeMoneyline").cast("double").alias("homeMoneyline"),
            F.col("awayMoneyline").cast("double").alias("awayMoneyline"))

    third = F.when(F.col("gameId") % 5 != 0, "Caesar")
    doc = F.struct("gameId", F.array(
        line(F.lit("Bovada"), 0), line(F.lit("Bovada"), 1), line(third, 2)).alias("lines"))
    return parsed(games(spark, d), doc, sc.LINES_JSON)


@query("betting_line_documents", f"""
WITH {GAMES_CTE} SELECT gameId::VARCHAR AS gameId, 'Bovada' AS provider, homeSpread, overUnder::DOUBLE AS overUnder,
  homeMoneyline::DOUBLE AS homeMoneyline, awayMoneyline::DOUBLE AS awayMoneyline, NULL::DOUBLE AS spreadOpen, NULL::DOUBLE AS overUnderOpen FROM games
UNION ALL SELECT gameId::VARCHAR, 'Caesar', homeSpread + 2, overUnder::DOUBLE, homeMoneyline::DOUBLE, awayMoneyline::DOUBLE, NULL, NULL
FROM games WHERE gameId % 5 <> 0""")
def betting_line_documents(spark, d):
    return ns.college_lines(ns.game_lines(line_docs(spark, d)))


def roster_docs(spark, d):
    def player(key: Column) -> Column:
        return F.struct(
            F.concat(key.cast("string"), F.lit(".0")).alias("id"), F.concat(F.lit("Name "), key).alias("name"),
            F.lit("1990-01-01").alias("dateOfBirth"), (key % 30 + 170).alias("height"),
            F.struct(F.concat(F.lit("City "), key % 9).alias("city"), F.lit("US").alias("country"),
                     F.lit(1.0).alias("latitude")).alias("hometown"))

    k = F.col("p_partkey")
    doc = F.struct((k % 100).alias("teamId"), F.lit(2024).cast("long").alias("season"), F.array(
        player(k * 2), player(k * 2 + 1)).alias("players"))
    return parsed(table(spark, d, "part"), doc, sc.ROSTER_JSON)


@query("roster_documents", """
WITH p AS (SELECT p_partkey % 100 AS team, p_partkey * 2 + i AS key FROM part, range(2) t(i))
SELECT team::VARCHAR AS teamId, 2024::BIGINT AS season, key::VARCHAR AS playerId, 'Name ' || key AS name,
  (key % 30 + 170)::BIGINT AS height, 'City ' || key % 9 AS hometownCity FROM p""")
def roster_documents(spark, d):
    return ns.college_players(ns.rosters(roster_docs(spark, d))).select(
        "teamId", "season", "playerId", "name", "height", "hometownCity")


@query("roster_dropped_columns", """SELECT 'roster' AS document, count(*) * 2 AS rows, 0::BIGINT AS dropped_left FROM part""")
def roster_dropped_columns(spark, d):
    flat = ns.rosters(roster_docs(spark, d))
    left = len([c for c in ns.ROSTER_DROPPED if c in flat.columns])
    return flat.agg(F.lit("roster").alias("document"), F.count("*").alias("rows"), F.lit(left).cast("long").alias("dropped_left"))


# ---- baseball boxscores ------------------------------------------------------------------------------------


def baseball_docs(spark, d):
    """One document per game; every third away player appears without figures."""
    def club(side: str) -> Column:
        runs, pid = _side(side, "Runs").cast("long"), _side(side, "StartingPitcherId")
        batting = F.struct(runs.alias("runs"), (runs % 9).alias("homeRuns"), (runs % 5).alias("baseOnBalls"),
                           F.format_string("%.3f", _side(side, "OBP")).alias("obp"))
        pitching = F.struct(runs.alias("earnedRuns"), (runs * 3).alias("numberOfPitches"),
                            F.coalesce(F.format_string("%.2f", _side(side, "ERA")), F.lit("-.--")).alias("era"))
        idle = (F.col("gameId") % 3 == 0) & F.lit(side == "away")
        player = F.struct(
            F.struct(F.lit("P").alias("abbreviation")).alias("position"), F.lit("100").alias("battingOrder"),
            F.struct(F.when(~idle, batting).alias("batting"), F.when(~idle, pitching).alias("pitching")).alias("stats"))
        return F.struct(
            F.struct(_side(side, "TeamId").alias("id")).alias("team"),
            F.struct(batting.alias("batting"), pitching.alias("pitching")).alias("teamStats"),
            F.create_map(F.concat(F.lit("ID"), pid), player).alias("players"))

    g = spread(games(spark, d))
    doc = F.struct(F.col("gameId").cast("string").alias("game_id"), club("away").alias("away"), club("home").alias("home"))
    return parsed(g, doc, sc.BASEBALL_BOXSCORE_JSON)


@query("baseball_team_boxscore_documents", f"""
WITH {GAMES_CTE} {" UNION ALL ".join(f'''SELECT gameId::VARCHAR AS game_id, {s}TeamId::VARCHAR AS team_id, {h} AS is_home, {s}Runs::INTEGER AS runs,
  ({s}Runs % 9)::INTEGER AS home_runs, ({s}Runs % 5)::INTEGER AS walks, round({s}OBP, 3) AS obp, {s}Runs::INTEGER AS earned_runs,
  ({s}Runs * 3)::INTEGER AS pitches_thrown, round({s}ERA, 2) AS era FROM games''' for h, s in ((1, "home"), (0, "away")))}""")
def baseball_team_documents(spark, d):
    flat = clean_team_boxscores(ns.baseball_team_boxscores(baseball_docs(spark, d)))
    return flat.select("game_id", "team_id", "is_home", "runs", "home_runs", "walks", "obp", "earned_runs", "pitches_thrown", "era")


@query("baseball_player_boxscore_documents", f"""
WITH {GAMES_CTE}, both_sides AS (SELECT gameId::VARCHAR AS game_id, awayStartingPitcherId::VARCHAR AS player_id, awayTeamId::VARCHAR AS team_id, 0 AS is_home,
  'P' AS position, '100' AS batting_order, awayRuns::INTEGER AS runs, round(awayERA, 2) AS era FROM games WHERE gameId % 3 <> 0
UNION ALL SELECT gameId::VARCHAR, homeStartingPitcherId::VARCHAR, homeTeamId::VARCHAR, 1, 'P', '100', homeRuns::INTEGER, round(homeERA, 2) FROM games)
SELECT * FROM both_sides QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY is_home, team_id) = 1""")
def baseball_player_documents(spark, d):
    flat = clean_player_boxscores(ns.baseball_player_boxscores(baseball_docs(spark, d)))
    return flat.select("game_id", "player_id", "team_id", "is_home", "position", "batting_order", "runs", "era")


@query("mlb_team_documents", """
SELECT s_suppkey::VARCHAR AS team_id, '2024' AS season, s_name AS team_name, substr(s_name, 1, 3) AS team_abbr, NULL::VARCHAR AS franchise_name,
  NULL::VARCHAR AS club_name, 'Division ' || s_nationkey AS division, NULL::VARCHAR AS league, NULL::VARCHAR AS venue_name,
  NULL::VARCHAR AS first_year FROM supplier""")
def mlb_team_documents(spark, d):
    team = F.struct(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.substring("s_name", 1, 3).alias("abbreviation"),
        F.struct(F.concat(F.lit("Division "), "s_nationkey").alias("name")).alias("division"))
    doc = F.struct(F.lit(2024).alias("season"), F.array(team).alias("teams"))
    return ns.mlb_teams(parsed(table(spark, d, "supplier"), doc, sc.MLB_TEAMS_JSON))


@query("mlb_roster_documents", """
SELECT p_partkey::VARCHAR AS player_id, (p_partkey % 30)::VARCHAR AS team_id, '2024' AS season, p_name AS full_name,
  CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR END AS jersey_number, 'P' AS position_code, p_type AS position_name, NULL::VARCHAR AS position_type,
  'Active' AS status, '40Man' AS roster_type FROM part""")
def mlb_roster_documents(spark, d):
    player = F.struct(
        F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("fullName")).alias("person"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).alias("jerseyNumber"),
        F.struct(F.lit("P").alias("code"), F.col("p_type").alias("name")).alias("position"),
        F.struct(F.lit("Active").alias("description")).alias("status"))
    doc = F.struct((F.col("p_partkey") % 30).alias("team_id"), F.lit(2024).alias("season"),
                   F.lit("40Man").alias("roster_type"), F.array(player).alias("roster"))
    return ns.mlb_rosters(parsed(table(spark, d, "part"), doc, sc.MLB_ROSTER_JSON))


@query("mlb_schedule_documents", f"""
WITH {GAMES_CTE} SELECT gameId::VARCHAR AS game_id, season::VARCHAR AS season, gameDate AS game_datetime, awayTeamId::VARCHAR AS away_id,
  'Team ' || awayTeamId AS away_name, homeTeamId::VARCHAR AS home_id, 'Team ' || homeTeamId AS home_name, awayRuns::INTEGER AS away_score,
  homeRuns::INTEGER AS home_score, 'Final' AS status, CASE WHEN gameId % 8 = 0 THEN 'P' ELSE 'R' END AS game_type, NULL::VARCHAR AS venue_id,
  NULL::VARCHAR AS venue_name FROM games""")
def mlb_schedule_documents(spark, d):
    game = F.struct(
        F.col("gameId").alias("game_id"), F.date_format("gameDate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("game_datetime"),
        F.col("awayTeamId").alias("away_id"), F.concat(F.lit("Team "), "awayTeamId").alias("away_name"),
        F.col("homeTeamId").alias("home_id"), F.concat(F.lit("Team "), "homeTeamId").alias("home_name"),
        F.col("awayRuns").cast("int").alias("away_score"), F.col("homeRuns").cast("int").alias("home_score"),
        F.lit("Final").alias("status"), F.when(F.col("gameId") % 8 == 0, "P").alias("game_type"))
    doc = F.struct("season", F.array(game).alias("games"))
    return ns.mlb_schedule(parsed(games(spark, d), doc, sc.MLB_SCHEDULE_JSON))


# ---- odds pages --------------------------------------------------------------------------------------------


def odds_pages(spark, d, *keep, view: DataFrame | None = None):
    """One HTML page per game and bet type, half in the newer layout and half in the older one. `view`: the games, if they are at hand."""
    k = F.col("gameId")
    home, away = F.col("homeMoneyline"), F.col("awayMoneyline")
    lines = {
        "moneyline": F.struct(away.alias("awayOdds"), home.alias("homeOdds")),
        "spread": F.struct(F.lit(-110).alias("awayOdds"), F.lit(-105).alias("homeOdds"), (-F.col("homeSpread")).alias("awaySpread"),
                           F.col("homeSpread").alias("homeSpread")),
        "total": F.struct(F.col("overUnder").cast("double").alias("total"), F.lit(-112).alias("overOdds"), F.lit(-108).alias("underOdds")),
    }

    bare = {"moneyline": "awayOdds int, homeOdds int", "spread": "awayOdds int, homeOdds int, awaySpread double, homeSpread double",
            "total": "total double, overOdds int, underOdds int"}  # an empty object is no line

    def page(kind: str) -> Column:
        view = F.struct(
            k.cast("string").alias("gameId"),
            F.struct(F.when(k % 29 != 0, F.concat(F.lit("Team "), "awayTeamId")).alias("name")).alias("awayTeam"),
            F.struct(F.concat(F.lit("Team "), "homeTeamId").alias("name")).alias("homeTeam"),
            F.date_format("gameDate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("startDate"))
        books = F.array(
            F.struct(F.lit("alpha").alias("sportsbook"), lines[kind].alias("currentLine")),
            F.struct(F.lit(None).cast("string").alias("sportsbook"), lines[kind].alias("currentLine")),
            F.struct(F.lit("bare").alias("sportsbook"), F.from_json(F.lit("{}"), bare[kind]).alias("currentLine")),
            F.struct(F.lit("closed").alias("sportsbook"), F.when(F.lit(False), lines[kind]).alias("currentLine")))
        rows = F.array(F.struct(view.alias("gameView"), books.alias("oddsViews")))
        newer = k % 2 == 0
        one = F.struct(F.struct(F.when(newer, rows).alias("gameRows")).alias("oddsTableModel"), F.when(~newer, rows).alias("gameRows"))
        doc = F.to_json(F.struct(F.struct(F.struct(F.array(one).alias("oddsTables")).alias("pageProps")).alias("props")))
        html = F.concat(F.lit("<html><body><script>var a=1</script><script id=\"__NEXT_DATA__\" type=\"application/json\">"), doc,
                        F.lit("</script></body></html>"))
        return F.struct(F.to_date("gameDate").alias("date"), F.lit(kind).alias("bet_type"), html.alias("html"))

    return spread(games(spark, d) if view is None else view).select(*keep, F.explode(F.array(*[page(kind) for kind in ns.BET_TYPES])).alias("p")).select(*keep, "p.*")


_ODDS = """odds AS (SELECT gameDate::DATE AS date, gameId::VARCHAR AS game_id, gameDate AS game_time, 'Team ' || awayTeamId AS away_team,
  'Team ' || homeTeamId AS home_team, book AS sportsbook, bet_type,
  CASE WHEN bet_type = 'moneyline' THEN awayMoneyline END AS away_line, CASE WHEN bet_type = 'moneyline' THEN homeMoneyline END AS home_line,
  CASE WHEN bet_type = 'spread' THEN -homeSpread END AS away_spread, CASE WHEN bet_type = 'spread' THEN -110 END AS away_spread_odds,
  CASE WHEN bet_type = 'spread' THEN homeSpread END AS home_spread, CASE WHEN bet_type = 'spread' THEN -105 END AS home_spread_odds,
  CASE WHEN bet_type = 'total' THEN overUnder::DOUBLE END AS total, CASE WHEN bet_type = 'total' THEN -112 END AS over_odds,
  CASE WHEN bet_type = 'total' THEN -108 END AS under_odds
  FROM games, (SELECT unnest(['alpha', 'unknown']) AS book), (SELECT unnest(['moneyline', 'spread', 'total']) AS bet_type) WHERE gameId % 29 <> 0)"""


@query("odds_page_table", f"WITH {GAMES_CTE}, {_ODDS} SELECT * FROM odds")
def odds_page_table(spark, d):
    return ns.odds_table(ns.odds_lines(odds_pages(spark, d)))


@query("odds_pages_kept_aside", f"""
WITH {GAMES_CTE}, p AS (SELECT *, CASE WHEN gameId % 31 = 0 THEN 'cut' WHEN gameId % 37 = 0 THEN 'empty' WHEN gameId % 41 = 0 THEN 'bare' ELSE 'good' END AS state
  FROM games, (SELECT unnest(['moneyline', 'spread', 'total']) AS bet_type))
SELECT bet_type, count(*) AS pages, count(*) FILTER (state <> 'good') AS broken, count(*) FILTER (state = 'cut') AS cut,
  2 * count(*) FILTER (state = 'good' AND gameId % 29 <> 0) AS lines FROM p GROUP BY 1""")
def odds_pages_kept_aside(spark, d):
    """Pages cut off inside their data, empty ones and ones without the data element among good ones: none is lost uncounted."""
    k = F.col("gameId")
    html = F.when(k % 31 == 0, F.expr("left(html, length(html) - 60)")).when(k % 37 == 0, F.lit(None)).when(
        k % 41 == 0, F.lit("<html><body>closed</body></html>")).otherwise(F.col("html"))
    pages = odds_pages(spark, d, "gameId").withColumn("html", html)
    parsed = pinned(ns.parsed_pages(pages))
    lines = ns.lines_of(parsed).groupBy("bet_type").agg(F.count("*").alias("lines"))
    page = ns.broken_pages(parsed).groupBy("bet_type").agg(F.count("*").alias("broken"), F.count_if(F.col("page").startswith("{")).alias("cut"))
    every = parsed.groupBy("bet_type").agg(F.count("*").alias("pages"))
    return every.join(page, "bet_type").join(lines, "bet_type").select("bet_type", "pages", "broken", "cut", "lines")


@query("odds_union_of_shapes", f"WITH {GAMES_CTE}, {_ODDS} SELECT * EXCLUDE (date, game_time) FROM odds")
def odds_union_of_shapes(spark, d):
    lines = ns.odds_lines(odds_pages(spark, d))
    return ns.combine_odds(*[ns.shape_odds(lines, kind) for kind in ns.BET_TYPES]).drop("date", "game_time")


@query("one_book_per_game", f"""
WITH {GAMES_CTE} SELECT gameId::VARCHAR AS game_id, homeMoneyline, awayMoneyline, homeSpread, -homeSpread AS awaySpread, -105 AS homeSpreadOdds,
  -110 AS awaySpreadOdds, overUnder::DOUBLE AS overUnder, -112 AS overOdds, -108 AS underOdds FROM games WHERE gameId % 29 <> 0""")
def one_book_per_game(spark, d):
    return om.one_book_per_game(ns.odds_table(ns.odds_lines(odds_pages(spark, d))), "alpha")


@query("games_meet_odds", f"""
WITH {GAMES_CTE}, {_ODDS}, g AS (SELECT gameId::VARCHAR AS game_id, gameDate AS game_datetime, 'City Team ' || homeTeamId AS home_name,
  'City Team ' || awayTeamId AS away_name, homeRuns AS home_score, awayRuns AS away_score FROM games)
SELECT g.game_id, game_datetime, home_name AS full_home_name, away_name AS full_away_name, home_score, away_score, sportsbook, home_line, away_line
FROM g JOIN odds ON game_datetime = game_time AND contains(home_name, home_team) AND contains(away_name, away_team)""")
def games_meet_odds(spark, d):
    view = stored(games(spark, d).select(  # games and pages are both made of it
        "gameId", "gameDate", "homeTeamId", "awayTeamId", "homeRuns", "awayRuns", "homeMoneyline", "awayMoneyline", "homeSpread", "overUnder"))
    g = view.select(
        F.col("gameId").cast("string").alias("game_id"), F.col("gameDate").cast("timestamp").alias("game_datetime"),
        F.concat(F.lit("City Team "), "homeTeamId").alias("home_name"), F.concat(F.lit("City Team "), "awayTeamId").alias("away_name"),
        F.col("homeRuns").alias("home_score"), F.col("awayRuns").alias("away_score"))
    odds = ns.odds_table(ns.odds_lines(odds_pages(spark, d, view=view)))
    return om.match_odds(g, odds).select("game_id", "game_datetime", "full_home_name", "full_away_name", "home_score", "away_score",
                                         "sportsbook", "home_line", "away_line")


@query("baseball_game_view", f"""
WITH {GAMES_CTE} SELECT gameId::VARCHAR AS gameId, season, homeTeamId::VARCHAR AS homeTeamId, homeRuns, awayRuns, (homeRuns * 3) AS homePitches,
  CASE WHEN gameId % 29 <> 0 THEN homeMoneyline END AS homeMoneyline, CASE WHEN gameId % 29 <> 0 THEN overUnder::DOUBLE END AS overUnder
FROM games""")
def baseball_game_view(spark, d):
    g = games(spark, d).select(
        F.col("gameId").cast("string").alias("game_id"), "season", F.col("gameDate").alias("game_datetime"), F.lit("R").alias("game_type"),
        F.col("homeTeamId").cast("string").alias("home_id"), F.lit("h").alias("home_name"), F.col("awayTeamId").cast("string").alias("away_id"),
        F.lit("a").alias("away_name"), F.lit("v").alias("venue_id"), F.lit("v").alias("venue_name"), F.lit("Final").alias("status"))
    box = clean_team_boxscores(ns.baseball_team_boxscores(baseball_docs(spark, d)))
    view = om.baseball_game_view(g, box, ns.odds_table(ns.odds_lines(odds_pages(spark, d))), "alpha")
    return view.select("gameId", "season", "homeTeamId", "homeRuns", "awayRuns", (F.col("homeRuns") * 3).alias("homePitches"),
                       "homeMoneyline", "overUnder")


@query("college_game_view", f"""
WITH {GAMES_CTE} SELECT gameId::VARCHAR AS gameId, season, homeTeamId::VARCHAR AS homeTeamId, homeRuns AS homePoints,
  CASE WHEN gameId % 10 <> 0 THEN homeRuns * 1.5::DOUBLE END AS homePace, CASE WHEN gameId % 10 <> 0 THEN awayRuns * 1.5::DOUBLE END AS awayPace,
  CASE WHEN gameId % 10 <> 0 THEN homeERA END AS homeOrbPct, CASE WHEN gameId % 10 <> 0 THEN awayRuns + 1 END AS awayPointsOffTO,
  homeSpread, overUnder::DOUBLE AS overUnder FROM games""")
def college_game_view(spark, d):
    text = {c: F.col(c).cast("string").alias(c) for c in ("gameId", "homeTeamId", "awayTeamId")}
    g = games(spark, d).select(
        *text.values(), "season", F.col("gameDate").alias("startDate"), F.col("homeRuns").alias("homePoints"),
        F.col("awayRuns").alias("awayPoints"), F.lit(0).alias("conferenceGame"), F.lit(0).alias("neutralSite"))
    box = ns.college_team_boxscores(ns.team_boxscores(team_docs(spark, d)))
    lines = ns.college_lines(ns.game_lines(line_docs(spark, d)))
    return om.college_game_view(g, box, lines, "Bovada").select(
        "gameId", "season", "homeTeamId", "homePoints", "homePace", "awayPace", "homeOrbPct", "awayPointsOffTO", "homeSpread", "overUnder")


# ---- reference data ----------------------------------------------------------------------------------------


@query("college_game_documents", f"""
WITH {GAMES_CTE} SELECT gameId::VARCHAR AS gameId, season::BIGINT AS season, gameDate AS startDate, homeTeamId::VARCHAR AS homeTeamId,
  homeRuns::BIGINT AS homePoints, (gameId % 4 = 0)::INTEGER AS neutralSite, coalesce(homeRuns > awayRuns, false)::INTEGER AS homeWinner
FROM games WHERE gameId % 31 <> 0""")
def college_game_documents(spark, d):
    k = F.col("gameId")
    doc = F.struct(
        k.alias("id"), F.when(k % 31 != 0, k.cast("string")).alias("sourceId"), F.col("season").cast("long").alias("season"),
        F.date_format("gameDate", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("startDate"), F.when(k % 4 == 0, True).alias("neutralSite"),
        F.col("homeTeamId").alias("homeTeamId"), F.col("homeRuns").alias("homePoints"), F.array("homeRuns").cast("array<long>").alias("homePeriodPoints"),
        (F.col("homeRuns") > F.col("awayRuns")).alias("homeWinner"), (F.col("homeHits") / 7).alias("excitement"))
    return ns.college_games(parsed(games(spark, d), doc, sc.CBB_GAME_JSON)).select(
        "gameId", "season", "startDate", "homeTeamId", "homePoints", "neutralSite", "homeWinner")


@query("college_team_documents", """
SELECT s_suppkey::VARCHAR AS teamId, NULL::VARCHAR AS sourceId, s_name AS school, s_nationkey::VARCHAR AS conferenceId FROM supplier""")
def college_team_documents(spark, d):
    doc = F.struct(F.concat("s_suppkey", F.lit(".0")).alias("id"), F.lit("abc").alias("sourceId"), F.col("s_name").alias("school"),
                   F.concat("s_nationkey", F.lit(".0")).alias("conferenceId"))
    return ns.college_teams(parsed(table(spark, d, "supplier"), doc, sc.CBB_TEAM_JSON)).select(
        "teamId", "sourceId", "school", "conferenceId")


@query("college_venue_documents", """
SELECT c_custkey::VARCHAR AS venueId, c_nationkey::VARCHAR AS sourceId, c_name AS name, NULL::VARCHAR AS city, NULL::VARCHAR AS state,
  'US' AS country FROM customer WHERE c_custkey % 7 <> 0""")
def college_venue_documents(spark, d):
    k = F.col("c_custkey")
    doc = F.struct(F.when(k % 7 != 0, k.cast("string")).alias("id"), F.col("c_nationkey").cast("string").alias("sourceId"),
                   F.col("c_name").alias("name"), F.lit("US").alias("country"))
    return ns.college_venues(parsed(table(spark, d, "customer"), doc, sc.CBB_VENUE_JSON))


@query("college_conference_documents", """
SELECT n_nationkey::VARCHAR AS conferenceId, n_regionkey::VARCHAR AS sourceId, n_name AS name, substr(n_name, 1, 3) AS abbreviation,
  NULL::VARCHAR AS shortName FROM nation""")
def college_conference_documents(spark, d):
    doc = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_regionkey").cast("string").alias("sourceId"),
                   F.col("n_name").alias("name"), F.substring("n_name", 1, 3).alias("abbreviation"))
    return ns.college_conferences(parsed(table(spark, d, "nation"), doc, sc.CBB_CONFERENCE_JSON))


@query("event_props", "SELECT event_id, (props->>'$.k')::INTEGER AS k, coalesce((props->>'$.missing')::INTEGER, -1) AS missing FROM events")
def event_props(spark, d):
    p = F.from_json("props", "k int, missing int")
    return table(spark, d, "events").select("event_id", p["k"].alias("k"), F.coalesce(p["missing"], F.lit(-1)).alias("missing"))
