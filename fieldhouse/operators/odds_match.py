"""Games meet betting odds, and the pivoted game views built from both."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldhouse.operators.cleaning import is_completed
from fieldhouse.operators.sizing import Limits, beside, lookup
from fieldhouse.session import stored


# What an odds row says of a game.
PRICES = ("sportsbook", "home_line", "away_line", "total", "over_odds", "under_odds", "home_spread", "home_spread_odds",
          "away_spread", "away_spread_odds")


# A start whose games and prices are fewer than this is never split.
LEAST_SPLIT_ROWS = 100_000


def _names_within(full: DataFrame, short: DataFrame) -> DataFrame:
    """`full` and `spots`: each full name with all short names that it contains, as places that `_piece` reads.

    Places are smaller than names, and what is put beside games is shuffled. Each distinct full name is cut into its pieces of the lengths that short names have, and the pieces meet the short
    names on equality, so names are never compared pair by pair.
    """
    short = short.distinct().where(F.length("short") > 0)
    lengths = short.agg(F.collect_set(F.length("short")).alias("_lengths"))  # no more than the longest name has letters
    size = F.length("full")
    pieces = F.flatten(F.transform(F.filter("_lengths", lambda n: n <= size), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(F.col("full"), i, n))))
    cut = beside(full.distinct().where(size > 0), lengths).select("full", F.explode(F.array_distinct(pieces)).alias("short"))
    spot = F.shiftleft(F.instr("full", F.col("short")).cast("long"), 32) + F.length("short")
    return cut.join(short, "short").groupBy("full").agg(F.collect_list(spot).alias("spots"))


def _piece(full: str, spot: Column) -> Column:
    return F.substring(F.col(full), F.shiftright(spot, 32).cast("int"), spot.bitwiseAND(2**32 - 1).cast("int"))


def _with_parts(tables: Sequence[DataFrame], tasks: int, limits: Limits) -> list[DataFrame]:
    """The tables with `_parts`: into how many tasks the rows of their `_time` go, 1 but for starts with very many rows.

    Those have at least a task's even share of all rows, so there are no more of them than tasks.
    """
    counted = reduce(DataFrame.unionAll, [t.select("_time") for t in tables]).groupBy("_time").agg(F.count("*").alias("_rows"))
    seen = counted.agg(F.sum("_rows").alias("every"), F.max("_rows").alias("most")).first()
    most = min(limits.group_rows, max((seen["every"] or 0) // tasks, LEAST_SPLIT_ROWS))
    if (seen["most"] or 0) <= most:
        return [t.withColumn("_parts", F.lit(1)) for t in tables]
    split = counted.where(F.col("_rows") > most).select("_time", F.ceil(F.col("_rows") / most).cast("int").alias("_parts"))
    return [t.join(F.broadcast(split), "_time", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))) for t in tables]


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows of one `_time` and `_part` in one task, whose number is `_task`."""
    task = F.pmod(F.xxhash64("_time", "_part"), F.lit(tasks)).cast("int")
    return rows.withColumn("_task", task).repartitionById(tasks, "_task")


def match_odds(games: DataFrame, odds: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Games and prices with the same start whose full names contain the short names of the odds.

    Both sides are written once, as names and rows are taken from them: pages behind the prices are parsed a single time.
    Each game carries the places of the short names inside its full home name. Both sides are dealt by start, and only
    inside a task a game becomes one row per short name; it meets the prices on start and short home name, and the away
    name filters the few rows that share both. A start with very many rows goes to several tasks by short home name.
    """
    spark = games.sparkSession
    limits, tasks = limits or Limits.of(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    games = stored(games.select("game_id", "game_datetime", "home_name", "away_name", "home_score", "away_score"))
    odds = stored(odds.select("game_time", "home_team", "away_team", *PRICES))
    names = stored(_names_within(games.select(F.col("home_name").alias("full")), odds.select(F.col("home_team").alias("short"))))
    alike = games.schema["game_datetime"].dataType == odds.schema["game_time"].dataType
    start = lambda c: F.col(c) if alike else F.col(c).cast("timestamp")
    games, odds = _with_parts(
        [games.withColumn("_time", start("game_datetime")), odds.withColumn("_time", start("game_time"))], tasks, limits)

    def part(name):
        return F.pmod(F.xxhash64(name), F.col("_parts"))

    def own(spot):
        return part(_piece("home_name", spot))

    named = games.join(lookup(names, replace(limits, broadcast_free_bytes=0)), games["home_name"] == names["full"])
    apart = F.transform(F.array_distinct(F.transform("spots", own)), lambda p: F.struct(
        p.alias("_part"), F.filter("spots", lambda s: own(s) == p).alias("spots")))
    g = _dealt(named.withColumn("_apart", F.explode(apart)).select(*games.columns, "_apart.*"), tasks)
    g = g.withColumn("_spot", F.explode("spots")).withColumn("home_team", _piece("home_name", F.col("_spot"))).alias("g")
    o = _dealt(odds.withColumn("_part", part(F.col("home_team"))), tasks).alias("o")
    return g.join(  # merged, as files of few bytes may hold more rows than a broadcast should
        o.hint("merge"), (F.col("g._task") == F.col("o._task")) & (F.col("g._time") == F.col("o._time"))
        & (F.col("g.home_team") == F.col("o.home_team")) & F.contains("g.away_name", "o.away_team")).select(
        "g.game_id", "g.game_datetime", F.col("g.home_name").alias("full_home_name"),
        F.col("g.away_name").alias("full_away_name"), "g.home_score", "g.away_score", *[f"o.{c}" for c in PRICES])


def one_book_per_game(odds: DataFrame, sportsbook: str, keys: Sequence[str] = ("game_id",)) -> DataFrame:
    """Prices of one sportsbook, its bet types pivoted into one row per game."""
    def of(kind: str, column: str):
        return F.max(F.when(F.col("bet_type") == kind, F.col(column)))

    return odds.where(F.col("sportsbook") == sportsbook).groupBy(*keys).agg(
        of("moneyline", "home_line").alias("homeMoneyline"), of("moneyline", "away_line").alias("awayMoneyline"),
        of("spread", "home_spread").alias("homeSpread"), of("spread", "away_spread").alias("awaySpread"),
        of("spread", "home_spread_odds").alias("homeSpreadOdds"),
        of("spread", "away_spread_odds").alias("awaySpreadOdds"), of("total", "total").alias("overUnder"),
        of("total", "over_odds").alias("overOdds"), of("total", "under_odds").alias("underOdds"))


# Boxscore column of each team statistic of the game view.
BOXSCORE_STATS = {
    "Runs": "runs", "Hits": "hits", "Doubles": "doubles", "Triples": "triples", "HomeRuns": "home_runs", "RBI": "rbi",
    "Walks": "walks", "Strikeouts": "strikeouts", "StolenBases": "stolen_bases", "LOB": "left_on_base",
    "HBP": "hit_by_pitch", "BA": "avg", "OBP": "obp", "SLG": "slg", "OPS": "ops", "EarnedRuns": "earned_runs",
    "HitsAllowed": "hits_allowed", "HRAllowed": "home_runs_allowed", "WalksAllowed": "walks_allowed",
    "StrikeoutsPitched": "strikeouts_pitched", "ERA": "era",
}


def baseball_game_view(games: DataFrame, boxscores: DataFrame, odds: DataFrame, sportsbook: str) -> DataFrame:
    """One row per completed game: teams, venue, both sides' statistics, and one book's prices."""
    stats = {n: c for n, c in BOXSCORE_STATS.items() if c in boxscores.columns}
    paired = boxscores.groupBy("game_id").agg(*[
        F.max(F.when(F.col("is_home") == bit, F.col(c).cast("double"))).alias(f"{side}{n}")
        for bit, side in ((1, "home"), (0, "away")) for n, c in stats.items()])
    done = games.where(is_completed(F.col("status"))).select(
        "game_id", F.col("season").cast("int").alias("season"), F.to_date("game_datetime").alias("gameDate"),
        F.col("game_datetime").alias("gameDateTime"), F.col("game_type").alias("gameType"),
        F.col("home_id").alias("homeTeamId"), F.col("home_name").alias("homeTeamName"),
        F.col("away_id").alias("awayTeamId"), F.col("away_name").alias("awayTeamName"),
        F.col("venue_id").alias("venueId"), F.col("venue_name").alias("venueName"))
    view = done.join(paired, "game_id").join(one_book_per_game(odds, sportsbook), "game_id", "left")
    return view.withColumnRenamed("game_id", "gameId")


# Team boxscore column of each statistic of the college game view.
COLLEGE_STATS = {
    "Pace": "pace", "Rating": "rating", "TrueShooting": "trueShooting", "OrbPct": "fourFactorsOffensiveReboundPct",
    "Efg": "fourFactorsEffectiveFieldGoalPct", "Ftr": "fourFactorsFreeThrowRate", "PointsOffTO": "pointsOffTurnovers",
    "PaintPoints": "pointsInPaint",
}


def college_game_view(games: DataFrame, boxscores: DataFrame, lines: DataFrame, provider: str) -> DataFrame:
    """One row per game, played or not: teams, points, both sides' statistics, and one provider's lines."""
    stats = {n: c for n, c in COLLEGE_STATS.items() if c in boxscores.columns}
    ids = games.select(
        "gameId", "season", "startDate", "homeTeamId", "awayTeamId", "homePoints", "awayPoints", "conferenceGame",
        "neutralSite")
    sided = boxscores.select("gameId", "teamId", *[F.col(c).cast("double").alias(n) for n, c in stats.items()]).join(
        ids.select("gameId", "homeTeamId"), "gameId")
    home = F.col("teamId") == F.col("homeTeamId")
    paired = sided.groupBy("gameId").agg(*[
        F.max(F.when(home if side == "home" else ~home, F.col(n))).alias(f"{side}{n}")
        for side in ("home", "away") for n in stats])
    priced = lines.where(F.col("provider") == provider).select("gameId", "homeSpread", "overUnder")
    return ids.join(paired, "gameId", "left").join(priced, "gameId", "left")
