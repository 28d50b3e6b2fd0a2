"""Nested documents to flat tables: boxscores, rosters, lines, odds pages, reference data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldhouse.functions.coerce import parse_iso, to_bit, to_id, to_number, to_scale, to_text, to_time, to_whole
from fieldhouse.functions.names import camel_path
from fieldhouse.operators.ordering import keep_first
from fieldhouse.operators.shape import require, select_present
from fieldhouse.schemas import ODDS_PAGE_JSON


def leaves(schema: T.StructType, prefix: str = "") -> Iterator[str]:
    """Dotted paths of all non-struct fields."""
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, f"{path}.")
        else:
            yield path


def flat_columns(df: DataFrame, struct: str, drop: Sequence[str] = ()) -> list[Column]:
    """Every leaf under a struct column, named in camel case without dots."""
    paths = leaves(df.schema[struct].dataType)
    return [F.col(f"{struct}.{p}").alias(camel_path(p)) for p in paths if camel_path(p) not in drop]


def _any_value(df: DataFrame, path: str, kind: T.StructType) -> Column:
    """Whether a struct carries anything: an empty object parses to a struct of NULLs."""
    return reduce(lambda a, b: a | b, [F.col(f"{path}.{f.name}").isNotNull() for f in kind.fields])


def team_boxscores(docs: DataFrame) -> DataFrame:
    """College team boxscores: stats struct to columns, documents without stats skipped."""
    have = docs.where(F.col("teamStats").isNotNull())
    flat = have.select("gameId", "teamId", "opponentId", "pace", *flat_columns(have, "teamStats", ["pointsByPeriod"]))
    return flat.withColumn("gameScore", to_scale(F.col("gameScore"), 2))


def player_boxscores(docs: DataFrame) -> DataFrame:
    """College player boxscores: one row per listed player."""
    rows = docs.select("gameId", "teamId", "opponentId", F.explode("players").alias("p")).where("p IS NOT NULL")
    return rows.select("gameId", "teamId", "opponentId", *flat_columns(rows, "p"))


# Fields of a betting line that are kept.
LINE_FIELDS = ["provider", "spread", "overUnder", "homeMoneyline", "awayMoneyline", "spreadOpen", "overUnderOpen"]


def game_lines(docs: DataFrame) -> DataFrame:
    """Betting lines: one row per game and provider, the first listed when a provider repeats."""
    rows = docs.select("gameId", F.posexplode("lines").alias("at", "p")).where("p.provider IS NOT NULL")
    flat = rows.select("gameId", "at", *[F.col(f"p.{c}").alias(c) for c in LINE_FIELDS])
    return keep_first(flat, ["gameId", "provider"], ["at"]).drop("at")


# Roster fields that are not kept.
ROSTER_DROPPED = ["dateOfBirth", "hometownCountry", "hometownLatitude", "hometownLongitude", "hometownCountyFips"]


def rosters(docs: DataFrame) -> DataFrame:
    """Rosters: one row per listed player, `id` as `playerId`."""
    require(docs, ["teamId", "season", "players"], "rosters")
    rows = docs.select("teamId", "season", F.explode("players").alias("p")).where("p IS NOT NULL")
    return rows.select("teamId", "season", *flat_columns(rows, "p", ROSTER_DROPPED)).withColumnRenamed("id", "playerId")


# ---- baseball boxscores ------------------------------------------------------------------------------------

# Output column and document field of each statistic.
BATTING_FIELDS = {
    "runs": "runs", "hits": "hits", "doubles": "doubles", "triples": "triples", "home_runs": "homeRuns", "rbi": "rbi",
    "walks": "baseOnBalls", "strikeouts": "strikeOuts", "stolen_bases": "stolenBases",
    "caught_stealing": "caughtStealing",
}
RATE_FIELDS = {"avg": "avg", "obp": "obp", "slg": "slg", "ops": "ops"}
TEAM_FIELDS = {
    "batting": {**BATTING_FIELDS, "left_on_base": "leftOnBase", "hit_by_pitch": "hitByPitch", **RATE_FIELDS},
    "pitching": {
        "earned_runs": "earnedRuns", "hits_allowed": "hits", "home_runs_allowed": "homeRuns",
        "walks_allowed": "baseOnBalls", "strikeouts_pitched": "strikeOuts", "pitches_thrown": "numberOfPitches",
        "strikes": "strikes", "era": "era",
    },
}
PLAYER_FIELDS = {
    "batting": {"at_bats": "atBats", **BATTING_FIELDS, "hit_by_pitch": "hitByPitch", **RATE_FIELDS},
    "pitching": {
        "innings_pitched": "inningsPitched", "hits_allowed": "hits", "runs_allowed": "runs",
        "earned_runs": "earnedRuns", "walks_allowed": "baseOnBalls", "strikeouts_pitched": "strikeOuts",
        "home_runs_allowed": "homeRuns", "pitches_thrown": "numberOfPitches", "strikes": "strikes", "era": "era",
        "win": "wins", "loss": "losses", "save": "saves", "blown_save": "blownSaves", "hold": "holds",
    },
}


def _clubs(docs: DataFrame) -> DataFrame:
    """Both clubs of a boxscore as rows, away first, from one read of the document."""
    sides = F.array(F.struct(F.lit(0).alias("is_home"), F.col("away").alias("club")),
                    F.struct(F.lit(1).alias("is_home"), F.col("home").alias("club")))
    return docs.select("game_id", F.explode(sides).alias("s")).select("game_id", "s.*").where("club IS NOT NULL")


def _stats(root: str, fields: dict[str, dict[str, str]]) -> list[Column]:
    return [F.col(f"{root}.{part}.{src}").alias(out) for part, names in fields.items() for out, src in names.items()]


def baseball_team_boxscores(docs: DataFrame) -> DataFrame:
    return _clubs(docs).select(
        "game_id", F.col("club.team.id").cast("string").alias("team_id"), "is_home", *_stats("club.teamStats", TEAM_FIELDS))


def baseball_player_boxscores(docs: DataFrame) -> DataFrame:
    """One row per player with batting or pitching figures; the map key carries the id as `ID669257`."""
    rows = _clubs(docs).select(
        "game_id", F.col("club.team.id").cast("string").alias("team_id"), "is_home",
        F.explode("club.players").alias("key", "p"))
    stats = rows.schema["p"].dataType["stats"].dataType
    played = reduce(lambda a, b: a | b, [
        _any_value(rows, f"p.stats.{part}", stats[part].dataType) for part in ("batting", "pitching")])
    return rows.where(F.coalesce(played, F.lit(False))).select(
        "game_id", F.regexp_replace("key", "^ID", "").alias("player_id"), "team_id", "is_home",
        F.col("p.position.abbreviation").alias("position"), F.col("p.battingOrder").alias("batting_order"),
        *_stats("p.stats", PLAYER_FIELDS))


# ---- baseball reference documents --------------------------------------------------------------------------


def mlb_teams(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("season").cast("string").alias("season"), F.explode("teams").alias("t"))
    return rows.select(
        F.col("t.id").cast("string").alias("team_id"), "season", F.col("t.name").alias("team_name"),
        F.col("t.abbreviation").alias("team_abbr"), F.col("t.franchiseName").alias("franchise_name"),
        F.col("t.clubName").alias("club_name"), F.col("t.division.name").alias("division"),
        F.col("t.league.name").alias("league"), F.col("t.venue.name").alias("venue_name"),
        F.col("t.firstYearOfPlay").alias("first_year"))


def mlb_rosters(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("team_id").cast("string").alias("team_id"), F.col("season").cast("string").alias("season"),
        "roster_type", F.explode("roster").alias("r"))
    return rows.select(
        F.col("r.person.id").cast("string").alias("player_id"), "team_id", "season",
        F.col("r.person.fullName").alias("full_name"), F.col("r.jerseyNumber").alias("jersey_number"),
        F.col("r.position.code").alias("position_code"), F.col("r.position.name").alias("position_name"),
        F.col("r.position.type").alias("position_type"), F.col("r.status.description").alias("status"), "roster_type")


def mlb_schedule(docs: DataFrame) -> DataFrame:
    """Scheduled games; a game without a type is a regular-season game."""
    rows = docs.select(F.col("season").cast("string").alias("season"), F.explode("games").alias("g"))
    ids = {c: F.col(f"g.{c}").cast("string").alias(c) for c in ("game_id", "away_id", "home_id", "venue_id")}
    return rows.select(
        ids["game_id"], "season", parse_iso(F.col("g.game_datetime")).alias("game_datetime"), ids["away_id"],
        F.col("g.away_name").alias("away_name"), ids["home_id"], F.col("g.home_name").alias("home_name"),
        F.col("g.away_score").alias("away_score"), F.col("g.home_score").alias("home_score"),
        F.col("g.status").alias("status"), F.coalesce("g.game_type", F.lit("R")).alias("game_type"),
        ids["venue_id"], F.col("g.venue_name").alias("venue_name"))


# ---- odds pages --------------------------------------------------------------------------------------------

# The script element that carries a page's data.
PAGE_DATA, PAGE_DATA_END = r'<script[^>]*id="__NEXT_DATA__"[^>]*>', "</script>"
BET_TYPES = ("moneyline", "spread", "total")
# Line fields of each bet type, output column and document field.
BET_FIELDS = {
    "moneyline": {"away_line": "awayOdds", "home_line": "homeOdds"},
    "spread": {"away_spread": "awaySpread", "away_spread_odds": "awayOdds", "home_spread": "homeSpread",
               "home_spread_odds": "homeOdds"},
    "total": {"total": "total", "over_odds": "overOdds", "under_odds": "underOdds"},
}
ODDS_COLUMNS = [
    "date", "game_id", "game_time", "away_team", "home_team", "sportsbook", "bet_type", "away_line", "home_line",
    "away_spread", "away_spread_odds", "home_spread", "home_spread_odds", "total", "over_odds", "under_odds",
]


def page_data(html: str = "html") -> Column:
    """What stands in a page's data element, to the end of a page that is cut off inside it; null without the element."""
    return F.substring_index(F.get(F.split(html, PAGE_DATA, 2), 1), PAGE_DATA_END, 1)


def parsed_pages(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("date", "bet_type")) -> DataFrame:
    """`keep`, `doc` (the page's data, parsed once) and `broken`: the data that do not parse, or the page if it has none."""
    kind = f"{ODDS_PAGE_JSON[:-1]},_corrupt_record:string>"
    out = pages.select(*keep, html, page_data(html).alias("_data"))
    out = out.select(*keep, html, "_data", F.from_json("_data", kind, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("doc"))
    broken = F.when(F.coalesce(F.trim("_data"), F.lit("")) == "", F.coalesce(html, F.lit(""))).otherwise(F.col("doc._corrupt_record"))
    return out.select(*keep, "doc", broken.alias("broken"))


def broken_pages(parsed: DataFrame) -> DataFrame:
    """Pages without readable data, as `page` beside the kept columns; write them aside and count them."""
    return parsed.where(F.col("broken").isNotNull()).drop("doc").withColumnRenamed("broken", "page")


def odds_lines(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("date", "bet_type")) -> DataFrame:
    """One row per game and sportsbook of each page: names, start, and the current line as a struct.

    Games come from the table model, or from the table itself on pages of the older layout. Games without both
    team names and views without a current line, or with an empty one, are skipped. Pages that do not parse have no
    lines here; `parsed_pages` keeps them.
    """
    return lines_of(pages.select(*keep, F.from_json(page_data(html), ODDS_PAGE_JSON).alias("doc")), keep)


def lines_of(parsed: DataFrame, keep: Sequence[str] = ("date", "bet_type")) -> DataFrame:
    """The lines of parsed pages."""
    first = F.try_element_at(F.col("doc.props.pageProps.oddsTables"), F.lit(1))
    tables = parsed.select(*keep, first.alias("t"))
    newer = F.col("t.oddsTableModel.gameRows")
    games = F.when(F.size(newer) > 0, newer).otherwise(F.col("t.gameRows"))
    rows = tables.select(*keep, F.explode(games).alias("g"))
    named = rows.where("g.gameView.awayTeam.name <> '' AND g.gameView.homeTeam.name <> ''")
    views = named.select(*keep, "g.gameView", F.explode("g.oddsViews").alias("v"))
    views = views.where(_any_value(views, "v.currentLine", views.schema["v"].dataType["currentLine"].dataType))
    return views.select(
        *keep, F.col("gameView.gameId").alias("game_id"), F.col("gameView.startDate").alias("game_time"),
        F.col("gameView.awayTeam.name").alias("away_team"), F.col("gameView.homeTeam.name").alias("home_team"),
        F.coalesce("v.sportsbook", F.lit("unknown")).alias("sportsbook"), F.col("v.currentLine").alias("line"))


def shape_odds(lines: DataFrame, bet_type: str) -> DataFrame:
    """The lines of one bet type under that type's columns."""
    base = lines.where(F.col("bet_type") == bet_type)
    return base.select(
        "date", "game_id", "game_time", "away_team", "home_team", "sportsbook", "bet_type",
        *[F.col(f"line.{src}").alias(out) for out, src in BET_FIELDS[bet_type].items()])


def odds_table(lines: DataFrame) -> DataFrame:
    """All bet types in one table, columns of other types NULL, from one pass over the lines."""
    cols = [
        F.when(F.col("bet_type") == kind, F.col(f"line.{src}")).alias(out)
        for kind, fields in BET_FIELDS.items() for out, src in fields.items()]
    typed = lines.where(F.col("bet_type").isin(*BET_TYPES)).select(
        F.col("date").cast("date").alias("date"), "game_id",
        to_time(F.col("game_time")).alias("game_time"), "away_team", "home_team", "sportsbook", "bet_type", *cols)
    return select_present(typed, ODDS_COLUMNS)


def combine_odds(*shapes: DataFrame) -> DataFrame:
    """Separately shaped odds (moneyline, spread, total) under one set of columns, missing ones NULL."""
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shapes)
    return select_present(joined, ODDS_COLUMNS)


# ---- coercions of the college tables -----------------------------------------------------------------------

# Column groups of the college tables.
GAME_TEXT = [
    "gameId", "sourceId", "seasonLabel", "seasonType", "tournament", "gameType", "status", "homeTeamId",
    "homeConferenceId", "awayTeamId", "awayConferenceId", "venueId", "homeTeam", "homeConference", "awayTeam",
    "awayConference", "venue", "city", "state", "gameNotes",
]
GAME_WHOLE = ["season", "attendance", "homeSeed", "homePoints", "awaySeed", "awayPoints"]
GAME_BITS = ["startTimeTbd", "neutralSite", "conferenceGame", "homeWinner", "awayWinner"]
GAME_DROPPED = [
    "homePeriodPoints", "awayPeriodPoints", "homeConferenceId", "homeConference", "awayConferenceId",
    "awayConference", "homeSeed", "awaySeed",
]
TEAM_BOX_WHOLE = [
    "possessions", "assists", "steals", "blocks", "pointsTotal", "pointsLargestLead", "pointsFastBreak",
    "pointsInPaint", "pointsOffTurnovers", "twoPointFieldGoalsMade", "twoPointFieldGoalsAttempted",
    "threePointFieldGoalsMade", "threePointFieldGoalsAttempted", "freeThrowsMade", "freeThrowsAttempted",
    "fieldGoalsMade", "fieldGoalsAttempted", "turnoversTotal", "turnoversTeamTotal", "reboundsOffensive",
    "reboundsDefensive", "reboundsTotal", "foulsTotal", "foulsTechnical", "foulsFlagrant",
]
TEAM_BOX_DECIMAL = [
    "pace", "trueShooting", "rating", "gameScore", "twoPointFieldGoalsPct", "threePointFieldGoalsPct",
    "freeThrowsPct", "fieldGoalsPct", "fourFactorsEffectiveFieldGoalPct", "fourFactorsFreeThrowRate",
    "fourFactorsTurnoverRatio", "fourFactorsOffensiveReboundPct",
]
PLAYER_BOX_WHOLE = [
    "minutes", "points", "turnovers", "fouls", "assists", "steals", "blocks", "fieldGoalsMade",
    "fieldGoalsAttempted", "twoPointFieldGoalsMade", "twoPointFieldGoalsAttempted", "threePointFieldGoalsMade",
    "threePointFieldGoalsAttempted", "freeThrowsMade", "freeThrowsAttempted", "reboundsOffensive",
    "reboundsDefensive", "reboundsTotal",
]
PLAYER_BOX_DECIMAL = [
    "gameScore", "offensiveRating", "defensiveRating", "netRating", "usage", "effectiveFieldGoalPct",
    "trueShootingPct", "assistsTurnoverRatio", "freeThrowRate", "offensiveReboundPct", "fieldGoalsPct",
    "twoPointFieldGoalsPct", "threePointFieldGoalsPct", "freeThrowsPct",
]


def _typed(df: DataFrame, **groups: tuple[Sequence[str], object]) -> DataFrame:
    schema = df.schema

    def typed(c: str, fn) -> Column:
        return fn(F.col(c), True) if fn is to_whole and isinstance(schema[c].dataType, T.IntegralType) else fn(F.col(c))

    return df.withColumns({c: typed(c, fn) for names, fn in groups.values() for c in names if c in df.columns})


def _text(c: Column) -> Column:
    return c.cast("string")


def college_games(df: DataFrame) -> DataFrame:
    """Games with types set, conference columns gone, rows without a source id gone, repeats gone."""
    named = df.withColumnRenamed("id", "gameId") if "id" in df.columns else df
    typed = _typed(
        named.drop("homePeriodPoints", "awayPeriodPoints"), text=(GAME_TEXT, _text), whole=(GAME_WHOLE, to_whole),
        bits=(GAME_BITS, lambda c: to_bit(c, null_is_zero=True)), time=(["startDate"], to_time),
        scale=(["excitement"], lambda c: to_scale(c, 4)))
    return typed.dropna(subset=["sourceId"]).drop(*GAME_DROPPED).distinct()


def college_team_boxscores(flat: DataFrame) -> DataFrame:
    return _typed(flat, text=(["gameId", "teamId", "opponentId"], _text), whole=(TEAM_BOX_WHOLE, to_whole),
                  decimal=(TEAM_BOX_DECIMAL, to_number)).distinct()


def college_player_boxscores(flat: DataFrame) -> DataFrame:
    typed = _typed(
        flat, ids=(["gameId", "teamId", "opponentId", "athleteId"], to_id),
        source=(["athleteSourceId"], lambda c: F.coalesce(to_id(c), _text(c))), text=(["name", "position"], _text),
        bits=(["starter", "ejected"], to_bit), whole=(PLAYER_BOX_WHOLE, to_whole),
        decimal=(PLAYER_BOX_DECIMAL, to_number))
    return typed.dropna(subset=["gameId", "teamId", "athleteId"]).distinct()


def college_lines(flat: DataFrame) -> DataFrame:
    numbers = [c for c in LINE_FIELDS if c != "provider"]
    typed = _typed(flat, ids=(["gameId"], to_id), text=(["provider"], _text), numbers=(numbers, to_number))
    return typed.dropna(subset=["gameId"]).withColumnRenamed("spread", "homeSpread")


def college_players(flat: DataFrame) -> DataFrame:
    whole = ["season", "startSeason", "endSeason", "height", "weight"]
    text = ["name", "firstName", "lastName", "jersey", "position", "hometownCity", "hometownState"]
    typed = _typed(flat, ids=(["teamId", "playerId", "sourceId"], to_id), whole=(whole, to_whole), text=(text, _text))
    return typed.dropna(subset=["playerId"])


def _reference_table(df: DataFrame, key: str, ids: Sequence[str], strict: bool = True) -> DataFrame:
    named = df.withColumnRenamed("id", key) if "id" in df.columns else df
    typed = named.select([(to_id(F.col(c)) if c in (key, *ids) else _text(F.col(c))).alias(c) for c in named.columns])
    return typed.dropna(subset=[key]) if strict else typed


def college_teams(df: DataFrame) -> DataFrame:
    return _reference_table(df, "teamId", ["sourceId", "conferenceId", "currentVenueId"], strict=False)


def college_venues(df: DataFrame) -> DataFrame:
    return _reference_table(df, "venueId", ["sourceId"])


def college_conferences(df: DataFrame) -> DataFrame:
    return _reference_table(df, "conferenceId", ["sourceId"])


def trimmed(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Text columns cut to the lengths their tables allow."""
    return df.withColumns({c: to_text(F.col(c), n) for c, n in limits.items() if c in df.columns})
