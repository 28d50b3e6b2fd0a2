"""Table definitions: columns, keys, partitioning, load order.

Ids are text even when numeric. Audit columns are added by the writers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AUDIT = ("insert_date", "update_date")


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    ddl: str
    depends_on: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    identity: tuple[str, ...] = ()
    note: str = ""
    open_columns: bool = False
    """Accept whatever extra columns the source carries, next to those of `ddl`."""

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    def data_columns(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c not in (*self.keys, *AUDIT, *self.identity)]


# Columns of the baseball tables.
_TEAM_BATTING = (
    "runs int, hits int, doubles int, triples int, home_runs int, rbi int, walks int, strikeouts int, "
    "stolen_bases int, caught_stealing int, left_on_base int, hit_by_pitch int, "
    "avg decimal(5,3), obp decimal(5,3), slg decimal(5,3), ops decimal(5,3)")
_TEAM_PITCHING = (
    "earned_runs int, hits_allowed int, home_runs_allowed int, walks_allowed int, strikeouts_pitched int, "
    "pitches_thrown int, strikes int, era decimal(5,2)")
_PLAYER_BATTING = (
    "at_bats int, runs int, hits int, doubles int, triples int, home_runs int, rbi int, walks int, strikeouts int, "
    "stolen_bases int, caught_stealing int, hit_by_pitch int, "
    "avg decimal(5,3), obp decimal(5,3), slg decimal(5,3), ops decimal(5,3)")
_PLAYER_PITCHING = (
    "innings_pitched decimal(5,2), hits_allowed int, runs_allowed int, earned_runs int, walks_allowed int, "
    "strikeouts_pitched int, home_runs_allowed int, pitches_thrown int, strikes int, era decimal(5,2), "
    "win int, loss int, save int, blown_save int, hold int")
_PITCH = (
    "game_pk string, game_date date, game_year int, at_bat_number int, pitch_number int, pitcher int, batter int, "
    "pitcher_name string, batter_name string, inning int, inning_topbot string, outs_when_up int, balls int, "
    "strikes int, on_1b int, on_2b int, on_3b int, stand string, p_throws string, pitch_type string, "
    "pitch_name string, release_speed decimal(5,2), release_pos_x decimal(5,2), release_pos_y decimal(5,2), "
    "release_pos_z decimal(5,2), release_spin_rate int, release_extension decimal(5,2), spin_axis int, "
    "pfx_x decimal(5,2), pfx_z decimal(5,2), plate_x decimal(5,2), plate_z decimal(5,2), vx0 decimal(6,3), "
    "vy0 decimal(6,3), vz0 decimal(6,3), ax decimal(6,3), ay decimal(6,3), az decimal(6,3), zone int, "
    "sz_top decimal(5,2), sz_bot decimal(5,2), launch_speed decimal(5,2), launch_angle decimal(5,2), "
    "hit_distance_sc int, bb_type string, hc_x decimal(6,2), hc_y decimal(6,2), barrel int, "
    "estimated_ba_using_speedangle decimal(5,3), estimated_woba_using_speedangle decimal(5,3), "
    "woba_value decimal(5,3), woba_denom int, babip_value decimal(5,3), iso_value decimal(5,3), type string, "
    "description string, events string, des string, home_run int, hit_location string, "
    "if_fielding_alignment string, of_fielding_alignment string")

BASEBALL = [
    TableSpec(
        "TeamInfo", ("team_id", "season"),
        "team_id string, season string, team_name string, team_abbr string, franchise_name string, "
        "club_name string, division string, league string, venue_id string, venue_name string, first_year string",
        note="teams by season"),
    TableSpec(
        "GameInfo", ("game_id",),
        "game_id string, season string, game_datetime timestamp, away_id string, away_name string, home_id string, "
        "home_name string, away_score int, home_score int, status string, game_type string, venue_id string, "
        "venue_name string",
        depends_on=("TeamInfo",), partition_by=("season",), note="game results"),
    TableSpec(
        "PlayerInfo", ("player_id", "team_id", "season"),
        "player_id string, team_id string, season string, full_name string, jersey_number string, "
        "position_code string, position_name string, position_type string, status string, roster_type string",
        depends_on=("TeamInfo",), note="rosters"),
    TableSpec(
        "TeamBoxscore", ("game_id", "team_id"),
        f"game_id string, team_id string, is_home int, {_TEAM_BATTING}, {_TEAM_PITCHING}",
        depends_on=("GameInfo", "TeamInfo"), note="team lines per game"),
    TableSpec(
        "PlayerBoxscore", ("game_id", "player_id"),
        "game_id string, player_id string, team_id string, is_home int, position string, batting_order string, "
        f"{_PLAYER_BATTING}, {_PLAYER_PITCHING}",
        depends_on=("GameInfo", "PlayerInfo"), note="player lines per game"),
    TableSpec(
        "BettingOdds", ("game_id", "sportsbook", "bet_type"),
        "date date, game_id string, game_time timestamp, away_team string, home_team string, sportsbook string, "
        "bet_type string, away_line int, home_line int, away_spread decimal(5,2), away_spread_odds int, "
        "home_spread decimal(5,2), home_spread_odds int, total decimal(5,2), over_odds int, under_odds int",
        note="prices per game, book and bet type"),
    TableSpec(
        "StatcastPitches", ("game_pk", "at_bat_number", "pitch_number"), _PITCH,
        partition_by=("game_year",), identity=("pitch_id",), note="one row per pitch"),
]

# Columns and keys of the college basketball tables.
BASKETBALL = [
    TableSpec("ConferenceInfo", ("conferenceId",),
              "conferenceId string, sourceId string, name string, abbreviation string, shortName string",
              open_columns=True),
    TableSpec("VenueInfo", ("venueId",),
              "venueId string, sourceId string, name string, city string, state string, country string",
              open_columns=True),
    TableSpec("TeamInfo", ("teamId",), "teamId string, sourceId string, conferenceId string, currentVenueId string",
              open_columns=True),
    TableSpec("PlayerInfo", ("playerId",),
              "playerId string, teamId string, season long, sourceId string, name string, firstName string, "
              "lastName string, jersey string, position string, height long, weight long, hometownCity string, "
              "hometownState string, startSeason long, endSeason long", open_columns=True),
    TableSpec("GameInfo", ("gameId",),
              "gameId string, sourceId string, seasonLabel string, season long, seasonType string, "
              "tournament string, startDate timestamp, startTimeTbd int, neutralSite int, conferenceGame int, "
              "gameType string, status string, gameNotes string, attendance long, homeTeamId string, "
              "homeTeam string, homePoints long, homeWinner int, awayTeamId string, awayTeam string, "
              "awayPoints long, awayWinner int, excitement double, venueId string, venue string, city string, "
              "state string", partition_by=("season",), open_columns=True),
    TableSpec("GameBoxscoreTeam", ("gameId", "teamId"),
              "gameId string, teamId string, opponentId string, pace double", identity=("boxscoreId",),
              open_columns=True),
    TableSpec("GameBoxscorePlayer", ("gameId", "teamId", "athleteId"),
              "gameId string, teamId string, opponentId string, athleteId string", identity=("boxscoreId",),
              open_columns=True),
    TableSpec("GameLines", ("gameId", "provider"),
              "gameId string, provider string, homeSpread double, overUnder double, homeMoneyline double, "
              "awayMoneyline double, spreadOpen double, overUnderOpen double", identity=("linesId",),
              open_columns=True),
    TableSpec("SpreadModelPicks", ("gameId",),
              "gameId string, homeTeam string, awayTeam string, startDate timestamp, venue string, "
              "homeSpread double, predProb double, predClass int, pickSide string, edge double",
              open_columns=True),
]


def registry(specs: list[TableSpec]) -> dict[str, TableSpec]:
    """Specs by name, in an order in which every table comes after those it depends on."""
    waiting, ready = list(specs), {}
    while waiting:
        free = [s for s in waiting if all(d in ready for d in s.depends_on)]
        if not free:
            raise ValueError(f"circular dependencies among {[s.name for s in waiting]}")
        ready.update({s.name: s for s in free})
        waiting = [s for s in waiting if s.name not in ready]
    return ready


BASEBALL_TABLES = registry(BASEBALL)
BASKETBALL_TABLES = registry(BASKETBALL)

# ---- nested landing documents -------------------------------------------------------------------------------

# Field names of the landing documents.
_SHOOTING = "struct<made:long,attempted:long,pct:double>"

TEAM_BOXSCORE_JSON = (
    "gameId long, teamId long, opponentId long, pace double, "
    "teamStats struct<possessions:long,assists:long,steals:long,blocks:long,trueShooting:double,rating:double,"
    "gameScore:double,points:struct<total:long,byPeriod:array<long>,largestLead:long,fastBreak:long,inPaint:long,"
    f"offTurnovers:long>,twoPointFieldGoals:{_SHOOTING},threePointFieldGoals:{_SHOOTING},freeThrows:{_SHOOTING},"
    f"fieldGoals:{_SHOOTING},turnovers:struct<total:long,teamTotal:long>,"
    "rebounds:struct<offensive:long,defensive:long,total:long>,"
    "fouls:struct<total:long,technical:long,flagrant:long>,"
    "fourFactors:struct<effectiveFieldGoalPct:double,freeThrowRate:double,turnoverRatio:double,"
    "offensiveReboundPct:double>>")

PLAYER_BOXSCORE_JSON = (
    "gameId long, teamId long, opponentId long, players array<struct<athleteId:string,athleteSourceId:string,"
    "name:string,position:string,starter:boolean,ejected:boolean,minutes:long,points:long,turnovers:long,fouls:long,"
    "assists:long,steals:long,blocks:long,gameScore:double,offensiveRating:double,defensiveRating:double,"
    "netRating:double,usage:double,effectiveFieldGoalPct:double,trueShootingPct:double,"
    "assistsTurnoverRatio:double,freeThrowRate:double,offensiveReboundPct:double,"
    f"fieldGoals:{_SHOOTING},twoPointFieldGoals:{_SHOOTING},threePointFieldGoals:{_SHOOTING},freeThrows:{_SHOOTING},"
    "rebounds:struct<offensive:long,defensive:long,total:long>>>")

LINES_JSON = (
    "gameId long, lines array<struct<provider:string,spread:double,overUnder:double,homeMoneyline:double,"
    "awayMoneyline:double,spreadOpen:double,overUnderOpen:double>>")

ROSTER_JSON = (
    "teamId long, team string, season long, players array<struct<id:string,sourceId:string,name:string,"
    "firstName:string,lastName:string,jersey:string,position:string,height:long,weight:long,"
    "hometown:struct<city:string,state:string,country:string,latitude:double,longitude:double,countyFips:string>,"
    "dateOfBirth:string,startSeason:long,endSeason:long>>")

CBB_GAME_JSON = (
    "id long, sourceId string, seasonLabel string, season long, seasonType string, tournament string, "
    "startDate string, startTimeTbd boolean, neutralSite boolean, conferenceGame boolean, gameType string, "
    "status string, gameNotes string, attendance double, homeTeamId long, homeTeam string, homeConferenceId long, "
    "homeConference string, homeSeed double, homePoints double, homePeriodPoints array<long>, homeWinner boolean, "
    "awayTeamId long, awayTeam string, awayConferenceId long, awayConference string, awaySeed double, "
    "awayPoints double, awayPeriodPoints array<long>, awayWinner boolean, excitement double, venueId long, "
    "venue string, city string, state string")

CBB_TEAM_JSON = "id string, sourceId string, school string, mascot string, abbreviation string, conferenceId string, " \
    "conference string, currentVenueId string, currentVenue string, currentCity string, currentState string"
CBB_VENUE_JSON = "id string, sourceId string, name string, city string, state string, country string"
CBB_CONFERENCE_JSON = "id string, sourceId string, name string, abbreviation string, shortName string"

_BATTING_DOC = (
    "struct<atBats:long,runs:long,hits:long,doubles:long,triples:long,homeRuns:long,rbi:long,baseOnBalls:long,"
    "strikeOuts:long,stolenBases:long,caughtStealing:long,leftOnBase:long,hitByPitch:long,avg:string,obp:string,"
    "slg:string,ops:string>")
_PITCHING_DOC = (
    "struct<inningsPitched:string,hits:long,runs:long,earnedRuns:long,baseOnBalls:long,strikeOuts:long,"
    "homeRuns:long,numberOfPitches:long,strikes:long,era:string,wins:long,losses:long,saves:long,blownSaves:long,"
    "holds:long>")
_CLUB_DOC = (
    f"struct<team:struct<id:long>,teamStats:struct<batting:{_BATTING_DOC},pitching:{_PITCHING_DOC}>,"
    "players:map<string,struct<position:struct<abbreviation:string>,battingOrder:string,"
    f"stats:struct<batting:{_BATTING_DOC},pitching:{_PITCHING_DOC}>>>>")
BASEBALL_BOXSCORE_JSON = f"game_id string, away {_CLUB_DOC}, home {_CLUB_DOC}"

MLB_TEAMS_JSON = (
    "season int, teams array<struct<id:long,name:string,abbreviation:string,franchiseName:string,clubName:string,"
    "division:struct<name:string>,league:struct<name:string>,venue:struct<name:string>,firstYearOfPlay:string>>")
MLB_ROSTER_JSON = (
    "team_id long, season int, roster_type string, roster array<struct<person:struct<id:long,fullName:string>,"
    "jerseyNumber:string,position:struct<code:string,name:string,type:string>,status:struct<description:string>>>")
MLB_SCHEDULE_JSON = (
    "season int, games array<struct<game_id:long,game_datetime:string,away_id:long,away_name:string,home_id:long,"
    "home_name:string,away_score:int,home_score:int,status:string,game_type:string,venue_id:long,"
    "venue_name:string>>")

_LINE_DOC = (
    "struct<awayOdds:int,homeOdds:int,awaySpread:double,homeSpread:double,total:double,overOdds:int,underOdds:int>")
_ROW_DOC = (
    "array<struct<gameView:struct<gameId:string,awayTeam:struct<name:string>,homeTeam:struct<name:string>,"
    f"startDate:string>,oddsViews:array<struct<sportsbook:string,currentLine:{_LINE_DOC}>>>>")
ODDS_PAGE_JSON = (
    "struct<props:struct<pageProps:struct<oddsTables:array<struct<"
    f"oddsTableModel:struct<gameRows:{_ROW_DOC}>,gameRows:{_ROW_DOC}>>>>>")
