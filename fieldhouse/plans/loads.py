"""Landing documents to keyed tables: which reader, cleaner and table belong together, and the runs over them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldhouse import schemas as sc
from fieldhouse.functions.calendar import (
    ODDS_DEFAULT,
    ODDS_SEASONS,
    PITCH_DEFAULT,
    PITCH_SEASONS,
    recent,
    season_bounds,
)
from fieldhouse.operators import cleaning as cl
from fieldhouse.operators import nested as ns
from fieldhouse.operators.profile import has_data
from fieldhouse.sources.files import broken_documents, pitch_scan, read_landing, season_scan
from fieldhouse.sources.tables import LoadResult, TableStore


@dataclass(frozen=True)
class Load:
    """A table's way from landing JSON: document schema, and the function that makes table rows of it."""

    spec: sc.TableSpec
    ddl: str
    rows: Callable[[DataFrame], DataFrame]
    when: str | None = None


BASEBALL_LOADS = {
    "TeamInfo": Load(sc.BASEBALL_TABLES["TeamInfo"], sc.MLB_TEAMS_JSON, lambda j: cl.clean_teams(ns.mlb_teams(j))),
    "GameInfo": Load(sc.BASEBALL_TABLES["GameInfo"], sc.MLB_SCHEDULE_JSON,
                     lambda j: cl.clean_games(ns.mlb_schedule(j), ["status", "venue_id"]), "game_datetime"),
    "PlayerInfo": Load(sc.BASEBALL_TABLES["PlayerInfo"], sc.MLB_ROSTER_JSON, lambda j: cl.clean_players(ns.mlb_rosters(j))),
    "TeamBoxscore": Load(sc.BASEBALL_TABLES["TeamBoxscore"], sc.BASEBALL_BOXSCORE_JSON,
                         lambda j: cl.clean_team_boxscores(ns.baseball_team_boxscores(j))),
    "PlayerBoxscore": Load(sc.BASEBALL_TABLES["PlayerBoxscore"], sc.BASEBALL_BOXSCORE_JSON,
                           lambda j: cl.clean_player_boxscores(ns.baseball_player_boxscores(j))),
    "BettingOdds": Load(sc.BASEBALL_TABLES["BettingOdds"], "date string, bet_type string, html string",
                        lambda pages: ns.odds_table(ns.odds_lines(pages)), "game_time"),
}

BASKETBALL_LOADS = {
    "ConferenceInfo": Load(sc.BASKETBALL_TABLES["ConferenceInfo"], sc.CBB_CONFERENCE_JSON, ns.college_conferences),
    "VenueInfo": Load(sc.BASKETBALL_TABLES["VenueInfo"], sc.CBB_VENUE_JSON, ns.college_venues),
    "TeamInfo": Load(sc.BASKETBALL_TABLES["TeamInfo"], sc.CBB_TEAM_JSON, ns.college_teams),
    "PlayerInfo": Load(sc.BASKETBALL_TABLES["PlayerInfo"], sc.ROSTER_JSON, lambda j: ns.college_players(ns.rosters(j))),
    "GameInfo": Load(sc.BASKETBALL_TABLES["GameInfo"], sc.CBB_GAME_JSON, ns.college_games, "startDate"),
    "GameBoxscoreTeam": Load(sc.BASKETBALL_TABLES["GameBoxscoreTeam"], sc.TEAM_BOXSCORE_JSON,
                             lambda j: ns.college_team_boxscores(ns.team_boxscores(j))),
    "GameBoxscorePlayer": Load(sc.BASKETBALL_TABLES["GameBoxscorePlayer"], sc.PLAYER_BOXSCORE_JSON,
                               lambda j: ns.college_player_boxscores(ns.player_boxscores(j))),
    "GameLines": Load(sc.BASKETBALL_TABLES["GameLines"], sc.LINES_JSON, lambda j: ns.college_lines(ns.game_lines(j))),
}


def load(store: TableStore, which: Load, docs: DataFrame, dry_run: bool = False) -> LoadResult:
    return store.upsert(which.rows(docs), which.spec, dry_run)


def load_landing(store: TableStore, which: Load, path: str, dry_run: bool = False) -> LoadResult:
    """Load a landing directory; documents that do not parse are set aside and counted in the result."""
    result = load(store, which, read_landing(store.spark, path, which.ddl), dry_run)
    return replace(result, rejected=store.reject(broken_documents(store.spark, path, which.ddl), which.spec))


def build_tables(
    store: TableStore, loads: dict[str, Load], landing: str, only: Iterable[str] | None = None,
    seasons: Sequence[int] | None = None, as_of: date | None = None, back: int = 5, ahead: int = 0, dry_run: bool = False,
) -> DataFrame:
    """Load `landing/{table}` for each table and return the run log.

    `seasons` limits documents that carry a season; `as_of` limits dated tables to a look-back window, which a
    keyed upsert makes safe to repeat. A failed table is logged and the others go on.
    """
    log = []
    for name, which in loads.items():
        if only is not None and name not in set(only):
            continue
        begun = datetime.now(timezone.utc)
        result, error = None, None
        try:
            docs = read_landing(store.spark, f"{landing.rstrip('/')}/{name}", which.ddl)
            if seasons is not None and "season" in docs.columns:
                docs = season_scan(docs, seasons)
            rows = which.rows(docs)
            if as_of is not None and which.when:
                rows = recent(rows, which.when, as_of, back, ahead)
            result = store.upsert(rows, which.spec, dry_run)
            broken = store.reject(broken_documents(store.spark, f"{landing.rstrip('/')}/{name}", which.ddl), which.spec)
            error = f"{broken} documents could not be read" if broken else None
        except Exception as e:  # noqa: BLE001 - one table must not stop the others
            error = f"{type(e).__name__}: {e}"[:500]
        log.append((name, result is not None, (result.inserted if result else 0), (result.updated if result else 0),
                    begun, datetime.now(timezone.utc), error))
    return run_log(store.spark, log)


def load_pitches(
    store: TableStore, raw: DataFrame, start: str, end: str, arrival: Sequence[str], team: str | None = None,
    dry_run: bool = False, only_if_absent: bool = False,
) -> LoadResult:
    """Pitches of a date range into their table, as one merge whatever its size.

    `only_if_absent` leaves the table alone when it already holds rows of the range.
    """
    spec = sc.BASEBALL_TABLES["StatcastPitches"]
    if only_if_absent and store.exists(spec) and has_data(store.read(spec), "game_date", start, end):
        return LoadResult(spec.name, dry_run=dry_run)
    return store.upsert(cl.clean_pitches(pitch_scan(raw, start, end, team), list(arrival)), spec, dry_run)


def load_pitch_season(store: TableStore, raw: DataFrame, season: int, arrival: Sequence[str], **kw) -> LoadResult:
    start, end = season_bounds(season, PITCH_SEASONS, PITCH_DEFAULT)
    return load_pitches(store, raw, start, end, arrival, **kw)


def load_odds_seasons(store: TableStore, pages: DataFrame, seasons: Sequence[int], dry_run: bool = False) -> LoadResult:
    """Odds pages of several seasons; their days are filters on one scan."""
    day, wanted = F.col("date").cast("date"), F.lit(False)
    for s in seasons:
        first, last = season_bounds(s, ODDS_SEASONS, ODDS_DEFAULT)
        wanted = wanted | day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return load(store, BASEBALL_LOADS["BettingOdds"], pages.where(wanted), dry_run)


def run_log(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows, "step string, success boolean, inserted long, updated long, begun timestamp, finished timestamp, error string")
