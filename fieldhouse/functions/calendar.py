"""Seasons, look-back windows and time zones."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EASTERN = "America/New_York"

# First and last day of pitch data per season.
PITCH_SEASONS = {
    2024: ("2024-03-28", "2024-09-29"),
    2023: ("2023-03-30", "2023-10-01"),
    2022: ("2022-04-07", "2022-10-05"),
    2021: ("2021-04-01", "2021-10-03"),
    2020: ("2020-07-23", "2020-09-27"),
    2019: ("2019-03-28", "2019-09-29"),
    2018: ("2018-03-29", "2018-10-01"),
    2017: ("2017-04-02", "2017-10-01"),
    2016: ("2016-04-03", "2016-10-02"),
    2015: ("2015-04-05", "2015-10-04"),
}
# Month-day bounds of a pitch season that is not listed.
PITCH_DEFAULT = ("03-28", "10-01")

# First and last day with odds per season.
ODDS_SEASONS = {
    2024: ("2024-03-20", "2024-10-01"),
    2023: ("2023-03-30", "2023-10-01"),
    2022: ("2022-04-07", "2022-10-05"),
    2021: ("2021-04-01", "2021-10-03"),
    2020: ("2020-07-23", "2020-09-27"),
    2019: ("2019-03-20", "2019-09-29"),
    2018: ("2018-03-29", "2018-10-01"),
}
# Month-day bounds of an odds season that is not listed.
ODDS_DEFAULT = ("04-01", "10-01")


def season_of(day: Column) -> Column:
    """Baseball season a day belongs to: January and February still count to the year before."""
    return F.when(F.month(day) < 3, F.year(day) - 1).otherwise(F.year(day))


def season_bounds(season: int, listed: dict[int, tuple[str, str]], default: tuple[str, str]) -> tuple[str, str]:
    return listed.get(season) or (f"{season}-{default[0]}", f"{season}-{default[1]}")


def with_season_bounds(
    df: DataFrame, season: str, listed: dict[int, tuple[str, str]], default: tuple[str, str],
) -> DataFrame:
    """Add `season_start` and `season_end` dates by a small constant map."""
    def side(i: int) -> Column:
        table = F.create_map(*[F.lit(x) for s, b in sorted(listed.items()) for x in (s, b[i])])
        known = F.try_element_at(table, F.col(season).cast("int"))
        return F.coalesce(known, F.concat(F.col(season).cast("string"), F.lit(f"-{default[i]}"))).cast("date")

    return df.withColumns({"season_start": side(0), "season_end": side(1)})


def recent(df: DataFrame, when: str, as_of: date, back: int = 5, ahead: int = 0) -> DataFrame:
    """Rows from `back` days before to `ahead` days after `as_of`, whole days, both inclusive.

    A range test typed like the column, so it prunes at the scan.
    """
    kind = df.schema[when].dataType
    first, after = (F.lit(as_of + timedelta(days=n)).cast(kind) for n in (-back, ahead + 1))
    return df.where((F.col(when) >= first) & (F.col(when) < after))


def eastern_days_in_utc(start: Column, end: Column) -> tuple[Column, Column]:
    """UTC instants that bound the Eastern days `start`..`end`: first inclusive, second exclusive."""
    return (F.to_utc_timestamp(start.cast("timestamp"), EASTERN),
            F.to_utc_timestamp(F.date_add(end.cast("date"), 1).cast("timestamp"), EASTERN))


def eastern_window(start: date, end: date) -> tuple[datetime, datetime]:
    """The same bounds as Python values, for building a scan filter."""
    zone = ZoneInfo(EASTERN)
    return tuple(
        datetime(d.year, d.month, d.day, tzinfo=zone).astimezone(ZoneInfo("UTC")).replace(tzinfo=None)
        for d in (start, end + timedelta(days=1)))


def eastern_game_day(start: Column) -> Column:
    """Calendar day of a tip-off at a fixed five hours behind UTC."""
    return F.to_date(start - F.expr("INTERVAL 5 HOURS"))


def season_table(spark: SparkSession, listed: dict[int, tuple[str, str]]) -> DataFrame:
    """The listed seasons as a DataFrame."""
    rows = [(s, date.fromisoformat(a), date.fromisoformat(b)) for s, (a, b) in sorted(listed.items())]
    return spark.createDataFrame(rows, "season int, season_start date, season_end date")
