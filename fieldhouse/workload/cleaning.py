"""Cleaning, deduplication and profiling queries over raw-looking views of the order tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldhouse.functions import calendar as cal
from fieldhouse.functions import coerce as co
from fieldhouse.functions import names as nm
from fieldhouse.operators import cleaning as cl
from fieldhouse.operators import profile as pf
from fieldhouse.operators import shape as sh
from fieldhouse.operators.ordering import keep_first
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import table

# ---- coercions ---------------------------------------------------------------------------------------------

_RAW_IDS = """raw AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'abc'
  WHEN o_orderkey % 3 = 0 THEN o_custkey || '.0' ELSE o_custkey::VARCHAR END AS id_text,
  CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE o_totalprice::VARCHAR END AS num_text,
  CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1' END AS bit_text FROM orders)"""


def raw_orders(spark, d):
    k = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(k % 11 == 0, None).when(k % 7 == 0, "abc").when(k % 3 == 0, F.concat(cust, F.lit(".0"))).otherwise(
            cust).alias("id_text"),
        F.when(k % 9 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("num_text"),
        F.when(k % 4 == 0, "true").when(k % 4 == 1, "false").when(k % 4 == 2, "1").alias("bit_text"))


@query("id_normalisation", f"""
WITH {_RAW_IDS} SELECT o_orderkey, try_cast(id_text AS DECIMAL(38,4))::BIGINT::VARCHAR AS id FROM raw""")
def id_normalisation(spark, d):
    return raw_orders(spark, d).select("o_orderkey", co.to_id(F.col("id_text")).alias("id"))


@query("id_or_text_fallback", """
SELECT n_nationkey, n_nationkey::VARCHAR AS key_id, n_name AS name_id FROM nation""")
def id_or_text_fallback(spark, d):
    df = table(spark, d, "nation").select(
        "n_nationkey", F.concat("n_nationkey", F.lit(".0")).alias("key_id"), F.col("n_name").alias("name_id"))
    return co.to_id_or_text(df, ["key_id", "name_id"])


@query("numeric_coercion", f"""
WITH {_RAW_IDS} SELECT o_orderkey, try_cast(num_text AS DOUBLE) AS amount,
  round_even(try_cast(num_text AS DOUBLE), 0)::BIGINT AS whole FROM raw""")
def numeric_coercion(spark, d):
    return raw_orders(spark, d).select(
        "o_orderkey", co.to_number(F.col("num_text")).alias("amount"), co.to_whole(F.col("num_text")).alias("whole"))


@query("bit_coercion", f"""
WITH {_RAW_IDS} SELECT o_orderkey, CASE WHEN bit_text IN ('true', '1') THEN 1 WHEN bit_text = 'false' THEN 0 END AS nullable_bit,
  CASE WHEN bit_text IN ('true', '1') THEN 1 ELSE 0 END AS zero_bit FROM raw""")
def bit_coercion(spark, d):
    b = F.col("bit_text")
    return raw_orders(spark, d).select(
        "o_orderkey", co.to_bit(b).alias("nullable_bit"), co.to_bit(b, null_is_zero=True).alias("zero_bit"))


@query("fixed_scale_rounding", """
SELECT event_id, round_even(event_id / 8.0::DOUBLE, 2) AS game_score, round_even(event_id / 32.0::DOUBLE, 4) AS excitement FROM events""")
def fixed_scale_rounding(spark, d):
    v = F.col("event_id")  # eighths and 32nds end in exact halves, where half-even shows
    return table(spark, d, "events").select(
        "event_id", co.to_scale(v / 8, 2).alias("game_score"), co.to_scale(v / 32, 4).alias("excitement"))


@query("nan_to_null", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events""")
def nan_to_null(spark, d):
    raw = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return co.null_for_nan(raw)


@query("text_trimming", """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE substr(p_name, 1, 4) END AS short_name FROM part""")
def text_trimming(spark, d):
    raw = F.when(F.col("p_partkey") % 10 == 0, "nan").otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", co.to_text(raw, 4).alias("short_name"))


@query("date_text_parsing", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate::DATE END AS day,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate::TIMESTAMP END AS moment FROM orders""")
def date_text_parsing(spark, d):
    bad = F.col("o_orderkey") % 6 == 0
    day = F.when(bad, "someday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    iso = F.when(bad, "2020-13-40T00:00:00Z").when(
        F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, d, "orders").select(
        "o_orderkey", co.parse_day(day).alias("day"), co.parse_iso(iso).alias("moment"))


@query("date_named_columns", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate END AS startDate, o_orderstatus AS status FROM orders""")
def date_named_columns(spark, d):
    text = F.when(F.col("o_orderkey") % 6 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return co.date_named_to_time(table(spark, d, "orders").select(
        "o_orderkey", text.alias("startDate"), F.col("o_orderstatus").alias("status")))


@query("clean_column_names", "SELECT l_orderkey, l_linenumber AS l_line_number, l_quantity AS home_team_pts, l_tax AS _3pt_pct FROM lineitem")
def clean_column_names(spark, d):
    raw = table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("L LineNumber"), F.col("l_quantity").alias("homeTeam--PTS"),
        F.col("l_tax").alias("3ptPct"))
    return nm.snake_columns(raw)


# ---- calendar ----------------------------------------------------------------------------------------------


@query("eastern_day_window", """
SELECT DISTINCT o_orderdate::DATE AS day,
  ((o_orderdate::TIMESTAMP AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') AS utc_start,
  (((o_orderdate + INTERVAL 1 DAY)::TIMESTAMP AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') AS utc_end FROM orders""")
def eastern_day_window(spark, d):
    day = F.to_date("o_orderdate")
    start, end = cal.eastern_days_in_utc(day, day)
    return table(spark, d, "orders").select(day.alias("day"), start.alias("utc_start"), end.alias("utc_end")).distinct()


@query("season_of_day", """
SELECT o_orderkey, (year(o_orderdate) - (month(o_orderdate) < 3)::INTEGER)::INTEGER AS season FROM orders""")
def season_of_day(spark, d):
    return table(spark, d, "orders").select("o_orderkey", cal.season_of(F.col("o_orderdate")).alias("season"))


@query("season_bounds", """
WITH s AS (SELECT DISTINCT (year(o_orderdate) + 20)::INTEGER AS season FROM orders)
SELECT season, CASE season WHEN 2015 THEN DATE '2015-04-05' WHEN 2016 THEN DATE '2016-04-03' WHEN 2017 THEN DATE '2017-04-02'
  WHEN 2018 THEN DATE '2018-03-29' WHEN 2019 THEN DATE '2019-03-28' WHEN 2020 THEN DATE '2020-07-23'
  WHEN 2021 THEN DATE '2021-04-01' ELSE make_date(season, 3, 28) END AS season_start,
  CASE season WHEN 2015 THEN DATE '2015-10-04' WHEN 2016 THEN DATE '2016-10-02' WHEN 2017 THEN DATE '2017-10-01'
  WHEN 2018 THEN DATE '2018-10-01' WHEN 2019 THEN DATE '2019-09-29' WHEN 2020 THEN DATE '2020-09-27'
  WHEN 2021 THEN DATE '2021-10-03' ELSE make_date(season, 10, 1) END AS season_end FROM s""")
def season_bounds(spark, d):
    seasons = table(spark, d, "orders").select((F.year("o_orderdate") + 20).alias("season")).distinct()
    return cal.with_season_bounds(seasons, "season", cal.PITCH_SEASONS, cal.PITCH_DEFAULT)


@query("recent_games", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-05-27' AND o_orderdate < TIMESTAMP '1998-06-02'""")
def recent_games(spark, d):
    return cal.recent(table(spark, d, "orders"), "o_orderdate", date(1998, 6, 1), back=5).select(
        "o_orderkey", "o_orderdate")


# ---- games and boxscores -----------------------------------------------------------------------------------

_RAW_GAMES = """raw AS (SELECT (o_orderkey // 3)::VARCHAR AS game_id, year(o_orderdate)::VARCHAR AS season,
  o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS game_datetime, CASE WHEN o_orderkey % 37 <> 0 THEN o_custkey::VARCHAR END AS home_id,
  (o_custkey + 1)::VARCHAR AS away_id, CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'P' THEN 'Postponed' END AS status,
  o_orderkey FROM orders)"""


def raw_games(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        F.expr("cast(o_orderkey div 3 as string)").alias("game_id"), F.year("o_orderdate").cast("string").alias("season"),
        F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("o_orderdate")).alias("game_datetime"),
        F.when(k % 37 != 0, F.col("o_custkey").cast("string")).alias("home_id"),
        (F.col("o_custkey") + 1).cast("string").alias("away_id"),
        F.when(F.col("o_orderstatus") == "F", "Final").when(F.col("o_orderstatus") == "P", "Postponed").alias("status"),
        "o_orderkey")


@query("clean_games", f"""
WITH {_RAW_GAMES} SELECT * FROM raw WHERE home_id IS NOT NULL AND status IS DISTINCT FROM 'Postponed'
QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY game_datetime, o_orderkey) = 1""")
def clean_games(spark, d):
    return cl.clean_games(raw_games(spark, d), ["o_orderkey"])


@query("completed_statuses", f"""
WITH {_RAW_GAMES} SELECT o_orderkey, coalesce(status = 'Final', false) AS listed,
  coalesce(regexp_matches(status, 'Final|Completed'), false) AS matched, status IS DISTINCT FROM 'Postponed' AS kept FROM raw""")
def completed_statuses(spark, d):
    s = F.col("status")
    return raw_games(spark, d).select(
        "o_orderkey", cl.is_completed(s).alias("listed"), cl.looks_completed(s).alias("matched"),
        cl.not_postponed(s).alias("kept"))


@query("lines_of_completed_games", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def lines_of_completed(spark, d):
    games = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.when(F.col("o_orderstatus") == "F", "Final").alias("status"))
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("game_id"), "l_linenumber", "l_quantity")
    return cl.completed_only(rows, games).withColumnRenamed("game_id", "l_orderkey")


_BOX = """raw AS (SELECT l_orderkey::VARCHAR AS game_id, (l_partkey % 50)::VARCHAR AS player_id, l_suppkey::VARCHAR AS team_id,
  (l_linenumber % 2)::VARCHAR AS is_home, CASE WHEN l_partkey % 17 = 0 THEN '-.--' ELSE l_quantity::VARCHAR END AS runs,
  l_tax::VARCHAR AS era, l_linenumber, l_partkey, l_shipdate, l_extendedprice FROM lineitem)"""
_TIES = ["is_home", "team_id", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]


def raw_boxscores(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("game_id"), (F.col("l_partkey") % 50).cast("string").alias("player_id"),
        F.col("l_suppkey").cast("string").alias("team_id"), (F.col("l_linenumber") % 2).cast("string").alias("is_home"),
        F.when(F.col("l_partkey") % 17 == 0, "-.--").otherwise(F.col("l_quantity").cast("string")).alias("runs"),
        F.col("l_tax").cast("string").alias("era"), "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")


@query("clean_player_boxscores", f"""
WITH {_BOX} SELECT game_id, player_id, team_id, is_home::INTEGER AS is_home, try_cast(runs AS DOUBLE)::INTEGER AS runs,
  try_cast(era AS DOUBLE) AS era FROM raw
QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY is_home::INTEGER, {", ".join(_TIES[1:])}) = 1""")
def clean_player_boxscores(spark, d):
    return cl.clean_player_boxscores(raw_boxscores(spark, d), _TIES).select(
        "game_id", "player_id", "team_id", "is_home", "runs", "era")


@query("clean_team_boxscores", f"""
WITH {_BOX} SELECT game_id, team_id, l_linenumber, l_partkey, is_home::INTEGER AS is_home, try_cast(runs AS DOUBLE)::INTEGER AS runs,
  try_cast(era AS DOUBLE) AS era FROM raw""")
def clean_team_boxscores(spark, d):
    return cl.clean_team_boxscores(raw_boxscores(spark, d)).select(
        "game_id", "team_id", "l_linenumber", "l_partkey", "is_home", "runs", "era")


@query("required_not_null", f"WITH {_RAW_GAMES} SELECT game_id, season, home_id, status FROM raw WHERE home_id IS NOT NULL AND status IS NOT NULL")
def required_not_null(spark, d):
    return sh.without_nulls(raw_games(spark, d), ["home_id", "status"]).select("game_id", "season", "home_id", "status")


# ---- pitches -----------------------------------------------------------------------------------------------

_ARRIVAL = ["l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount"]
_PITCH_SQL = f"""raw AS (SELECT CASE WHEN l_orderkey % 41 <> 0 THEN l_orderkey::VARCHAR END AS game_pk, l_shipdate::DATE AS game_date,
  year(l_shipdate)::INTEGER AS game_year, l_linenumber AS at_bat_number, (l_partkey % 3)::INTEGER AS pitch_number,
  l_suppkey::INTEGER AS pitcher, CASE WHEN l_partkey % 29 <> 0 THEN l_partkey::INTEGER END AS batter,
  'Pitcher ' || l_suppkey AS pitcher_name, (l_linenumber + 4)::INTEGER AS zone,
  CASE l_suppkey % 5 WHEN 0 THEN 'swinging_strike' WHEN 1 THEN 'foul' WHEN 2 THEN 'ball' WHEN 3 THEN 'hit_into_play' ELSE 'missed_bunt' END AS description,
  CASE WHEN l_partkey % 6 = 0 THEN 'home_run' END AS events, coalesce(l_partkey % 6 = 0, false)::INTEGER AS home_run,
  CASE WHEN l_partkey % 31 <> 0 THEN l_quantity * 2.5 END AS launch_speed,
  (l_suppkey % 3 = 0)::INTEGER AS barrel, CASE WHEN l_suppkey % 2 = 0 THEN 'R' ELSE 'L' END AS stand, {", ".join(_ARRIVAL)} FROM lineitem),
pitches AS (SELECT * EXCLUDE ({", ".join(_ARRIVAL)}) FROM (SELECT * FROM raw WHERE game_pk IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY game_pk, at_bat_number, pitch_number ORDER BY {", ".join(c + " DESC" for c in _ARRIVAL)}) = 1)
  WHERE batter IS NOT NULL)"""


def raw_pitches(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        F.when(c("l_orderkey") % 41 != 0, c("l_orderkey").cast("double")).alias("game_pk"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("game_date"), F.year("l_shipdate").cast("string").alias("game_year"),
        F.concat(c("l_linenumber").cast("string"), F.lit(".0")).alias("at_bat_number"), (c("l_partkey") % 3).alias("pitch_number"),
        c("l_suppkey").cast("string").alias("pitcher"),
        F.when(c("l_partkey") % 29 == 0, "unknown").otherwise(c("l_partkey").cast("string")).alias("batter"),
        F.concat(F.lit("Pitcher "), "l_suppkey").alias("player_name"), (c("l_linenumber") + 4).alias("zone"),
        F.when(c("l_suppkey") % 5 == 0, "swinging_strike").when(c("l_suppkey") % 5 == 1, "foul").when(
            c("l_suppkey") % 5 == 2, "ball").when(c("l_suppkey") % 5 == 3, "hit_into_play").otherwise("missed_bunt").alias("description"),
        F.when(c("l_partkey") % 6 == 0, "home_run").otherwise("nan").alias("events"), F.lit(0).alias("home_run"),
        F.when(c("l_partkey") % 31 == 0, "bad").otherwise((c("l_quantity") * 2.5).cast("string")).alias("launch_speed"),
        F.when(c("l_suppkey") % 3 == 0, "true").when(c("l_suppkey") % 3 == 1, "false").alias("barrel"),
        F.when(c("l_suppkey") % 2 == 0, "Right").otherwise("Left").alias("stand"), F.lit("x").alias("not_kept"), *_ARRIVAL)


def pitches(spark, d):
    return cl.clean_pitches(raw_pitches(spark, d), _ARRIVAL)


@query("clean_pitches", f"WITH {_PITCH_SQL} SELECT *, NULL::VARCHAR AS batter_name FROM pitches")
def clean_pitches(spark, d):
    return pitches(spark, d)


@query("pitch_flags", f"""
WITH {_PITCH_SQL} SELECT pitcher, count(*) AS pitches, sum((description <> 'ball')::INTEGER)::BIGINT AS swings,
  sum((description IN ('swinging_strike', 'missed_bunt'))::INTEGER)::BIGINT AS whiffs, sum((zone <= 9)::INTEGER)::BIGINT AS in_zone,
  sum(coalesce(launch_speed >= 95, false)::INTEGER)::BIGINT AS hard_hits FROM pitches GROUP BY pitcher""")
def pitch_flags(spark, d):
    return cl.pitch_flags(pitches(spark, d)).groupBy("pitcher").agg(
        F.count("*").alias("pitches"), F.sum("swing").alias("swings"), F.sum("whiff").alias("whiffs"),
        F.sum("in_zone").alias("in_zone"), F.sum("hard_hit").alias("hard_hits"))


@query("date_range_summary", """
SELECT min(l_shipdate) AS min_date, max(l_shipdate) AS max_date, count(*) AS pitch_count, count(DISTINCT l_orderkey) AS game_count
FROM lineitem WHERE l_shipdate::DATE BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'""")
def date_range_summary(spark, d):
    return pf.date_range_summary(table(spark, d, "lineitem"), "l_shipdate", "l_orderkey", "1997-03-01", "1997-09-30")


@query("extract_summary", """
SELECT count(*) AS records, min(ts) AS first_day, max(ts) AS last_day, count(DISTINCT user_id) AS users,
  count(DISTINCT event_type) AS kinds FROM events""")
def extract_summary(spark, d):
    return pf.extract_summary(table(spark, d, "events"), "ts", {"users": "user_id", "kinds": "event_type"})


@query("distinct_values", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def distinct_values(spark, d):
    return pf.distinct_values(table(spark, d, "events"), "event_type")


@query("head_preview", "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 5")
def head_preview(spark, d):
    """A preview: its limit is the feature."""
    return sh.preview(table(spark, d, "events").select("event_id", "user_id"), 5, ["event_id"])


# ---- duplicates and profiles -------------------------------------------------------------------------------


@query("duplicate_report", """
WITH r AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT coalesce(sum(n), 0)::BIGINT AS duplicate_rows, count(*) AS repeated_keys FROM r""")
def duplicate_report(spark, d):
    return pf.duplicate_report(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")
def duplicate_rows(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return pf.duplicate_rows(rows, ["l_orderkey", "l_linenumber"])


@query("keep_first_line", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) = 1""")
def keep_first_line(spark, d):
    rows = table(spark, d, "lineitem")
    return keep_first(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


def _profile_sql(col: str, kind: str, number: bool) -> str:
    stats = (f"min({col})::DOUBLE, max({col})::DOUBLE, round(avg({col}), 6), count(*) FILTER ({col} = 0), count(*) FILTER ({col} < 0)"
             if number else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT")
    return (f"SELECT '{col}' AS column_name, '{kind}' AS data_type, count(*) AS rows, count(*) FILTER ({col} IS NULL) AS nulls, "
            f"round(count(*) FILTER ({col} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_pct, {stats} FROM customer")


_PROFILE_COLS = [("c_custkey", "bigint", True), ("c_name", "string", False), ("c_nationkey", "int", True),
                 ("c_acctbal", "double", True), ("c_mktsegment", "string", False)]


@query("column_profile", "SELECT * FROM (" + " UNION ALL ".join(_profile_sql(*c) for c in _PROFILE_COLS) +
       ") t(column_name, data_type, rows, nulls, null_pct, min_value, max_value, mean_value, zeros, negatives)")
def column_profile(spark, d):
    p = pf.column_profile(table(spark, d, "customer"))
    return p.select([r6(c) if c in ("null_pct", "mean_value") else F.col(c) for c in p.columns])


@query("value_counts", "SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM events GROUP BY event_type")
def value_counts(spark, d):
    return pf.value_counts(table(spark, d, "events"), "event_type").select("event_type", "n", r6("share"))


@query("feature_alignment", """
SELECT l_orderkey, l_linenumber, l_quantity, 0.0::DOUBLE AS rest_diff, l_tax FROM lineitem""")
def feature_alignment(spark, d):
    rows = table(spark, d, "lineitem")
    return sh.align_features(rows, ["l_quantity", "rest_diff", "l_tax"], keep=["l_orderkey", "l_linenumber"])


@query("schema_conformance", """
SELECT c_custkey::VARCHAR AS team_id, c_name AS team_name, trunc(c_acctbal)::INTEGER AS runs, NULL::DATE AS first_day
FROM customer""")
def schema_conformance(spark, d):
    src = table(spark, d, "customer").select(
        F.col("c_name").alias("team_name"), F.col("c_custkey").alias("team_id"), F.col("c_acctbal").alias("runs"), "c_mktsegment")
    return sh.conform(src, T.StructType.fromDDL("team_id string, team_name string, runs int, first_day date"))
