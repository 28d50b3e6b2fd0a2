"""Upsert, copy and load queries, shown as the rows they would store."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldhouse.functions.calendar import PITCH_DEFAULT, PITCH_SEASONS, season_bounds
from fieldhouse.operators import upsert as up
from fieldhouse.operators.profile import repeated_keys
from fieldhouse.operators.sizing import Limits
from fieldhouse.plans.loads import Load
from fieldhouse.schemas import TableSpec
from fieldhouse.session import ensure_checkpoint_dir
from fieldhouse.sources.files import pitch_scan, season_scan
from fieldhouse.sources.tables import TableStore
from fieldhouse.streaming.landing import ARRIVED, follow_landing
from fieldhouse.workload.registry import query
from fieldhouse.workload.views import GAMES_CTE, games, sides, table

_THEN, _NOW = "2020-01-01 00:00:00", "2024-06-01 00:00:00"


def _target(spark, d):
    """The orders as stored earlier: every third is not there yet, and status is unknown for every seventh."""
    then = F.lit(_THEN).cast("timestamp")
    return table(spark, d, "orders").where("o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("price"), then.alias("insert_date"), then.alias("update_date"))


def _source(spark, d):
    """Today's delivery: most orders, every fifth with a new price, status withdrawn for every eleventh."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").where("o_orderkey % 4 <> 0").select(
        "o_orderkey", F.when(k % 11 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(k % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"))


_MERGE = f"""t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status, o_totalprice AS price FROM orders
  WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0),
s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 4 <> 0),
j AS (SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_orderkey IS NULL AS fresh, s.o_orderkey IS NULL AS gone,
  s.status IS NOT DISTINCT FROM t.status AND s.price IS NOT DISTINCT FROM t.price AS same, t.status AS ts, t.price AS tp, s.status AS ss, s.price AS sp
  FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey),
merged AS (SELECT o_orderkey, CASE WHEN gone THEN ts ELSE ss END AS status, CASE WHEN gone THEN tp ELSE sp END AS price,
  CASE WHEN fresh THEN TIMESTAMP '{_NOW}' ELSE TIMESTAMP '{_THEN}' END AS insert_date,
  CASE WHEN fresh OR (NOT gone AND NOT same) THEN TIMESTAMP '{_NOW}' ELSE TIMESTAMP '{_THEN}' END AS update_date,
  CASE WHEN fresh THEN 'insert' WHEN gone THEN 'keep' WHEN same THEN 'same' ELSE 'update' END AS _action FROM j)"""


def _merged(spark, d, small):
    return up.merge_rows(_target(spark, d), _source(spark, d), ["o_orderkey"], F.lit(_NOW).cast("timestamp"), small)


@query("upsert_rows", f"WITH {_MERGE} SELECT * FROM merged")
def upsert_rows(spark, d):
    return _merged(spark, d, False)


@query("upsert_rows_small_source", f"WITH {_MERGE} SELECT * FROM merged")
def upsert_rows_small(spark, d):
    """The same merge with the source broadcast; the caller has checked its size."""
    source = _source(spark, d)
    limit = Limits.of(spark).broadcast_rows
    return _merged(spark, d, source.limit(limit + 1).count() <= limit)


@query("upsert_counts", f"WITH {_MERGE} SELECT _action, count(*) AS n FROM merged GROUP BY _action")
def upsert_counts(spark, d):
    return up.action_counts(_merged(spark, d, False))


@query("insert_only_copy", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 3 = 0""")
def insert_only_copy(spark, d):
    source = table(spark, d, "orders").where("o_orderkey % 4 <> 0").select("o_orderkey", "o_totalprice", F.lit(1).alias("boxscoreId"))
    return up.new_rows(source, _target(spark, d), ["o_orderkey"], ["boxscoreId"])


@query("insert_only_copy_two_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_partkey % 2 = 0) GROUP BY ALL""")
def insert_only_copy_two_keys(spark, d):
    li = table(spark, d, "lineitem")
    return up.new_rows(li, li.where("l_partkey % 2 = 0"), ["l_orderkey", "l_linenumber"]).groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n"))


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("customer", "orders", "lineitem")))
def table_counts(spark, d):
    parts = [table(spark, d, t).agg(F.lit(t).alias("table"), F.count("*").alias("rows")) for t in ("customer", "orders", "lineitem")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("repeated_source_keys", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def repeated_source_keys(spark, d):
    return repeated_keys(table(spark, d, "lineitem"), ["l_orderkey"])


@query("season_subset", f"WITH {GAMES_CTE} SELECT gameId, season FROM games WHERE season IN (1996, 1998)")
def season_subset(spark, d):
    return season_scan(games(spark, d), [1996, 1998]).select("gameId", "season")


@query("date_and_team_scan", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'
  AND (l_returnflag = 'A' OR l_linestatus = 'A')""")
def date_and_team_scan(spark, d):
    rows = table(spark, d, "lineitem").withColumnsRenamed({"l_returnflag": "home_team", "l_linestatus": "away_team"})
    return pitch_scan(rows, "1997-01-01", "1997-06-30", "A", day="l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey")


@query("season_pitch_days", """
SELECT l_shipdate::DATE AS day, count(*) AS pitches FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1998-03-28' AND TIMESTAMP '1998-10-01' GROUP BY 1""")
def season_pitch_days(spark, d):
    start, end = season_bounds(1998, PITCH_SEASONS, PITCH_DEFAULT)
    rows = pitch_scan(table(spark, d, "lineitem"), start, end, day="l_shipdate")
    return rows.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("pitches"))


@query("bag_union_of_seasons", f"""
WITH {GAMES_CTE} SELECT gameId, season FROM games WHERE season = 1996 UNION ALL SELECT gameId, season FROM games WHERE season IN (1996, 1997)""")
def bag_union(spark, d):
    g = games(spark, d).select("gameId", "season")
    return season_scan(g, [1996]).unionByName(season_scan(g, [1996, 1997]))


@query("game_lines", """SELECT (SELECT count(*) FROM lineitem) AS lines_in, CAST(sum(n) AS BIGINT) AS lines_used, count(*) AS orders
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def game_lines(spark, d):
    """Lines that enter the game view, beside all there are."""
    every = table(spark, d, "lineitem").agg(F.count("*").alias("n")).scalar()
    return sides(spark, d).agg(F.sum(F.col("homeLines") + F.col("awayLines")).alias("lines_used"), F.count("*").alias("orders")).select(
        every.alias("lines_in"), "lines_used", "orders")


# ---- stored tables -----------------------------------------------------------------------------------------

STORED = TableSpec("Deliveries", ("o_orderkey",), "o_orderkey long, status string, price double", partition_by=("status",))
LOADS = ("first", "dry run", "second", "repeated")


def _stored(spark, d):
    """The orders as stored earlier, then today's delivery: dry, in earnest, and once more. Status F goes, and its partition."""
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark)}/fieldhouse-tables/{uuid.uuid4().hex}")
    today = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"),
                                             (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)).alias("price"))
    first = store.upsert(_target(spark, d).select("o_orderkey", F.coalesce("status", F.lit("?")).alias("status"), "price"), STORED)
    seen = [first] + [store.upsert(today, STORED, dry_run=dry) for dry in (True, False, False)]
    return store, seen


@query("stored_after_upserts", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS price,
  NOT (o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0) AS added_later FROM orders""")
def stored_after_upserts(spark, d):
    store, _ = _stored(spark, d)
    rows = store.read(STORED)
    start = rows.agg(F.min("insert_date").alias("at")).scalar()
    return rows.select("o_orderkey", "status", "price", (F.col("insert_date") > start).alias("added_later"))


@query("stored_upsert_reports", f"""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus ELSE '?' END AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0),
s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS price FROM orders),
j AS (SELECT count(*) FILTER (t.o_orderkey IS NULL) AS fresh, count(*) FILTER (t.status IS NOT DISTINCT FROM s.status AND t.price = s.price) AS same, count(*) AS n
  FROM s LEFT JOIN t USING (o_orderkey))
SELECT 'first' AS load, (SELECT count(*) FROM t) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged
UNION ALL SELECT unnest(['dry run', 'second']), fresh, n - fresh - same, same FROM j UNION ALL SELECT 'repeated', 0, 0, n FROM j""")
def stored_upsert_reports(spark, d):
    _, seen = _stored(spark, d)
    return spark.createDataFrame([(name, r.inserted, r.updated, r.unchanged) for name, r in zip(LOADS, seen, strict=True)],
                                 "load string, inserted long, updated long, unchanged long")


FOLLOWED = TableSpec("Followed", ("o_orderkey",), "o_orderkey long, status string, price double")


@query("landing_followed", """
SELECT o_orderkey, o_orderstatus AS status, o_totalprice + CASE WHEN o_orderkey % 11 = 0 THEN 2 WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS price,
  true AS replayed_alike FROM orders""")
def landing_followed(spark, d):
    """Three deliveries into a landing folder, each followed by a run of the stream; then all files replayed at once into another table."""
    root = f"{ensure_checkpoint_dir(spark)}/fieldhouse-landing/{uuid.uuid4().hex}"
    docs = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    k = F.col("o_orderkey")
    waves = [docs.where(k % 3 != 0),
             docs.where((k % 3 == 0) | (k % 5 == 0)).withColumn("price", F.col("price") + F.when(k % 5 == 0, 1).otherwise(0)),
             docs.where((k % 7 == 0) | (k % 11 == 0)).withColumn("price", F.col("price") + F.when(k % 11 == 0, 2).otherwise(0))]
    columns = [f.name for f in FOLLOWED.schema.fields]
    which = Load(FOLLOWED, FOLLOWED.ddl, lambda j: j.select(*columns, ARRIVED))
    store, again = TableStore(spark, f"{root}/tables"), TableStore(spark, f"{root}/replayed")
    for wave in waves:
        wave.write.mode("append").json(f"{root}/landing")
        follow_landing(store, which, f"{root}/landing", f"{root}/checkpoint", arrival=True).awaitTermination()
    follow_landing(again, which, f"{root}/landing", f"{root}/checkpoint-replayed", arrival=True).awaitTermination()
    other = again.read(FOLLOWED).select("o_orderkey", F.struct("status", "price").alias("_o"))
    alike = F.col("_o").eqNullSafe(F.struct("status", "price")).alias("replayed_alike")
    return store.read(FOLLOWED).join(other, "o_orderkey", "full").select(*columns, alike)
