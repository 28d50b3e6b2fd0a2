"""Files written and read back, and keyed tables loaded from the given ones: what a later reader finds in them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldhouse.operators.market import TOTALS_PRODUCTS, totals_interactions
from fieldhouse.plans import baseball
from fieldhouse.plans.loads import BASKETBALL_LOADS, build_tables, load_pitches
from fieldhouse.schemas import BASEBALL_TABLES, BASKETBALL_TABLES, TableSpec
from fieldhouse.session import ensure_checkpoint_dir
from fieldhouse.sources.files import processed_name, read_file, write_file
from fieldhouse.sources.tables import TableStore
from fieldhouse.workload.cleaning import _ARRIVAL, _PITCH_SQL, raw_pitches
from fieldhouse.workload.registry import query, r6
from fieldhouse.workload.views import GAMES_CTE, games, table


def _root(spark):
    return f"{ensure_checkpoint_dir(spark)}/fieldhouse-stores/{uuid.uuid4().hex}"


# ---- files -------------------------------------------------------------------------------------------------

KINDS = ("csv", "json", "parquet")


@query("files_round_trip", """
SELECT k.kind, l_orderkey, l_linenumber, l_shipdate, l_quantity, CASE WHEN l_linenumber <> 3 THEN l_shipmode END AS note
FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem), (SELECT unnest(['csv', 'json', 'parquet']) AS kind) AS k""")
def files_round_trip(spark, d):
    """All lines written in each format and read under their schema; NULLs come back as NULLs."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("note"))
    root, back = _root(spark), None
    for kind in KINDS:
        path = write_file(rows, processed_name(f"{root}/lines.{kind}"))
        part = read_file(spark, path, rows.schema.toDDL()).withColumn("kind", F.lit(kind))
        back = part if back is None else back.unionByName(part)
    return back


# ---- keyed tables ------------------------------------------------------------------------------------------

ORDERS = TableSpec("Orders", ("o_orderkey",), "o_orderkey long, status string, price double, day date", partition_by=("status",))
CUSTOMERS = TableSpec("Customers", ("c_custkey",), "c_custkey long, name string")


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
                                            F.to_date("o_orderdate").alias("day"))


@query("appended_in_parts", """
SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price, true AS stamped, (SELECT count(*) FROM orders) AS keys FROM orders""")
def appended_in_parts(spark, d):
    store, rows = TableStore(spark, _root(spark)), _orders(spark, d)
    for i in range(3):
        store.append(rows.where(F.col("o_orderkey") % 3 == i), ORDERS)
    stamped = (F.col("insert_date").isNotNull() & F.col("update_date").isNotNull()).alias("stamped")
    keys = store.keys(ORDERS).agg(F.count_distinct("o_orderkey").alias("n")).scalar()
    return store.read(ORDERS).select("o_orderkey", "status", "price", stamped, keys.alias("keys"))


@query("copied_tables", """
SELECT 'Customers' AS "table", (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS first, (SELECT count(*) FROM customer WHERE c_custkey % 2 <> 0) AS second,
  (SELECT count(*) FROM customer) AS rows
UNION ALL SELECT 'Orders', (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0), (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0), (SELECT count(*) FROM orders)""")
def copied_tables(spark, d):
    """Two copies of two tables, the second of all rows: only keys that are not there yet are added."""
    store = TableStore(spark, _root(spark))
    every = {"Orders": _orders(spark, d), "Customers": table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"))}
    some = {"Orders": every["Orders"].where("o_orderkey % 3 = 0"), "Customers": every["Customers"].where("c_custkey % 2 = 0")}
    specs = [CUSTOMERS, ORDERS]
    first = store.copy_all(some, specs).withColumnRenamed("inserted", "first")
    second = store.copy_all(every, specs).withColumnRenamed("inserted", "second")
    return first.join(second, "table").join(store.counts(specs), "table")


@query("loaded_unless_present", """
SELECT o_orderkey, o_orderstatus AS status, o_totalprice + CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE 0 END AS price
FROM orders WHERE year(o_orderdate) IN (1996, 1997)""")
def loaded_unless_present(spark, d):
    """1996 is loaded, then skipped with its new prices because it is there; 1997 is loaded with them."""
    store, rows = TableStore(spark, _root(spark)), _orders(spark, d)
    dearer = rows.withColumn("price", F.col("price") + 1)
    for source, year in ((rows, 1996), (dearer, 1996), (dearer, 1997)):
        store.load_unless_present(source.where(F.year("day") == year), ORDERS, "day", f"{year}-01-01", f"{year}-12-31")
    return store.read(ORDERS).select("o_orderkey", "status", "price")


_FIRST, _LAST = "1997-01-01", "1997-12-31"


@query("pitches_loaded", f"""
WITH {_PITCH_SQL.replace("FROM lineitem)", f"FROM lineitem WHERE l_shipdate::DATE BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}')")}
SELECT game_pk, game_date, at_bat_number, pitch_number, pitcher, batter, description, home_run, barrel, stand FROM pitches""")
def pitches_loaded(spark, d):
    """Pitches of a year in their table, loaded twice: the second load is left out, as the range has rows."""
    store, raw = TableStore(spark, _root(spark)), raw_pitches(spark, d)
    for _ in range(2):
        load_pitches(store, raw, _FIRST, _LAST, _ARRIVAL, only_if_absent=True)
    return store.read(BASEBALL_TABLES["StatcastPitches"]).select(
        "game_pk", "game_date", "at_bat_number", "pitch_number", "pitcher", "batter", "description", "home_run", "barrel", "stand")


# ---- tables built from landing documents -------------------------------------------------------------------

BUILT = ("ConferenceInfo", "VenueInfo", "TeamInfo")


def _built(spark, d):
    """Two builds: all documents, then again with new country codes for every fifth venue and a file that is not JSON."""
    root = _root(spark)
    store, landing = TableStore(spark, f"{root}/tables"), f"{root}/landing"
    k = F.col("c_custkey")
    venues = table(spark, d, "customer").select(F.when(k % 7 != 0, k.cast("string")).alias("id"), F.col("c_name").alias("name"), F.lit("US").alias("country"))
    table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")).write.json(f"{landing}/ConferenceInfo")
    table(spark, d, "supplier").select(
        F.concat("s_suppkey", F.lit(".0")).alias("id"), F.col("s_name").alias("school"), F.concat("s_nationkey", F.lit(".0")).alias("conferenceId")
    ).write.json(f"{landing}/TeamInfo")
    venues.write.json(f"{landing}/VenueInfo")
    logs = [build_tables(store, BASKETBALL_LOADS, landing, only=BUILT)]
    moved = F.when(F.col("id").cast("int") % 5 == 0, "CA").otherwise(F.col("country"))
    venues.withColumn("country", moved).write.mode("overwrite").json(f"{landing}/VenueInfo")
    table(spark, d, "region").select(F.concat(F.lit("{"), "r_name").alias("value")).write.mode("append").text(f"{landing}/VenueInfo")
    logs.append(build_tables(store, BASKETBALL_LOADS, landing, only=BUILT))
    return store, logs


@query("tables_built", """
SELECT 'VenueInfo' AS "table", c_custkey::VARCHAR AS key, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'CA' ELSE 'US' END AS detail FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT 'ConferenceInfo', n_nationkey::VARCHAR, n_name, NULL FROM nation
UNION ALL SELECT 'TeamInfo', s_suppkey::VARCHAR, s_name, s_nationkey::VARCHAR FROM supplier""")
def tables_built(spark, d):
    store, _ = _built(spark, d)
    read = {n: store.read(BASKETBALL_TABLES[n]) for n in BUILT}
    parts = [read["VenueInfo"].select(F.lit("VenueInfo").alias("table"), F.col("venueId").alias("key"), "name", F.col("country").alias("detail")),
             read["ConferenceInfo"].select(F.lit("ConferenceInfo").alias("table"), F.col("conferenceId").alias("key"), "name", F.lit(None).cast("string").alias("detail")),
             read["TeamInfo"].select(F.lit("TeamInfo").alias("table"), F.col("teamId").alias("key"), F.col("school").alias("name"), F.col("conferenceId").alias("detail"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("tables_built_log", """
WITH n AS (SELECT (SELECT count(*) FROM customer WHERE c_custkey % 7 <> 0) AS venues, (SELECT count(*) FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0) AS moved,
  (SELECT count(*) FROM nation) AS nations, (SELECT count(*) FROM supplier) AS teams, (SELECT count(*) FROM region) AS broken)
SELECT 1 AS run, 'ConferenceInfo' AS step, true AS success, nations AS inserted, 0::BIGINT AS updated, NULL::VARCHAR AS error FROM n
UNION ALL SELECT 1, 'VenueInfo', true, venues, 0, NULL FROM n UNION ALL SELECT 1, 'TeamInfo', true, teams, 0, NULL FROM n
UNION ALL SELECT 2, 'ConferenceInfo', true, 0, 0, NULL FROM n UNION ALL SELECT 2, 'VenueInfo', true, 0, moved, broken || ' documents could not be read' FROM n
UNION ALL SELECT 2, 'TeamInfo', true, 0, 0, NULL FROM n""")
def tables_built_log(spark, d):
    _, logs = _built(spark, d)
    first, second = (log.withColumn("run", F.lit(i)) for i, log in enumerate(logs, 1))
    return first.unionByName(second).select("run", "step", "success", "inserted", "updated", "error")


# ---- game table read for models ----------------------------------------------------------------------------


@query("baseball_games_read", f"""
WITH {GAMES_CTE} SELECT gameId, gameDate AS "gameDate", CASE WHEN gameId % 9 <> 0 THEN homeRuns::DOUBLE END AS "homeRuns", awayRuns::DOUBLE AS "awayRuns" FROM games""")
def baseball_games_read(spark, d):
    """Days given as text, and NaN for what is not known."""
    raw = games(spark, d).select(
        "gameId", F.date_format("gameDate", "yyyy-MM-dd HH:mm:ss").alias("gameDate"),
        F.when(F.col("gameId") % 9 != 0, F.col("homeRuns").cast("double")).otherwise(F.lit(float("nan"))).alias("homeRuns"),
        F.coalesce(F.col("awayRuns").cast("double"), F.lit(float("nan"))).alias("awayRuns"))
    return baseball.read_games(raw)


# sums by an uneven factor, so that no product ends in a half of the last digit shown
_SUMS = {n: f"({e}) * 0.7320508" for n, e in {
    "pace": "homeRuns + awayRuns", "rating": "homeOBP + awayOBP", "trueshooting": "homeERA + awayERA", "orbpct": "homeRuns - awayOBP",
    "efg": "homeOBP + awayERA", "paintpoints": "homeHits + awayHits", "ftr": "homeERA + awayOBP"}.items()}


@query("totals_products", f"WITH {GAMES_CTE} SELECT gameId, " + ", ".join(
    f'round(({_SUMS[a]}) * ({_SUMS[b]}) / 100, 6) AS "{n}_l5"' for n, (a, b) in TOTALS_PRODUCTS.items()) + " FROM games")
def totals_products(spark, d):
    """Every tempo product of a totals model, over sums of both sides."""
    sums = games(spark, d).select("gameId", *[F.expr(e).alias(f"{n}_sum_l5") for n, e in _SUMS.items()])
    return totals_interactions(sums, [5]).select("gameId", *[r6(f"{n}_l5") for n in TOTALS_PRODUCTS])
