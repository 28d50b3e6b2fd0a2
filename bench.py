"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldhouse.session import build_session  # noqa: E402
from fieldhouse.workload import QUERIES  # noqa: E402

HEADLINE = [
    "team_rolling_diff", "team_rolling_windows", "pitcher_rolling_diff", "baseball_model_table", "hoops_model_spread",
    "hoops_model_total", "market_features", "backtest_summary", "bet_log", "threshold_sweep", "day_log", "spread_picks",
    "clean_pitches", "clean_games", "clean_player_boxscores", "upsert_rows", "upsert_rows_small_source",
    "insert_only_copy", "odds_page_table", "games_meet_odds", "baseball_team_boxscore_documents", "auc_exact",
    "roc_grid", "class_means", "column_profile", "time_split", "one_hot_columns", "scores_linear",
]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "fieldhouse-bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in names:
        times = []
        for i in range(runs + 1):
            begun = time.perf_counter()
            QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            if i:  # the first run warms up
                times.append(time.perf_counter() - begun)
        took[name] = round(statistics.median(times), 3)
        spark.catalog.clearCache()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(d.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
