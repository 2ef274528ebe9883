"""Times the headline queries and prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Every query is planned and run to its last row (noop sink); each gets one
untimed run first, so that the figures do not hold class loading and
compilation.
"""

from __future__ import annotations

import json
import os
import time

from courtline.fixtures.queries import QUERIES
from courtline.session import build_session

HEADLINE = [
    "best_provider", "latest_snapshot", "power_rating", "top_teams", "ponderations", "value_games",
    "opportunity_summary", "days_rest", "rest_splits", "rest_splits_pivot", "team_stats_wide",
    "json_header_rowset", "ref_dereference", "event_disposition", "next_game_day", "bet_sheet",
    "value_overview", "guide_cards", "ranked_value_bets", "edge_histogram", "prediction_error",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    spark = build_session("courtline-bench", master=f"local[{cpus}]", conf={
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
