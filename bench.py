"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times into a sink that drops the
rows; the median counts. The refresh is timed from the raw CSV files, which are
written beforehand, to the four mart tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from registry.adapter import AS_OF, write_raw_files
from registry.queries import QUERIES
from touchline.plans import run_refresh
from touchline.session import build_session, scratch_dir
from touchline.sources import PathStore

HEADLINE = (
    "mart_player_current_club",
    "mart_player_performance",
    "mart_player_valuation",
    "mart_team_performance",
    "latest_per_key",
    "attach_latest",
    "reconcile_latest",
    "per_unit_rates",
    "two_sided_union",
    "inner_fact_join",
    "role_playing_dim",
    "load_csv",
)
RUNS = 3


def median_seconds(action: Callable[[], object]) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "touchline-bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {name: median_seconds(lambda: run(name)) for name in HEADLINE}

    scratch = scratch_dir(spark)
    raw = write_raw_files(spark, sf_dir, f"{scratch}/raw")
    staging, marts = PathStore(f"{scratch}/staging"), PathStore(f"{scratch}/marts")
    seconds["refresh_end_to_end"] = median_seconds(
        lambda: run_refresh(spark, raw, staging, marts, AS_OF)
    )
    print(
        json.dumps(
            {
                "metric": "headline queries, median of 3 warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
