"""Wall time of the headline queries: prints one JSON line.

``queries`` and ``value`` are first runs; ``warm`` and ``warm_value`` are second runs of the same queries in the same session.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from rankloom.catalog import load
from rankloom.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "b07_state_normalization", "c08_new_teams", "e11_dedupe_prefer_id", "b11_team_id", "b10_age_extraction",
    "b09_gender_normalization", "d07_validation_report", "b12_master_migration", "c14_baseline_merge",
    "c11_renamed_teams", "c02_fallback_link", "c13_game_integrity_diff", "d26_team_record", "b29_text_redaction",
    "g02_baseline_schedule", "g03_iterative_schedule", "g04_components", "r13_ranking", "t02_scenario_sweep",
)


def run(spark, fn) -> float:
    start = time.perf_counter()
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.checkpoint.dir": os.environ.get("BENCH_STAGE_DIR") or tempfile.mkdtemp(prefix="rankloom-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().QUERIES
    spark.read.parquet(f"{SF_DIR}/nation.parquet").groupBy("n_regionkey").count().collect()  # start the JVM's workers
    times = {name: run(spark, queries[name]) for name in HEADLINE}
    warm = {name: run(spark, queries[name]) for name in HEADLINE}
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "warm_value": round(sum(warm.values()), 3), "warm": warm,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
