"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (Parquet tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs
per query; the median counts). ``queries`` holds warm times, ``cold`` the first run of each.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from dataclasses import replace

from roadstream.plans.batch import BatchPipeline
from roadstream.plans.queries import QUERIES, discard_workspaces, feed, workspace
from roadstream.plans.views import VIEWS, all_views
from roadstream.session import build_session
from roadstream.settings import Settings
from roadstream.streaming.jobs import JOBS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# From the raw events to the result in one query: feed, parse, check, count copies.
FROM_EVENTS = (
    "bronze_parse",
    "dq_flags",
    "type_casting",
    "speed_validation",
    "time_validation",
    "clean_records",
    "labelled_rows",
    "deduped_clean",
    "quarantine",
    "features",
    "batch_metrics",
    "dim_zone",
    "dim_road",
    "fact_traffic",
    "upsert_fact",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    settings = Settings(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS), log_level="ERROR")
    spark = build_session(
        "roadstream-bench", settings, spark__ui__showConsoleProgress="false"
    )

    seconds, cold = {}, {}

    def measure(name: str, build) -> None:
        def run() -> None:
            build().write.format("noop").mode("overwrite").save()

        cold[name] = round(timed(run), 3)
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)

    for name in FROM_EVENTS:
        measure(name, lambda name=name: QUERIES[name](spark, SF_DIR))

    # The tables that the views read are written and timed here, not in a warm-up.
    stored = BatchPipeline(feed(spark, SF_DIR), folder=workspace(spark))
    for name in ("checked", "silver"):
        took = timed(lambda name=name: getattr(stored, name))
        seconds[f"store_{name}"] = cold[f"store_{name}"] = round(took, 3)
    for name in VIEWS:
        measure(name, lambda name=name: all_views(stored.tables())[name])

    def stream() -> dict[str, float]:
        folder = workspace(spark)
        here = replace(settings, warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw")
        messages.write.parquet(here.raw_path)
        return {
            name: timed(lambda: start(spark, here, once=True).awaitTermination())
            for name, start in JOBS.items()
        }

    messages = feed(spark, SF_DIR).drop("key")
    rows = messages.count()
    cold.update({f"stream_{name}": round(took, 3) for name, took in stream().items()})
    stages = stream()
    seconds.update({f"stream_{name}": round(took, 3) for name, took in stages.items()})

    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "cold": cold,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "feed_rows": rows,
        "stream_rows_per_second": round(rows / sum(stages.values())),
    }
    print(json.dumps(result))
    discard_workspaces(spark)
    spark.stop()


if __name__ == "__main__":
    main()
