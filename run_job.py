"""Entry point for spark-submit: ``run_job.py bronze|silver|gold|catalog [--once]``."""

from __future__ import annotations

import argparse
import logging

from roadstream.session import build_session
from roadstream.settings import Settings
from roadstream.sources.catalog import register_warehouse
from roadstream.streaming.jobs import JOBS
from roadstream.streaming.metrics import ProgressTable


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("jobs", nargs="+", choices=[*JOBS, "catalog"])
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    arguments = parser.parse_args()

    logging.basicConfig(level=logging.INFO, format="{asctime} {name}: {message}", style="{")
    settings = Settings.from_env()
    spark = build_session(f"roadstream-{'-'.join(arguments.jobs)}", settings)
    progress = ProgressTable(spark, settings.table_path("stream_progress"))
    spark.streams.addListener(progress)

    started = []
    for job in arguments.jobs:
        if job == "catalog":
            register_warehouse(spark, settings)
            continue
        query = JOBS[job](spark, settings, once=arguments.once)
        if arguments.once:
            query.awaitTermination()
            progress.wait_until_ended(query)
        else:
            started.append(query)
    if started:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
