"""The command line, end to end, in a process of its own."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from conftest import TESTDATA

from roadstream.plans.batch import BatchPipeline
from roadstream.settings import Settings
from roadstream.sources.feed import dirty_feed
from roadstream.sources.warehouse import warehouse_tables

REPO = Path(__file__).resolve().parents[1]


def test_jobs_from_the_command_line(spark, tmp_path):
    messages = dirty_feed(spark.read.parquet(f"{TESTDATA}/events.parquet")).drop("key")
    messages.write.parquet(str(tmp_path / "raw"))
    environment = {
        **os.environ,
        "SPARK_MASTER_URL": "local[2]",
        "SHUFFLE_PARTITIONS": "2",
        "WAREHOUSE_PATH": str(tmp_path / "warehouse"),
        "RAW_PATH": str(tmp_path / "raw"),
        "PYTHONPATH": str(REPO),
    }
    command = [sys.executable, str(REPO / "run_job.py"), "bronze", "silver", "gold", "catalog"]
    done = subprocess.run(
        [*command, "--once"], env=environment, cwd=tmp_path, capture_output=True, timeout=300
    )
    assert done.returncode == 0, done.stderr.decode()[-2000:]
    tables = warehouse_tables(spark, Settings(warehouse=str(tmp_path / "warehouse")))
    assert tables["traffic_bronze"].read().count() == messages.count()
    assert tables["fact_traffic"].read().count() == BatchPipeline(messages).fact.count()
    assert b"gold batch=0" in done.stderr
