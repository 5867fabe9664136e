"""Quality metrics of a batch, and a table of the progress of streaming queries."""

from __future__ import annotations

import logging
import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from roadstream.operators.quality import DUPLICATE_EVENT, OK

log = logging.getLogger("roadstream.progress")

# dq_flag -> the metric that counts it.
FLAG_COUNTS = {
    "OK": "flag_ok",
    "CORRUPT_JSON": "flag_corrupt_json",
    "MISSING_VEHICLE": "flag_missing_vehicle",
    "MISSING_TIME": "flag_missing_time",
    "MISSING_CONGESTION": "flag_missing_congestion",
}


def dq_breakdown(checked: DataFrame) -> DataFrame:
    """Rows per structural flag."""
    return checked.groupBy("dq_flag").count()


def metric_counts() -> list[Column]:
    """The counts of ``batch_metrics`` over rows with their final reject reason.

    speed_rejects and time_rejects count every row that fails the rule, whatever its reason,
    so they overlap with each other and with the flags; quarantined_rows does not.
    """
    reason = F.col("reject_reason")
    counts = {
        "in_rows": F.count("*"),
        "out_rows": F.count_if(reason == OK),
        "quarantined_rows": F.count_if(reason != OK),
        "speed_rejects": F.count_if(F.col("speed_valid") == 0),
        "time_rejects": F.count_if(F.col("time_valid") == 0),
        "duplicate_rejects": F.count_if(reason == DUPLICATE_EVENT),
    }
    flags = {name: F.count_if(F.col("dq_flag") == flag) for flag, name in FLAG_COUNTS.items()}
    return [total.alias(name) for name, total in {**counts, **flags}.items()]


def batch_metrics(labelled: DataFrame, *more: Column) -> DataFrame:
    """One row of quality metrics of a batch, its reject rate, and ``more`` aggregates."""
    totals = labelled.agg(*metric_counts(), *more)
    rate = F.try_divide(100.0 * F.col("quarantined_rows"), F.col("in_rows"))
    return totals.withColumn("reject_rate", F.coalesce(F.round(rate, 1), F.lit(0.0)))


# One row a finished micro-batch, as the progress table holds it.
PROGRESS = (
    "query string, run_id string, batch_id long, at string, input_rows long, written_rows long, "
    "took_ms long, input_rows_per_second double, processed_rows_per_second double, "
    "sources array<struct<source:string, rows:long, from_offset:string, to_offset:string>>, "
    "phase_ms map<string, long>"
)

# Rows that the batches of each run of a query have added to tables: run -> batch -> rows. Jobs
# fill it, as Spark does not know what a batch function writes.
WRITTEN: dict[str, dict[int, int]] = {}

# The rows of those batches, likewise. Spark counts them as often as the batch function reads them.
READ: dict[str, dict[int, int]] = {}


def progress_row(progress, written: int | None, read: int | None = None) -> tuple:
    """A micro-batch as a row of PROGRESS: what it read from where and wrote, and how fast. With
    ``read``, the rows it holds, rows and rates count each once."""
    read = progress.numInputRows if read is None else read
    once = read / progress.numInputRows if progress.numInputRows else 1
    sources = [
        (s.description, round(s.numInputRows * once), str(s.startOffset), str(s.endOffset))
        for s in progress.sources
    ]
    phases = {phase: int(took) for phase, took in progress.durationMs.items()}
    return (
        progress.name,
        str(progress.runId),
        progress.batchId,
        progress.timestamp,
        read,
        written,
        phases.get("triggerExecution"),
        progress.inputRowsPerSecond * once,
        progress.processedRowsPerSecond * once,
        sources,
        phases,
    )


class ProgressTable(StreamingQueryListener):
    """Keeps a row for every micro-batch that read something, in a table of Parquet files.

    Rows are written some at a time, and whatever is left when a query ends.
    """

    def __init__(self, spark: SparkSession, path: str, rows_a_file: int = 200):
        self.spark, self.path, self.rows_a_file = spark, path, rows_a_file
        self.waiting: list = []
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.numInputRows:
            self.waiting.append(progress)
            written = WRITTEN.get(str(progress.runId), {}).get(progress.batchId)
            read = READ.get(str(progress.runId), {}).get(progress.batchId, progress.numInputRows)
            log.info(
                "%s batch=%d | in_rows=%d | written_rows=%s | rows_per_second=%.1f",
                progress.name,
                progress.batchId,
                read,
                written,
                progress.processedRowsPerSecond * read / progress.numInputRows,
            )
        if len(self.waiting) >= self.rows_a_file:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("query %s ended | %s", event.id, event.exception)
        self.flush()
        WRITTEN.pop(str(event.runId), None)
        READ.pop(str(event.runId), None)
        self.ended[str(event.runId)].set()

    def wait_until_ended(self, query, seconds: float = 60) -> bool:
        """Whether all rows of a query that has ended are in the table, waited for so long."""
        return self.ended[str(query.runId)].wait(seconds)

    def flush(self) -> None:
        waiting, self.waiting = self.waiting, []
        rows = [
            progress_row(
                p,
                WRITTEN.get(str(p.runId), {}).pop(p.batchId, None),
                READ.get(str(p.runId), {}).pop(p.batchId, None),
            )
            for p in waiting
        ]
        if rows:
            frame = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
            frame.write.mode("append").parquet(self.path)


def progress_summary(progress: DataFrame) -> DataFrame:
    """Batches, rows and rates of every query of a progress table."""
    seconds = F.sum("took_ms") / 1000
    return progress.groupBy("query").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("written_rows").alias("written_rows"),
        seconds.alias("seconds"),
        F.try_divide(F.sum("input_rows"), seconds).alias("rows_per_second"),
    )
