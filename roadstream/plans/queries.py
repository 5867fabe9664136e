"""Named queries: every operator and table of the pipeline over an ``events`` table.

Each takes a session and a directory of Parquet tables and returns a DataFrame. All but the
queries of merges, streams and the catalog are lazy. Those write tables of their own under the
shared folder; streams and the registered warehouse are made once for each content of the
events table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadstream.operators import duplicates, features, ingest, quality, star
from roadstream.plans import views
from roadstream.plans.batch import BatchPipeline
from roadstream.schemas import BI_CONTRACTS, BRONZE
from roadstream.session import prepare_session
from roadstream.settings import Settings
from roadstream.sources import catalog
from roadstream.sources.feed import dirty_feed, gappy_bronze
from roadstream.sources.tables import Table
from roadstream.sources.warehouse import fact_span, upsert_dim, upsert_fact, warehouse_tables
from roadstream.streaming.jobs import JOBS, run_available
from roadstream.streaming.metrics import (
    PROGRESS,
    ProgressTable,
    batch_metrics,
    dq_breakdown,
    progress_summary,
)

Query = Callable[[SparkSession, str], DataFrame]

MESSAGE = ("kafka_partition", "kafka_offset")
ROUNDS = 3


_FOLDERS: list[str] = []


def workspace(spark: SparkSession) -> str:
    """A new folder that all executors reach: under the checkpoint folder the cluster names, or
    else under the warehouse of the session."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    _FOLDERS.append(f"{shared.rstrip('/')}/roadstream/{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def discard_workspaces(spark: SparkSession) -> None:
    """Delete every folder that queries of this process made, and forget what is in them."""
    _BUILT.clear()
    while _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)  # the tables hold zone-less timestamps, read as instants in UTC
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_feed(events(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> BatchPipeline:
    """The pipeline over the feed, all lazy."""
    return BatchPipeline(feed(spark, sf_dir))


_BUILT: dict[tuple, object] = {}


def _once(kind: str, build: Callable, spark: SparkSession, sf_dir: str):
    """What ``build`` makes of the input, made once per session and content of the input, which
    one pass over the events tells, wherever and however they are stored."""
    rows = events(spark, sf_dir)
    digest = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))
    content = tuple(rows.agg(F.count("*"), digest).first())
    key = (kind, spark.sparkContext.applicationId, *content)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


# Row-level operators.


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.decode_envelope(feed(spark, sf_dir))


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).bronze


def dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_dq_flags(pipeline(spark, sf_dir).bronze).select(*MESSAGE, "dq_flag")


def type_casting(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = quality.apply_type_casting(pipeline(spark, sf_dir).bronze)
    return typed.select(*MESSAGE, "speed", "event_time", "speed_int", "event_ts")


def speed_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).checked.select(*MESSAGE, "speed_int", "speed_valid")


def time_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).checked.select(*MESSAGE, "event_ts", "time_valid")


def reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).checked.select(*MESSAGE, "reject_reason")


def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = quality.filter_clean_records(pipeline(spark, sf_dir).checked)
    return clean.select(*BRONZE.names, "speed_int", "event_ts")


def copy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = quality.filter_clean_records(pipeline(spark, sf_dir).checked)
    return duplicates.count_copies(clean).select(*MESSAGE, "vehicle_id", "event_ts", "copies")


def duplicate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = duplicates.duplicate_events(pipeline(spark, sf_dir).labelled)
    return copies.select(*MESSAGE, "vehicle_id", "event_ts", "reject_reason")


def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = pipeline(spark, sf_dir).labelled
    return labelled.select(*MESSAGE, "dq_flag", "speed_valid", "time_valid", "reject_reason")


def deduped_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).clean.select(*BRONZE.names, "speed_int", "event_ts")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).rejects


def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = features.apply_feature_engineering(pipeline(spark, sf_dir).clean)
    return featured.select(*MESSAGE, "event_ts", "speed_int", "hour", "peak_flag", "speed_band")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).silver


# Metrics.


def flag_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_breakdown(pipeline(spark, sf_dir).checked)


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_metrics(pipeline(spark, sf_dir).labelled)


# Star schema, and merges into stored tables.


def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).dim_zone


def dim_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).dim_road


def fact_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir).fact


def _overlapping_parts(facts: DataFrame) -> list[DataFrame]:
    """Two parts that together hold all facts; a third of the days is in both."""
    turn = F.dayofmonth("event_date") % 3
    return [facts.filter(turn != 2), facts.filter(turn != 0)]


def _empty_warehouse(spark: SparkSession):
    settings = Settings(warehouse=workspace(spark))
    return settings, warehouse_tables(spark, settings)


def _merge_parts(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """The fact table after two overlapping parts were merged one after the other."""
    _, tables = _empty_warehouse(spark)
    facts = facts.persist()  # both parts and their spans come from one reading of the events
    try:
        for part in _overlapping_parts(facts):
            upsert_fact(part, tables["fact_traffic"], fact_span(part))
    finally:
        facts.unpersist()
    return tables["fact_traffic"].read()


def merged_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping parts of the facts merged one after the other."""
    return _merge_parts(spark, pipeline(spark, sf_dir).fact)


def merged_dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _empty_warehouse(spark)
    for part in _overlapping_parts(pipeline(spark, sf_dir).fact):
        zones = star.dim_zone(part)
        upsert_dim(zones, tables["dim_zone"], "city_zone")
    return tables["dim_zone"].read()


def merged_dim_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _empty_warehouse(spark)
    for part in _overlapping_parts(pipeline(spark, sf_dir).fact):
        roads = star.dim_road(part)
        upsert_dim(roads, tables["dim_road"], "road_id")
    return tables["dim_road"].read()


# The same rules over rows with gaps in every column.


def gappy_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.check_rows(
        gappy_bronze(events(spark, sf_dir)), as_of=F.col("kafka_timestamp")
    )
    return duplicates.label_duplicates(checked)


def gaps_dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = quality.apply_dq_flags(gappy_bronze(events(spark, sf_dir)))
    return flagged.select(*MESSAGE, "dq_flag")


def gaps_type_casting(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = quality.apply_type_casting(gappy_bronze(events(spark, sf_dir)))
    return typed.select(*MESSAGE, "speed", "event_time", "speed_int", "event_ts")


def gaps_reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gappy_labelled(spark, sf_dir).select(*MESSAGE, "reject_reason")


def gaps_upsert_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts, some without road or zone, merged in two overlapping parts."""
    accepted = gappy_labelled(spark, sf_dir).filter(F.col("reject_reason") == quality.OK)
    facts = star.fact_traffic(features.silver_rows(accepted), F.col("kafka_timestamp"))
    return _merge_parts(spark, facts)


def gaps_reject_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = duplicates.rejected_rows(gappy_labelled(spark, sf_dir))
    stamped = duplicates.stamp_rejects(rejected, F.col("kafka_timestamp"))
    bi = views.contracts({"traffic_rejects": stamped})
    return views.view_frame("v_reject_monitoring", bi)


# BI layer.


def _bi(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bi = views.contracts(pipeline(spark, sf_dir).tables())
        return bi[name] if name in bi else views.view_frame(name, bi)

    return query


# Streams and catalog.


def _run_streams(spark: SparkSession, sf_dir: str) -> Settings:
    """Take the feed as files through the three streaming jobs, in one batch each."""
    folder = workspace(spark)
    settings = Settings(warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw")
    feed(spark, sf_dir).drop("key").write.parquet(settings.raw_path)
    run_available(spark, settings)
    return settings


def _run_streams_in_rounds(spark: SparkSession, sf_dir: str) -> Settings:
    """The same in several batches of every job: a file of messages, then all jobs, and again.
    The copies of a message lie in different files, so no batch sees two of them."""
    folder = workspace(spark)
    settings = Settings(warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw")
    copy = F.row_number().over(Window.partitionBy("offset").orderBy("value")) - 1
    numbered = feed(spark, sf_dir).drop("key").withColumn("copy", copy)
    # Every copy is a message of its own, with an offset of its own.
    messages = numbered.select(
        "value",
        "timestamp",
        "partition",
        (2 * F.col("offset") + F.col("copy")).alias("offset"),
        ((F.col("offset") + F.col("copy")) % ROUNDS).alias("turn"),
    )
    # Numbered and stored once: every round takes its part from there.
    messages.write.parquet(f"{folder}/messages")
    stored = spark.read.schema(messages.schema).parquet(f"{folder}/messages")
    for number in range(ROUNDS):
        part = stored.filter(F.col("turn") == number).drop("turn")
        part.write.mode("append").parquet(settings.raw_path)
        run_available(spark, settings)
    return settings


def _run_streams_afresh(spark: SparkSession, sf_dir: str) -> Settings:
    """Half of the messages, then all of them with new checkpoints over the filled warehouse."""
    folder = workspace(spark)
    settings = Settings(warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw")
    messages = feed(spark, sf_dir).drop("key")
    for number in range(2):
        part = messages.filter(F.col("offset") % 2 == number)
        part.write.mode("append").parquet(settings.raw_path)
        run_available(spark, replace(settings, checkpoints=f"{folder}/checkpoints-{number}"))
    return settings


@dataclass(frozen=True)
class _LosesFirstWrite(Table):
    """A table whose first append is lost to a fault."""

    lost: list = field(default_factory=list)

    def append(self, rows: DataFrame, **options) -> int:
        if not self.lost:
            self.lost.append(rows)
            raise RuntimeError("a fault that the query raises on purpose")
        return super().append(rows, **options)


def _run_streams_crashing(spark: SparkSession, sf_dir: str) -> Settings:
    """Silver and gold fail between their writes, with quarantine and dimensions written and
    silver and the fact not; then all jobs start again."""
    folder = workspace(spark)
    settings = Settings(warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw")
    feed(spark, sf_dir).drop("key").write.parquet(settings.raw_path)
    for job, name in (("bronze", None), ("silver", "traffic_silver"), ("gold", "fact_traffic")):
        tables = warehouse_tables(spark, settings)
        if name:
            tables[name] = _LosesFirstWrite(**vars(tables[name]))
            try:
                JOBS[job](spark, settings, once=True, tables=tables).awaitTermination()
            except StreamingQueryException:
                if not tables[name].lost:
                    raise
        JOBS[job](spark, settings, once=True).awaitTermination()
    return settings


def _run_streams_by_interval(spark: SparkSession, sf_dir: str) -> Settings:
    """All jobs at once with interval triggers: half of the messages, a file without any, which
    makes empty batches, and the other half."""
    folder = workspace(spark)
    settings = Settings(
        warehouse=f"{folder}/warehouse",
        raw_path=f"{folder}/raw",
        bronze_trigger="1 second",
        silver_trigger="1 second",
        gold_trigger="1 second",
    )
    messages = feed(spark, sf_dir).drop("key")
    number = F.col("offset") % 2
    messages.filter("false").write.parquet(settings.raw_path)
    running = [start(spark, settings) for start in JOBS.values()]
    try:
        for part in (messages.filter(number == 0), messages.filter("false"), messages.filter(number == 1)):
            part.write.mode("append").parquet(settings.raw_path)
            for query in running:
                query.processAllAvailable()
    finally:
        for query in running:
            query.stop()
    return settings


def _run_streams_by_day(spark: SparkSession, sf_dir: str) -> Settings:
    """Jobs that list no more days than they must, in rounds of days: the earlier ones, the later
    ones, and then messages of every fifth day, most of them finished and no longer listed."""
    folder = workspace(spark)
    settings = Settings(
        warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw", table_stream_days=1
    )
    day = F.dayofmonth("timestamp")
    turn = F.when(day % 5 == 0, 2).when(day < 15, 0).otherwise(1)
    messages = feed(spark, sf_dir).drop("key")
    for number in range(ROUNDS):
        messages.filter(turn == number).write.mode("append").parquet(settings.raw_path)
        run_available(spark, settings)
    return settings


def _run_streams_evolving(spark: SparkSession, sf_dir: str) -> Settings:
    """Half of the messages into registered tables; then the other half by jobs that keep one more
    key of the payload."""
    folder = workspace(spark)
    settings = Settings(
        warehouse=f"{folder}/warehouse",
        raw_path=f"{folder}/raw",
        database=f"roadstream_{uuid.uuid4().hex[:12]}",
    )
    catalog.register_warehouse(spark, settings, f"{folder}/database")
    messages = feed(spark, sf_dir).drop("key")
    for number, extra in enumerate((None, "road_condition")):
        settings = replace(settings, extra_payload=extra)
        part = messages.filter(F.col("offset") % 2 == number)
        part.write.mode("append").parquet(settings.raw_path)
        run_available(spark, settings)
    return settings


def _run_streams_watched(spark: SparkSession, sf_dir: str) -> Settings:
    """The feed through the jobs while a progress table listens."""
    folder = workspace(spark)
    settings = Settings(warehouse=f"{folder}/warehouse", raw_path=f"{folder}/raw")
    feed(spark, sf_dir).drop("key").write.parquet(settings.raw_path)
    progress = ProgressTable(spark, settings.table_path("stream_progress"))
    spark.streams.addListener(progress)
    try:
        run_available(spark, settings, progress)
    finally:
        spark.streams.removeListener(progress)
    return settings


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches and rows of every job, and whether its rate is known."""
    settings = _once("watched", _run_streams_watched, spark, sf_dir)
    rows = spark.read.schema(PROGRESS).parquet(settings.table_path("stream_progress"))
    timed = (F.col("rows_per_second") > 0).alias("timed")
    return progress_summary(rows).select("query", "batches", "input_rows", "written_rows", timed)


def evolved_rejects_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of the quarantine table, with the column it was given, through the catalog."""
    settings = _once(_run_streams_evolving.__name__, _run_streams_evolving, spark, sf_dir)
    return spark.table(f"{settings.database}.bi_rejects").drop("rejected_at")


def _streamed(table: str, *dropped: str, runs: Callable = _run_streams) -> Query:
    """A table as the streaming jobs write it, without the columns that hold the wall clock."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        settings = _once(runs.__name__, runs, spark, sf_dir)
        return warehouse_tables(spark, settings)[table].read().drop(*dropped)

    return query


def _register(spark: SparkSession, sf_dir: str) -> str:
    """Store the batch tables and register them under a database of their own."""
    folder = workspace(spark)
    settings = Settings(
        warehouse=f"{folder}/warehouse", database=f"roadstream_{uuid.uuid4().hex[:12]}"
    )
    tables = warehouse_tables(spark, settings)
    batch = BatchPipeline(feed(spark, sf_dir), folder=f"{folder}/batch")
    upsert_dim(batch.dim_zone, tables["dim_zone"], "city_zone")
    upsert_dim(batch.dim_road, tables["dim_road"], "road_id")
    upsert_fact(batch.fact, tables["fact_traffic"])
    tables["traffic_rejects"].append(batch.rejects)
    catalog.register_warehouse(spark, settings, f"{folder}/database")
    return settings.database


def _register_then_stream(spark: SparkSession, sf_dir: str) -> str:
    """Register an empty warehouse, then stream into it; nothing is refreshed by hand."""
    folder = workspace(spark)
    settings = Settings(
        warehouse=f"{folder}/warehouse",
        raw_path=f"{folder}/raw",
        database=f"roadstream_{uuid.uuid4().hex[:12]}",
    )
    catalog.register_warehouse(spark, settings, f"{folder}/database")
    feed(spark, sf_dir).drop("key").write.parquet(settings.raw_path)
    run_available(spark, settings)
    return settings.database


def live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _once("live", _register_then_stream, spark, sf_dir)
    return catalog.verification_counts(spark, database)


def live_zone_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_once('live', _register_then_stream, spark, sf_dir)}.v_zone_kpis")


def verification_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.verification_counts(spark, _once("catalog", _register, spark, sf_dir))


def _catalog_view(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.table(f"{_once('catalog', _register, spark, sf_dir)}.{name}")

    return query


QUERIES: dict[str, Query] = {
    "envelope_decode": envelope_decode,
    "bronze_parse": bronze_parse,
    "dq_flags": dq_flags,
    "type_casting": type_casting,
    "speed_validation": speed_validation,
    "time_validation": time_validation,
    "reject_reason": reject_reason,
    "clean_records": clean_records,
    "copy_counts": copy_counts,
    "duplicate_events": duplicate_events,
    "labelled_rows": labelled_rows,
    "deduped_clean": deduped_clean,
    "quarantine": quarantine,
    "features": feature_columns,
    "silver": silver,
    "dq_breakdown": flag_breakdown,
    "batch_metrics": quality_metrics,
    "dim_zone": dim_zone,
    "dim_road": dim_road,
    "fact_traffic": fact_traffic,
    "upsert_fact": merged_fact,
    "upsert_dim_zone": merged_dim_zone,
    "upsert_dim_road": merged_dim_road,
    **{name: _bi(name) for name in (*BI_CONTRACTS, *views.VIEWS)},
    "verification_counts": verification_counts,
    **{f"catalog_{name}": _catalog_view(name) for name in (*BI_CONTRACTS, *views.VIEWS)},
    "stream_bronze": _streamed("traffic_bronze", "corrupt"),
    "stream_silver": _streamed("traffic_silver"),
    "stream_rejects": _streamed("traffic_rejects", "rejected_at"),
    "stream_dim_zone": _streamed("dim_zone"),
    "stream_dim_road": _streamed("dim_road"),
    "stream_fact": _streamed("fact_traffic", "ingested_at"),
    **{
        f"stream_{kind}_{name}": _streamed(table, *dropped, runs=runs)
        for kind, runs in (
            ("capped", _run_streams_in_rounds),
            ("fresh", _run_streams_afresh),
            ("crashed", _run_streams_crashing),
            ("interval", _run_streams_by_interval),
            ("by_day", _run_streams_by_day),
        )
        for name, table, *dropped in (
            ("bronze", "traffic_bronze", "corrupt"),
            ("silver", "traffic_silver"),
            ("rejects", "traffic_rejects", "rejected_at"),
            ("fact", "fact_traffic", "ingested_at"),
        )
    },
    "stream_evolved_silver": _streamed("traffic_silver", runs=_run_streams_evolving),
    "stream_evolved_rejects": _streamed(
        "traffic_rejects", "rejected_at", runs=_run_streams_evolving
    ),
    "catalog_evolved_rejects": evolved_rejects_view,
    "stream_progress": stream_progress,
    "catalog_live_counts": live_counts,
    "catalog_live_zone_kpis": live_zone_kpis,
    "gaps_dq_flags": gaps_dq_flags,
    "gaps_type_casting": gaps_type_casting,
    "gaps_reject_reason": gaps_reject_reason,
    "gaps_upsert_fact": gaps_upsert_fact,
    "gaps_v_reject_monitoring": gaps_reject_monitoring,
}
