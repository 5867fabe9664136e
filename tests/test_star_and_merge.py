from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from roadstream import schemas
from roadstream.operators import merge, star
from roadstream.session import prepare_session
from roadstream.settings import Settings
from roadstream.sources import tables as stored_tables
from roadstream.sources.tables import SORTED_SIZE, TASK_SIZE, Table
from roadstream.sources.warehouse import (
    MergeResult,
    message_span,
    unstored,
    upsert_dim,
    upsert_fact,
    warehouse_tables,
)

SILVER = (
    "vehicle_id string, road_id string, city_zone string, speed_int int, congestion_level int, "
    "event_ts timestamp, peak_flag int, speed_band string, hour int, weather string"
)


def silver_row(vehicle="v", road="R100", zone="CBD", speed=50, day=1, hour=9):
    when = datetime(2026, 3, day, hour)
    return (vehicle, road, zone, speed, 3, when, 1, "MEDIUM", hour, "CLEAR")


@pytest.fixture
def silver(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SILVER)


@pytest.fixture
def tables(spark, tmp_path):
    return warehouse_tables(spark, Settings(warehouse=str(tmp_path / "warehouse")))


def facts(frame):
    return star.fact_traffic(frame, F.lit(datetime(2026, 4, 1)))


def test_dimension_attributes(silver):
    zones = ["CBD", "TECHPARK", "AIRPORT", "TRAINSTATION", "SUBURB", "cbd", None]
    rows = silver(*[silver_row(zone=zone) for zone in zones + zones])
    assert rows_of(star.dim_zone(rows)) == sorted(
        [
            ("CBD", "Commercial", "HIGH"),
            ("TECHPARK", "IT Hub", "MEDIUM"),
            ("AIRPORT", "Transit Hub", "HIGH"),
            ("TRAINSTATION", "Transit Hub", "HIGH"),
            ("SUBURB", "Residential", "LOW"),
            ("cbd", "Residential", "LOW"),
            (None, "Residential", "LOW"),
        ],
        key=repr,
    )
    roads = silver(*[silver_row(road=road) for road in ["R100", "R200", "R300", "R9", None]])
    assert rows_of(star.dim_road(roads)) == sorted(
        [
            ("R100", "Highway", 100),
            ("R200", "Highway", 100),
            ("R300", "City Road", 60),
            ("R9", "City Road", 60),
            (None, "City Road", 60),
        ],
        key=repr,
    )


def test_fact_shape(silver):
    fact = facts(silver(silver_row(speed=42, day=5)))
    assert [(f.name, f.dataType) for f in fact.schema] == [
        (f.name, f.dataType) for f in schemas.FACT
    ]
    row = fact.first()
    assert (row["speed"], row["event_date"]) == (42, date(2026, 3, 5))


def test_upsert_dim_inserts_only_new_keys_and_keeps_old_attributes(spark, tables):
    def dim(*rows):
        return spark.createDataFrame(list(rows), schemas.DIM_ZONE)

    table = tables["dim_zone"]
    assert not table.exists() and table.read().count() == 0
    first = dim(("CBD", "Commercial", "HIGH"), (None, "Residential", "LOW"))
    assert upsert_dim(first, table, "city_zone") == MergeResult(2, 2)
    assert upsert_dim(first, table, "city_zone") == MergeResult(2, 0)
    second = dim(("CBD", "changed", "changed"), ("SUBURB", "Residential", "LOW"))
    assert upsert_dim(second, table, "city_zone") == MergeResult(2, 1)
    assert rows_of(table.read(), "city_zone", "zone_type") == sorted(
        [("CBD", "Commercial"), (None, "Residential"), ("SUBURB", "Residential")], key=repr
    )
    assert upsert_dim(dim(), table, "city_zone") == MergeResult(0, 0)


def test_upsert_fact_twice_equals_once_even_for_null_keys(silver, tables):
    table = tables["fact_traffic"]
    batch = facts(
        silver(
            silver_row(),
            silver_row(road=None),
            silver_row(zone=None),
            silver_row(road=None, zone=None),
            silver_row(day=2),
            silver_row(hour=10),
        )
    )
    assert upsert_fact(batch, table) == MergeResult(6, 6)
    assert upsert_fact(batch, table) == MergeResult(6, 0)
    assert rows_of(table.read()) == rows_of(batch)


def test_upsert_fact_keys(silver, tables):
    table = tables["fact_traffic"]
    upsert_fact(facts(silver(silver_row(speed=50))), table)
    other = silver(
        silver_row(speed=99),  # same key, other value: not inserted
        silver_row(vehicle="w"),
        silver_row(road="R300"),
        silver_row(zone="SUBURB"),
        silver_row(hour=10),
        silver_row(day=9),
    )
    assert upsert_fact(facts(other), table) == MergeResult(6, 5)
    assert 99 not in [row["speed"] for row in table.read().collect()]


@pytest.mark.parametrize("broadcast_limit", ["10m", "-1"])
def test_one_batch_with_the_same_key_twice_inserts_it_once(spark, silver, tables, broadcast_limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        batch = facts(silver(silver_row(speed=60), silver_row(speed=50), silver_row(day=2)))
        assert upsert_fact(batch, tables["fact_traffic"]) == MergeResult(3, 2)
        assert upsert_fact(batch, tables["fact_traffic"]) == MergeResult(3, 0)
        # which of the two is kept does not depend on their order
        assert sorted(r["speed"] for r in tables["fact_traffic"].read().collect()) == [50, 50]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")


def test_upsert_fact_of_nothing(silver, tables):
    batch = facts(silver(silver_row()).filter("false"))
    assert upsert_fact(batch, tables["fact_traffic"]) == MergeResult(0, 0)
    assert not tables["fact_traffic"].exists()


def test_read_days_reads_only_those_directories(silver, tables):
    table = tables["fact_traffic"]
    upsert_fact(facts(silver(*[silver_row(day=day) for day in range(1, 8)])), table)
    some = table.read_days([date(2026, 3, 2), date(2026, 3, 5), date(2030, 1, 1)])
    assert sorted(row["event_date"].day for row in some.collect()) == [2, 5]
    assert len(some.inputFiles()) == 2
    assert table.read_days([date(2030, 1, 1)]).count() == 0


def test_stored_facts_can_be_skipped_by_time(spark, silver, tables):
    """Files are sorted by event time and carry its range; the merge filter reaches the scan."""
    table = tables["fact_traffic"]
    rows = [silver_row(vehicle=f"v{i}", hour=(7 * i) % 24, day=1 + i % 2) for i in range(48)]
    batch = facts(silver(*rows).repartition(4))
    upsert_fact(batch, table)
    files = [path.removeprefix("file://") for path in table.read().inputFiles()]
    assert len(files) == 2
    for path in files:
        times = pq.read_table(path, columns=["event_ts"]).column(0).to_pylist()
        assert times == sorted(times)
        group = pq.ParquetFile(path).metadata.row_group(0)
        (column,) = [
            group.column(i)
            for i in range(group.num_columns)
            if group.column(i).path_in_schema == "event_ts"
        ]
        assert column.statistics.has_min_max
    span = F.col("event_ts").between(datetime(2026, 3, 1, 5), datetime(2026, 3, 1, 7))
    narrowed = table.read_days([date(2026, 3, 1)]).filter(span)
    plan = narrowed._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(event_ts" in pushed and "LessThanOrEqual(event_ts" in pushed


def test_merge_sorts_no_incoming_row_but_for_the_join(spark, silver, tables):
    """Rows the target holds leave first; only rows of repeated keys are ever compared."""
    upsert_fact(facts(silver(silver_row())), tables["fact_traffic"])
    incoming = facts(silver(silver_row(), silver_row(day=2)))
    new = merge.rows_to_insert(incoming, tables["fact_traffic"].read(), schemas.FACT_KEY)
    assert new.count() == 1
    new.collect()
    plan = new._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortAggregate" not in plan  # no key repeats, so that branch is gone at run time


def messages_of(spark, *offsets, day=1):
    moment = datetime(2026, 3, day, 12, 0)
    rows = [("{}", moment, 0, offset, f"v{offset}", *[None] * 6) for offset in offsets]
    return spark.createDataFrame(rows, schemas.BRONZE)


def test_messages_are_stored_once_by_day(spark, tables):
    table = tables["traffic_bronze"]

    def store(messages):
        table.append(unstored(messages, message_span(messages), table))

    store(messages_of(spark, 1, 2, 3))
    store(messages_of(spark, 2, 3, 4))
    store(messages_of(spark, 1, 9, day=2))  # the same offset on another day: another message
    store(messages_of(spark, 1, 2, 3))
    found = rows_of(table.read(), "kafka_offset")
    assert found == [(1,), (1,), (2,), (3,), (4,), (9,)]
    folders = sorted(path.name for path in Path(table.path).glob("arrival_date=*"))
    assert folders == ["arrival_date=2026-03-01", "arrival_date=2026-03-02"]


def test_messages_without_a_place_are_stored_once_too(spark, tables):
    table = tables["traffic_bronze"]
    odd = spark.createDataFrame([("{}", None, 0, None, *[None] * 7)], schemas.BRONZE)
    for _ in range(2):
        table.append(unstored(odd, message_span(odd), table))
    assert table.read().count() == 1


def message_rows(spark, offsets, vehicle="v"):
    when = datetime(2026, 3, 4, 12)
    rows = [("{}", when, 0, offset, vehicle) for offset in offsets]
    names = "raw_json string, kafka_timestamp timestamp, kafka_partition int, kafka_offset long, vehicle_id string"
    rows = spark.createDataFrame(rows, names)
    missing = [c for c in schemas.STORED_BRONZE if c.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(c.dataType).alias(c.name) for c in missing])


def test_new_messages_are_not_dealt_out_for_a_comparison(spark, tables):
    """Into an empty table, and beside messages of the same day and span of offsets."""
    bronze = tables["traffic_bronze"]
    for offsets in (range(0, 20, 2), range(1, 20, 2)):
        batch = message_rows(spark, offsets)
        assert unstored(batch, message_span(batch), bronze) is batch
        bronze.append(batch.select(*bronze.schema.names))
    assert bronze.read().count() == 20


def test_messages_held_by_either_table_are_left_out(spark, tables):
    silver, rejects = tables["traffic_silver"], tables["traffic_rejects"]
    for table, offsets in ((silver, (1, 4)), (rejects, (2,))):
        held = message_rows(spark, offsets)
        missing = [c for c in table.schema if c.name not in held.columns]
        table.append(held.select("*", *[F.lit(None).cast(c.dataType).alias(c.name) for c in missing]).select(*table.schema.names))
    batch = message_rows(spark, [1, 2, 3, 4, 5, 5])
    new = unstored(batch, message_span(batch), silver, rejects)
    assert rows_of(new, "kafka_offset") == [(3,), (5,), (5,)]
    assert new.columns == batch.columns


def test_facts_of_different_keys_are_not_compared(silver, tables, monkeypatch):
    monkeypatch.setattr(stored_tables, "one_per_key", None)
    table = tables["fact_traffic"]
    assert upsert_fact(facts(silver(silver_row(day=1), silver_row(road=None))), table).inserted == 2
    batch = facts(silver(silver_row(day=1), silver_row(road=None), silver_row(day=2)))
    assert upsert_fact(batch, table) == MergeResult(3, 1)


def test_writes_sort_in_small_tasks(spark, silver, tables, monkeypatch):
    seen, write = [], Table._append

    def watched(self, rows, **options):
        seen.append(rows.sparkSession.conf.get(TASK_SIZE))
        write(self, rows, **options)

    monkeypatch.setattr(Table, "_append", watched)
    given = spark.conf.get(TASK_SIZE)
    batch = facts(silver(silver_row()))
    try:
        for size in ("64m", "8m"):
            spark.conf.set(TASK_SIZE, size)
            tables["fact_traffic"].append(batch)
            assert spark.conf.get(TASK_SIZE) == size
    finally:
        spark.conf.set(TASK_SIZE, given)
    assert seen == [SORTED_SIZE, "8m"]


def test_sessions_made_elsewhere_join_full_rows_without_a_sort(spark):
    session = spark.newSession()
    limit = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    session.conf.unset(limit)
    prepare_session(session)
    assert session.conf.get(limit) == "64m"
