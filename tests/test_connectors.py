"""Calls made to connectors that are not installed here, against stand-ins that record them."""

from __future__ import annotations

import sys
from datetime import datetime
from types import ModuleType

import pytest
from conftest import rows_of

from roadstream import schemas
from roadstream.settings import Settings
from roadstream.sources.streams import raw_stream
from roadstream.sources.tables import Table
from roadstream.sources.warehouse import micros, upsert_fact


class Recorder:
    """Remembers calls; every method returns the recorder."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call

    def arguments(self, name):
        return [(args, kwargs) for called, args, kwargs in self.calls if called == name]


def test_kafka_options():
    spark = Recorder()
    spark.readStream = spark
    raw_stream(spark, Settings(kafka_servers="k:1", kafka_topic="t", kafka_min_partitions=64))
    assert spark.arguments("format") == [(("kafka",), {})]
    ((_, options),) = spark.arguments("options")
    assert options == {
        "kafka.bootstrap.servers": "k:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "minPartitions": 64,
    }
    raw_stream(spark, Settings(max_offsets_per_trigger=9, fail_on_data_loss="false"))
    options = spark.arguments("options")[-1][1]
    assert (options["maxOffsetsPerTrigger"], options["failOnDataLoss"]) == (9, "false")
    assert not any("group" in option for option in options)


@pytest.fixture
def delta(monkeypatch):
    table = Recorder()
    table.first = lambda: {"num_inserted_rows": 2}
    module = ModuleType("delta.tables")
    module.DeltaTable = table
    monkeypatch.setitem(sys.modules, "delta", ModuleType("delta"))
    monkeypatch.setitem(sys.modules, "delta.tables", module)
    return table


def test_delta_merge_is_insert_only_and_null_safe(spark, delta, tmp_path):
    table = Table(spark, str(tmp_path / "dim"), schemas.DIM_ROAD, "delta")
    rows = [("R1", "a", 1), ("R1", "b", 1), (None, "c", 2)]
    incoming = spark.createDataFrame(rows, schemas.DIM_ROAD)
    assert table.insert_new(incoming, ["road_id"]) == 2
    (((source, match), _),) = delta.arguments("merge")
    assert match == "held.road_id <=> new.road_id"
    assert rows_of(source) == [("R1", "a", 1), (None, "c", 2)]
    names = [name for name, _, _ in delta.calls]
    assert "whenNotMatchedInsertAll" in names and "whenMatchedUpdateAll" not in names


def test_delta_merge_of_facts_reads_their_days_and_times_only(spark, delta, tmp_path):
    table = Table(spark, str(tmp_path / "fact"), schemas.FACT, "delta", ("event_date",))
    moment = datetime(2026, 3, 24, 10, 0, 0, 250_000)
    row = ["v", "R1", "CBD", 50, 1, moment, 0, "LOW", 10, "FOG", moment.date(), moment]
    facts = spark.createDataFrame([tuple(row)], schemas.FACT)
    span = {"rows": 1, "timeless": 0, "first": moment, "last": moment, "days": [moment.date()]}
    upsert_fact(facts, table, span)
    (((_, match), _),) = delta.arguments("merge")
    number = micros(moment)
    assert number % 1_000_000 == 250_000
    assert match.endswith(
        "held.event_date IN (DATE'2026-03-24') AND held.event_ts BETWEEN "
        f"timestamp_micros({number}) AND timestamp_micros({number})"
    )


def test_formats_without_connector_are_reported(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), schemas.DIM_ROAD, "delta")
    with pytest.raises(Exception, match="(?i)delta"):
        table._append(spark.createDataFrame([], schemas.DIM_ROAD))
