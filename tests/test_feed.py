from __future__ import annotations

import json
from collections import Counter

import pytest
from conftest import TESTDATA, rows_of
from pyspark.sql import functions as F

from roadstream.operators.duplicates import label_duplicates
from roadstream.operators.quality import (
    DUPLICATE_EVENT,
    INVALID_SPEED,
    INVALID_TIME,
    OK,
    check_rows,
)
from roadstream.plans.batch import BatchPipeline
from roadstream.schemas import PAYLOAD
from roadstream.sources import feed
from roadstream.streaming.metrics import FLAG_COUNTS


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{TESTDATA}/events.parquet")


def messages(frame):
    return [
        (row["offset"], row["key"] and bytes(row["key"]).decode(), json.loads(bytes(row["value"])))
        for row in frame.collect()
    ]


def test_clean_messages_have_the_event_shape(events):
    for offset, key, payload in messages(feed.dirty_feed(events, F.lit(None).cast("string"))):
        assert list(payload) == PAYLOAD.names
        assert key == payload["city_zone"] and isinstance(payload["speed"], int)
        assert payload["road_id"] == f"R{(offset % 4 + 1) * 100}"


@pytest.mark.parametrize("fault", feed.FAULTS)
def test_each_fault(events, fault):
    clean = {o: p for o, _, p in messages(feed.dirty_feed(events, F.lit(None).cast("string")))}
    dirty = messages(feed.dirty_feed(events, F.lit(fault)))
    copies = Counter(offset for offset, _, _ in dirty)
    assert set(copies) == set(clean)
    assert set(copies.values()) == ({2} if fault == "duplicate_event" else {1})
    for offset, key, payload in dirty:
        if fault == "corrupt_json":
            assert key is None and payload == {"raw": "###CORRUPTED_EVENT###", "corrupted": True}
            continue
        changed = {k for k in payload if payload[k] != clean[offset].get(k)}
        speed = payload["speed"]
        if fault == "null_speed":
            assert speed is None
        elif fault == "negative_speed":
            assert -60 <= speed <= -10
        elif fault == "extreme_speed":
            assert 250 <= speed <= 600
        elif fault == "wrong_datatype":
            assert speed in feed.WORD_SPEEDS
        elif fault == "schema_drift":
            assert changed == {"road_condition"}
            assert payload["road_condition"] in feed.ROAD_CONDITIONS
        elif fault in ("late_event", "future_event"):
            assert changed == {"event_time"}
        else:
            assert not changed


def test_silver_outcome_of_each_fault(events):
    for fault, reasons in {
        "null_speed": {"INVALID_SPEED"},
        "negative_speed": {"INVALID_SPEED"},
        "extreme_speed": {"INVALID_SPEED"},
        "wrong_datatype": {"INVALID_SPEED"},
        "duplicate_event": {"DUPLICATE_EVENT", "INVALID_SPEED"},
        "late_event": {"INVALID_TIME", "INVALID_SPEED", "OK"},
        "future_event": {"INVALID_TIME", "INVALID_SPEED", "OK"},
        "schema_drift": {"INVALID_SPEED", "OK"},
        "corrupt_json": {"CORRUPT_JSON"},
    }.items():
        labelled = BatchPipeline(feed.dirty_feed(events, F.lit(fault))).labelled
        found = {row[0] for row in rows_of(labelled.select("reject_reason").distinct())}
        assert found == reasons, fault


def test_rows_with_gaps_reach_every_reason(events):
    checked = check_rows(feed.gappy_bronze(events), as_of=F.col("kafka_timestamp"))
    labelled = label_duplicates(checked)
    reasons = {row[0] for row in rows_of(labelled.select("reject_reason").distinct())}
    assert reasons == {
        OK,
        INVALID_SPEED,
        INVALID_TIME,
        DUPLICATE_EVENT,
        *(flag for flag in FLAG_COUNTS if flag != OK),
    }
    accepted = labelled.filter(F.col("reject_reason") == OK)
    assert not accepted.filter("road_id IS NULL").isEmpty()
    assert not accepted.filter("city_zone IS NULL").isEmpty()
