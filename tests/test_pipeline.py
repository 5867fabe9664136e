"""The whole row pipeline against plain Python, on random rows with every kind of fault."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from roadstream.plans.batch import BatchPipeline
from roadstream.plans.views import all_views
from roadstream.schemas import ENVELOPE
from roadstream.settings import Settings

ARRIVAL = datetime(2026, 3, 24, 16, 50, tzinfo=timezone.utc)
SHIFTS = [-90, -21, -20, -5, 0, 0, 5, 10, 11, 60]
SPEEDS = [60, "60", 29, 30, 69, 70, 0, 160, 161, -1, "FAST", None, 60.9, "12.5"]


def random_event(rng: random.Random) -> dict:
    event = {
        "vehicle_id": rng.choice(["a", "b", "c", None]),
        "road_id": rng.choice(["R100", "R300", None]),
        "city_zone": rng.choice(["CBD", "SUBURB", "TECHPARK", None]),
        "speed": rng.choice(SPEEDS),
        "congestion_level": rng.choice([1, 5, 5, None, "3"]),
        "weather": rng.choice(["CLEAR", "RAIN"]),
        "event_time": (ARRIVAL + timedelta(minutes=rng.choice(SHIFTS))).isoformat(),
    }
    if rng.random() < 0.1:
        event["event_time"] = rng.choice([None, "soon", ""])
    return event


def whole_number(speed):
    if speed is None or speed == "FAST":
        return None
    return int(float(speed))


def row_reason(event: dict) -> str:
    if event["vehicle_id"] is None:
        return "MISSING_VEHICLE"
    if event["event_time"] is None:
        return "MISSING_TIME"
    if not isinstance(event["congestion_level"], int):
        return "MISSING_CONGESTION"
    speed = whole_number(event["speed"])
    if speed is None or not 0 <= speed <= 160:
        return "INVALID_SPEED"
    try:
        late = (datetime.fromisoformat(event["event_time"]) - ARRIVAL).total_seconds() / 60
    except ValueError:
        return "INVALID_TIME"
    return "OK" if -20 <= late <= 10 else "INVALID_TIME"


def expected(payloads: list[dict | None]) -> list[str]:
    reasons = ["CORRUPT_JSON" if event is None else row_reason(event) for event in payloads]
    keys = Counter(
        (event["vehicle_id"], event["event_time"])
        for event, reason in zip(payloads, reasons)
        if reason == "OK"
    )
    return [
        "DUPLICATE_EVENT"
        if reason == "OK" and keys[(event["vehicle_id"], event["event_time"])] > 1
        else reason
        for event, reason in zip(payloads, reasons)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_reasons_equal_plain_python(spark, seed):
    rng = random.Random(seed)
    payloads = [random_event(rng) if rng.random() < 0.9 else None for _ in range(60)]
    payloads += [
        {
            **random_event(rng),
            "vehicle_id": f"v{i}",
            "speed": 50,
            "congestion_level": 2,
            "event_time": (ARRIVAL + timedelta(minutes=i % 10)).isoformat(),
        }
        for i in range(20)
    ]
    corrupt = '{"raw":"###CORRUPTED_EVENT###","corrupted":true}'
    texts = [corrupt if event is None else json.dumps(event) for event in payloads]
    messages = spark.createDataFrame(
        [(text.encode(), ARRIVAL, 0, number) for number, text in enumerate(texts)], ENVELOPE
    )
    pipeline = BatchPipeline(messages)
    reasons = expected(payloads)
    numbered = sorted(((n, reason) for n, reason in enumerate(reasons)), key=repr)
    assert rows_of(pipeline.labelled, "kafka_offset", "reject_reason") == numbered
    rejected = [pair for pair in numbered if pair[1] != "OK"]
    assert rows_of(pipeline.rejects, "kafka_offset", "reject_reason") == rejected
    kept = [(n,) for n, reason in enumerate(reasons) if reason == "OK"]
    assert rows_of(pipeline.silver, "kafka_offset") == sorted(kept, key=repr)
    facts = rows_of(pipeline.fact, "vehicle_id", "road_id", "city_zone", "speed")
    assert facts == sorted(
        (
            (e["vehicle_id"], e["road_id"], e["city_zone"], whole_number(e["speed"]))
            for e, reason in zip(payloads, reasons)
            if reason == "OK"
        ),
        key=repr,
    )
    summary = all_views(pipeline.tables())["v_live_summary"].first()
    assert summary["total_events"] == len(kept)


def test_one_instant_for_all_tables_of_the_wall_clock(spark):
    now = datetime.now(timezone.utc).isoformat()
    event = {"vehicle_id": "v", "congestion_level": 1, "speed": 5, "event_time": now}
    messages = spark.createDataFrame([(json.dumps(event).encode(), ARRIVAL, 0, 0)], ENVELOPE)
    pipeline = BatchPipeline(messages, Settings(clock="now"))
    assert pipeline.silver.count() == 1 and pipeline.rejects.count() == 0
    assert BatchPipeline(messages).rejects.first()["reject_reason"] == "INVALID_TIME"
    stamped = pipeline.fact.select(F.col("ingested_at") >= F.lit(now).cast("timestamp"))
    assert stamped.first()[0]


def test_stored_tables_equal_lazy_ones(spark, tmp_path):
    rng = random.Random(9)
    texts = [json.dumps(random_event(rng)) for _ in range(200)]
    messages = spark.createDataFrame(
        [(text.encode(), ARRIVAL, 0, number) for number, text in enumerate(texts)], ENVELOPE
    )
    lazy, stored = BatchPipeline(messages), BatchPipeline(messages, folder=str(tmp_path / "f"))
    for name, table in lazy.tables().items():
        assert rows_of(stored.tables()[name]) == rows_of(table), name
    assert (tmp_path / "f" / "checked").exists() and (tmp_path / "f" / "silver").exists()
