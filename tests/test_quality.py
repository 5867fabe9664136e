from __future__ import annotations

import itertools
from datetime import datetime, timezone

import pytest
from conftest import NOW, at, event
from pyspark.sql import functions as F

from roadstream.functions import lenient_int, lenient_timestamp
from roadstream.operators.features import apply_feature_engineering
from roadstream.operators.quality import (
    apply_business_validation,
    apply_dq_flags,
    apply_type_casting,
    check_rows,
    filter_clean_records,
)
from roadstream.settings import Settings

MARKER = '{"raw":"###CORRUPTED_EVENT###","corrupted":true}'

FLAGS = [
    ({}, "OK"),
    ({"raw_json": MARKER}, "CORRUPT_JSON"),
    ({"vehicle_id": None}, "MISSING_VEHICLE"),
    ({"event_time": None}, "MISSING_TIME"),
    ({"congestion_level": None}, "MISSING_CONGESTION"),
    ({"raw_json": MARKER, "vehicle_id": None}, "CORRUPT_JSON"),
    ({"vehicle_id": None, "event_time": None}, "MISSING_VEHICLE"),
    ({"event_time": None, "congestion_level": None}, "MISSING_TIME"),
    ({"raw_json": None}, "OK"),
    ({"raw_json": None, "vehicle_id": None}, "MISSING_VEHICLE"),
    ({"raw_json": '{"note":"corrupted"}'}, "OK"),
    ({"road_id": None, "city_zone": None}, "OK"),
]


def test_dq_flags(bronze):
    rows = [event(kafka_offset=i, **change) for i, (change, _) in enumerate(FLAGS)]
    flagged = apply_dq_flags(bronze(*rows)).orderBy("kafka_offset").collect()
    assert [row["dq_flag"] for row in flagged] == [flag for _, flag in FLAGS]


INTEGERS = {
    "60": 60,
    " 60 ": 60,
    "+7": 7,
    "-40": -40,
    "60.5": 60,
    "60.": 60,
    "-0.9": 0,
    ".5": 0,
    "-1.9": -1,
    "FAST": None,
    "": None,
    "1e2": None,
    "12a": None,
    "6 0": None,
    "1.2.3": None,
    "99999999999": None,
    "99999999999.5": None,
    "2147483647": 2147483647,
    "2147483648": None,
    None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_int(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = spark.createDataFrame([(text,) for text in INTEGERS], "text string")
        result = texts.select("text", lenient_int(F.col("text")).alias("value")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert {row["text"]: row["value"] for row in result} == INTEGERS


def test_lenient_int_equals_the_non_ansi_cast(spark):
    """Short strings over the characters that matter, against Spark's own lenient cast."""
    letters = ["", " ", "\t", "\x01", "+", "-", ".", "0", "7", "42", "e", "2147483648"]
    texts = [("".join(parts),) for parts in itertools.product(letters, repeat=4)]
    frame = spark.createDataFrame(texts, "text string").distinct()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        pair = frame.select(
            "text",
            lenient_int(F.col("text")).alias("ours"),
            F.col("text").cast("int").alias("legacy"),
        )
        different = pair.filter(~F.col("ours").eqNullSafe(F.col("legacy"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert different == []


def test_lenient_timestamp(spark):
    texts = {
        "2026-03-24T10:00:00+00:00": True,
        "2026-03-24T10:00:00.123456+00:00": True,
        "2026-03-24T12:00:00+02:00": True,
        "2026-03-24 10:00:00": True,
        "not a time": False,
        "2026-13-01T00:00:00": False,
        "": False,
    }
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    parsed = frame.select("text", lenient_timestamp(F.col("text")).alias("value"))
    assert {r["text"]: r["value"] is not None for r in parsed.collect()} == texts
    instants = parsed.filter(F.col("text").startswith("2026-03-24T1")).filter(
        F.col("value") == F.lit("2026-03-24T10:00:00Z").cast("timestamp")
    )
    assert instants.count() == 2


SPEEDS = [
    ("80", 1),
    ("0", 1),
    ("160", 1),
    ("161", 0),
    ("-1", 0),
    ("-40", 0),
    ("420", 0),
    ("60.5", 1),
    ("160.9", 1),
    ("FAST", 0),
    (None, 0),
]


def test_speed_validation(bronze):
    rows = [event(kafka_offset=i, speed=speed) for i, (speed, _) in enumerate(SPEEDS)]
    checked = check_rows(bronze(*rows)).orderBy("kafka_offset").collect()
    assert [row["speed_valid"] for row in checked] == [valid for _, valid in SPEEDS]


TIMES = [(0, 1), (-5, 1), (-20, 1), (-20.01, 0), (-90, 0), (10, 1), (10.01, 0), (60, 0)]


def test_time_validation_against_arrival(bronze):
    rows = [event(kafka_offset=i, event_time=at(m)) for i, (m, _) in enumerate(TIMES)]
    rows.append(event(kafka_offset=len(TIMES), event_time="soon"))
    checked = check_rows(bronze(*rows), as_of=F.col("kafka_timestamp"))
    valid = [row["time_valid"] for row in checked.orderBy("kafka_offset").collect()]
    assert valid == [v for _, v in TIMES] + [0]


def test_time_validation_against_the_wall_clock_is_the_default(bronze):
    now = datetime.now(timezone.utc).isoformat()
    checked = check_rows(bronze(event(event_time=now), event(kafka_offset=1, event_time=at(-9e5))))
    assert [r["time_valid"] for r in checked.orderBy("kafka_offset").collect()] == [1, 0]


def test_thresholds_come_from_settings(bronze):
    settings = Settings(speed_min=10, speed_max=20, late_minutes=1, future_minutes=1)
    df = bronze(event(speed="9"), event(speed="10"), event(speed="20"), event(speed="21"))
    typed = apply_type_casting(apply_dq_flags(df))
    checked = apply_business_validation(typed, settings, F.lit(NOW))
    assert sorted(r["speed_valid"] for r in checked.collect()) == [0, 0, 1, 1]
    late = apply_type_casting(bronze(event(event_time=at(-2))))
    assert apply_business_validation(late, settings, F.lit(NOW)).first()["time_valid"] == 0


REASONS = [
    ({}, "OK"),
    ({"raw_json": MARKER, "speed": "FAST"}, "CORRUPT_JSON"),
    ({"congestion_level": None, "speed": "FAST"}, "MISSING_CONGESTION"),
    ({"speed": "FAST", "event_time": at(-90)}, "INVALID_SPEED"),
    ({"event_time": at(-90)}, "INVALID_TIME"),
    ({"event_time": "soon"}, "INVALID_TIME"),
]


def test_reject_reason_priority_and_clean_filter(bronze):
    rows = [event(kafka_offset=i, **change) for i, (change, _) in enumerate(REASONS)]
    checked = check_rows(bronze(*rows), as_of=F.col("kafka_timestamp"))
    reasons = [r["reject_reason"] for r in checked.orderBy("kafka_offset").collect()]
    assert reasons == [reason for _, reason in REASONS]
    assert [r["kafka_offset"] for r in filter_clean_records(checked).collect()] == [0]


BANDS = {0: "LOW", 20: "LOW", 29: "LOW", 30: "MEDIUM", 50: "MEDIUM", 69: "MEDIUM", 70: "HIGH"}


def test_speed_bands(bronze):
    rows = [event(kafka_offset=speed, speed=str(speed)) for speed in BANDS]
    featured = apply_feature_engineering(apply_type_casting(bronze(*rows)))
    assert {r["speed_int"]: r["speed_band"] for r in featured.collect()} == BANDS
    without = apply_feature_engineering(apply_type_casting(bronze(event(speed=None))))
    assert without.first()["speed_band"] == "HIGH"


def test_hour_and_peak_flag(bronze):
    rows = [event(event_time=f"2026-03-24T{hour:02d}:59:59+00:00") for hour in range(24)]
    featured = apply_feature_engineering(apply_type_casting(bronze(*rows)))
    peaks = {r["hour"]: r["peak_flag"] for r in featured.collect()}
    rush = {8, 9, 10, 11, 17, 18, 19, 20}
    assert peaks == {hour: int(hour in rush) for hour in range(24)}
