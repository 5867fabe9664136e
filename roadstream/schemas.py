"""Declared schemas. Nothing in the pipeline infers a type."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(**columns: str) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# Column names and types of every table.
ENVELOPE = _struct(value="binary", timestamp="timestamp", partition="integer", offset="long")

# speed and event_time stay text so that a bad value reaches the quality rules intact.
PAYLOAD = _struct(
    vehicle_id="string",
    road_id="string",
    city_zone="string",
    speed="string",
    congestion_level="integer",
    weather="string",
    event_time="string",
)
_ARRIVAL = _struct(
    raw_json="string", kafka_timestamp="timestamp", kafka_partition="integer", kafka_offset="long"
)
_VERDICT = _struct(
    dq_flag="string",
    speed_int="integer",
    event_ts="timestamp",
    speed_valid="integer",
    time_valid="integer",
)
_FEATURES = _struct(hour="integer", peak_flag="integer", speed_band="string")
_REJECTION = _struct(reject_reason="string", rejected_at="timestamp")

BRONZE = StructType(_ARRIVAL.fields + PAYLOAD.fields)
# The table also holds whether the raw text is corrupt, so that nobody has to read it to know.
STORED_BRONZE = StructType(BRONZE.fields + _struct(corrupt="boolean").fields)
SILVER = StructType(BRONZE.fields + _VERDICT.fields + _FEATURES.fields)
REJECTS = StructType(BRONZE.fields + _VERDICT.fields + _REJECTION.fields)

DIM_ZONE = _struct(city_zone="string", zone_type="string", traffic_risk="string")
DIM_ROAD = _struct(road_id="string", road_type="string", speed_limit="integer")
FACT = _struct(
    vehicle_id="string",
    road_id="string",
    city_zone="string",
    speed="integer",
    congestion_level="integer",
    event_ts="timestamp",
    peak_flag="integer",
    speed_band="string",
    hour="integer",
    weather="string",
    event_date="date",
    ingested_at="timestamp",
)

# Keys.
MESSAGE_KEY = ("kafka_partition", "kafka_offset", "kafka_timestamp")
DUPLICATE_KEY = ("vehicle_id", "event_ts")
FACT_KEY = ("vehicle_id", "road_id", "city_zone", "event_ts")

# BI contracts: view -> (table, ((table column, view column, type), ...)).
BI_CONTRACTS = {
    "bi_fact_traffic": (
        "fact_traffic",
        (
            ("vehicle_id", "vehicle_id", "string"),
            ("road_id", "road_id", "string"),
            ("city_zone", "city_zone", "string"),
            ("speed", "speed", "double"),
            ("congestion_level", "congestion_level", "int"),
            ("event_ts", "event_time", "timestamp"),
            ("peak_flag", "peak_flag", "int"),
            ("speed_band", "speed_band", "string"),
            ("weather", "weather", "string"),
            ("event_date", "event_date", "date"),
            ("hour", "event_hour", "int"),
            ("ingested_at", "ingested_at", "timestamp"),
        ),
    ),
    "bi_dim_zone": ("dim_zone", tuple((c, c, "string") for c in DIM_ZONE.names)),
    "bi_dim_road": (
        "dim_road",
        (
            ("road_id", "road_id", "string"),
            ("road_type", "road_type", "string"),
            ("speed_limit", "speed_limit", "int"),
        ),
    ),
    "bi_rejects": (
        "traffic_rejects",
        (
            ("vehicle_id", "vehicle_id", "string"),
            ("road_id", "road_id", "string"),
            ("city_zone", "city_zone", "string"),
            ("reject_reason", "reject_reason", "string"),
            ("rejected_at", "rejected_at", "timestamp"),
            ("raw_json", "raw_json", "string"),
        ),
    ),
}
