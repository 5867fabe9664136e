"""Input for queries and tests: messages and bronze rows derived from any event table.

Every value is a function of the row, so the feed is the same on every run and at every
scale, and needs no state: a duplicate is the row emitted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.functions import first_match
from roadstream.schemas import BRONZE

# Value domains and fault kinds of the feed.
ROAD_COUNT = 4
ZONE_NAMES = ("CBD", "AIRPORT", "TECHPARK", "SUBURB", "TRAINSTATION")
EVENT_WEATHER = {"view": "RAIN", "signup": "FOG", "purchase": "STORM"}
OTHER_WEATHER = "CLEAR"
FAULTS = (
    "null_speed",
    "negative_speed",
    "extreme_speed",
    "duplicate_event",
    "late_event",
    "future_event",
    "wrong_datatype",
    "schema_drift",
    "corrupt_json",
)
WORD_SPEEDS = ("brisk", "crawl", "n/a")
ROAD_CONDITIONS = ("DRY", "WET", "ICY")
CORRUPT_PAYLOAD = '{"raw":"###CORRUPTED_EVENT###","corrupted":true}'
ISO_8601 = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _pick(names, number: Column) -> Column:
    place = F.pmod(number, F.lit(len(names))) + 1
    return F.element_at(F.array(*map(F.lit, names)), place.cast("int"))


def clean_events(events: DataFrame) -> DataFrame:
    """Traffic events read off the columns of an event table; event_id numbers the messages."""
    number = F.col("event_id")
    weather = [(F.col("event_type") == kind, name) for kind, name in EVENT_WEATHER.items()]
    return events.select(
        F.concat(F.lit("veh-"), F.col("user_id")).alias("vehicle_id"),
        F.concat(F.lit("R"), (number % ROAD_COUNT + 1) * 100).alias("road_id"),
        _pick(ZONE_NAMES, F.expr(f"event_id div {ROAD_COUNT}")).alias("city_zone"),
        F.floor("value").cast("int").alias("speed"),
        (number % 5 + 1).cast("int").alias("congestion_level"),
        first_match(weather, OTHER_WEATHER).alias("weather"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        number.alias("offset"),
        F.col("event_type"),
    )


def error_faults() -> Column:
    """Fault of a message: events of type ``error`` take the kinds in turn."""
    return F.when(F.col("event_type") == "error", _pick(FAULTS, F.col("offset")))


def inject_faults(events: DataFrame, fault: Column) -> DataFrame:
    """Apply each row's fault to its columns; a duplicated event comes out twice."""
    number = F.col("offset")
    turn = F.expr(f"offset div {len(FAULTS)}")
    is_fault = {name: F.col("fault") == name for name in FAULTS}
    speed = [
        (is_fault["null_speed"], F.lit(None).cast("int")),
        (is_fault["negative_speed"], (-10 - number % 51).cast("int")),
        (is_fault["extreme_speed"], (250 + number % 351).cast("int")),
    ]
    shift = [
        (is_fault["late_event"], -10 - number % 111),
        (is_fault["future_event"], 5 + number % 56),
    ]
    emitted = F.sequence(F.lit(1), first_match([(is_fault["duplicate_event"], 2)], 1))
    minutes = first_match(shift, 0).cast("int")
    return (
        events.withColumn("fault", fault)
        .withColumns(
            {
                "arrival": F.col("event_ts"),
                "event_ts": F.col("event_ts") + F.make_dt_interval(mins=minutes),
                "speed": first_match(speed, F.col("speed")),
                "speed_word": F.when(is_fault["wrong_datatype"], _pick(WORD_SPEEDS, turn)),
                "road_condition": F.when(is_fault["schema_drift"], _pick(ROAD_CONDITIONS, turn)),
                "copy": F.explode(emitted),
            }
        )
        .drop("copy")
    )


def encode_envelope(faulted: DataFrame, partitions: int = 3) -> DataFrame:
    """Rows as messages: JSON bytes, keyed by zone, corrupt ones unkeyed."""

    def payload(speed: Column, *more: str) -> Column:
        fields = F.struct(
            "vehicle_id",
            "road_id",
            "city_zone",
            speed.alias("speed"),
            "congestion_level",
            "weather",
            F.date_format("event_ts", ISO_8601).alias("event_time"),
            *more,
        )
        return F.to_json(fields, {"ignoreNullFields": "false"})

    corrupt = F.coalesce(F.col("fault") == "corrupt_json", F.lit(False))
    text = first_match(
        [
            (corrupt, F.lit(CORRUPT_PAYLOAD)),
            (F.col("speed_word").isNotNull(), payload(F.col("speed_word"))),
            (F.col("road_condition").isNotNull(), payload(F.col("speed"), "road_condition")),
        ],
        payload(F.col("speed")),
    )
    return faulted.select(
        F.when(~corrupt, F.col("city_zone").cast("binary")).alias("key"),
        text.cast("binary").alias("value"),
        F.col("arrival").alias("timestamp"),
        (F.col("offset") % partitions).cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
    )


def dirty_feed(events: DataFrame, fault: Column | None = None) -> DataFrame:
    """Messages for every row of an event table."""
    fault = error_faults() if fault is None else fault
    return encode_envelope(inject_faults(clean_events(events), fault))


def gappy_bronze(events: DataFrame) -> DataFrame:
    """Bronze rows with gaps in every column, so that every rule has something to reject.

    Vehicles, times, congestion, roads and zones are missing in turn; speeds have fractions,
    blanks around them or nothing at all; some times cannot be read; some payloads are
    corrupt; some rows come twice, each with an offset of its own.
    """
    number = F.col("event_id")

    def missing(every: int, value: Column) -> Column:
        return F.when(number % every != 0, value)

    whole = F.floor("value").cast("int").cast("string")
    speed = [
        (number % 8 == 0, F.concat(whole, F.lit(".5"))),
        (number % 8 == 1, F.concat(F.lit("  "), whole, F.lit(" "))),
        (number % 8 == 2, F.lit("")),
    ]
    arrival = F.col("ts").cast("timestamp")
    time = F.when(number % 17 == 0, "soon").otherwise(F.date_format(arrival, ISO_8601))
    copy = F.explode(F.sequence(F.lit(0), F.when(number % 23 == 0, 1).otherwise(0)))
    rows = events.select("*", copy.alias("copy")).select(
        F.when(number % 19 == 0, CORRUPT_PAYLOAD).otherwise("{}").alias("raw_json"),
        arrival.alias("kafka_timestamp"),
        (number % 3).cast("int").alias("kafka_partition"),
        (2 * number + F.col("copy")).alias("kafka_offset"),
        missing(11, F.concat(F.lit("veh-"), F.col("user_id"))).alias("vehicle_id"),
        missing(5, F.concat(F.lit("R"), (number % ROAD_COUNT + 1) * 100)).alias("road_id"),
        missing(6, _pick(ZONE_NAMES, F.expr(f"event_id div {ROAD_COUNT}"))).alias("city_zone"),
        first_match(speed, whole).alias("speed"),
        missing(7, (number % 5 + 1).cast("int")).alias("congestion_level"),
        F.lit(OTHER_WEATHER).alias("weather"),
        missing(13, time).alias("event_time"),
    )
    return rows.select(*BRONZE.names)
