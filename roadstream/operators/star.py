"""Silver rows to the star schema: two dimensions and one fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.functions import first_match
from roadstream.schemas import DIM_ROAD, DIM_ZONE, FACT

# Attributes of the known zones and roads, then of all others.
ZONES = {
    "CBD": ("Commercial", "HIGH"),
    "TECHPARK": ("IT Hub", "MEDIUM"),
    "AIRPORT": ("Transit Hub", "HIGH"),
    "TRAINSTATION": ("Transit Hub", "HIGH"),
}
OTHER_ZONE = ("Residential", "LOW")
ROADS = {"R100": ("Highway", 100), "R200": ("Highway", 100)}
OTHER_ROAD = ("City Road", 60)


def _attribute(key: str, known: dict, other: tuple, position: int) -> Column:
    rules = [(F.col(key) == name, F.lit(row[position])) for name, row in known.items()]
    return first_match(rules, F.lit(other[position]))


def dim_zone(silver: DataFrame) -> DataFrame:
    """One row per zone seen, with its type and traffic risk."""
    zones = silver.select("city_zone").distinct()
    return zones.withColumns(
        {
            "zone_type": _attribute("city_zone", ZONES, OTHER_ZONE, 0),
            "traffic_risk": _attribute("city_zone", ZONES, OTHER_ZONE, 1),
        }
    ).select(*DIM_ZONE.names)


def dim_road(silver: DataFrame) -> DataFrame:
    """One row per road seen, with its type and speed limit."""
    roads = silver.select("road_id").distinct()
    return roads.withColumns(
        {
            "road_type": _attribute("road_id", ROADS, OTHER_ROAD, 0),
            "speed_limit": _attribute("road_id", ROADS, OTHER_ROAD, 1),
        }
    ).select(*DIM_ROAD.names)


def fact_traffic(silver: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One row per clean event."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    added = {
        "speed": F.col("speed_int"),
        "event_date": F.to_date("event_ts"),
        "ingested_at": stamp,
    }
    return silver.select(*[added[c].alias(c) if c in added else F.col(c) for c in FACT.names])
