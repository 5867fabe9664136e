"""Derived columns of clean rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.functions import first_match
from roadstream.schemas import SILVER

# Rush hours (both ends included) and speed bands (upper end excluded).
PEAK_HOURS = ((8, 11), (17, 20))
SPEED_BANDS = ((30, "LOW"), (70, "MEDIUM"))
TOP_BAND = "HIGH"


def apply_feature_engineering(df: DataFrame) -> DataFrame:
    """Add hour (session time zone), peak_flag and speed_band."""
    hour = F.hour("event_ts")
    peak = [(hour.between(first, last), 1) for first, last in PEAK_HOURS]
    bands = [(F.col("speed_int") < below, band) for below, band in SPEED_BANDS]
    return df.withColumns(
        {
            "hour": hour,
            "peak_flag": first_match(peak, 0),
            "speed_band": first_match(bands, TOP_BAND),
        }
    )


def silver_rows(clean: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Clean, deduplicated rows in the shape of the silver table, with ``extra`` columns."""
    featured = apply_feature_engineering(clean)
    return featured.select(*[c for c in SILVER.names if c in featured.columns], *extra)
