"""Row-level quality rules: flag, cast, validate, label. All are projections, none shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.functions import first_match, lenient_int, lenient_timestamp
from roadstream.settings import Settings

# Labels written to dq_flag and reject_reason.
OK = "OK"
CORRUPT_MARKER = "CORRUPTED"
INVALID_SPEED = "INVALID_SPEED"
INVALID_TIME = "INVALID_TIME"
DUPLICATE_EVENT = "DUPLICATE_EVENT"


def is_corrupt() -> Column:
    """Whether the raw text of a row holds the corrupt marker."""
    return F.col("raw_json").contains(CORRUPT_MARKER)


def apply_dq_flags(df: DataFrame) -> DataFrame:
    """Add dq_flag. A corrupt payload also lacks its fields, so that rule goes first.

    Rows of the bronze table carry the answer to that rule in ``corrupt``; others are searched.
    """
    corrupt = F.col("corrupt") if "corrupt" in df.columns else is_corrupt()
    rules = [
        (corrupt, "CORRUPT_JSON"),
        (F.col("vehicle_id").isNull(), "MISSING_VEHICLE"),
        (F.col("event_time").isNull(), "MISSING_TIME"),
        (F.col("congestion_level").isNull(), "MISSING_CONGESTION"),
    ]
    return df.withColumn("dq_flag", first_match(rules, OK))


def apply_type_casting(df: DataFrame) -> DataFrame:
    """Add speed_int and event_ts; a value that cannot be read becomes NULL.

    The casts come out of a generator so that each runs once per row: a later filter on them
    stays above it, where it would otherwise take a copy of both casts down to the scan.
    """
    typed = F.struct(
        lenient_int(F.col("speed")).alias("speed_int"),
        lenient_timestamp(F.col("event_time")).alias("event_ts"),
    )
    return df.select("*", F.inline(F.array(typed)))


def apply_business_validation(
    df: DataFrame, settings: Settings = Settings(), as_of: Column | None = None
) -> DataFrame:
    """Add speed_valid and time_valid as 0/1; both ranges include their ends, NULL gives 0.

    ``as_of`` is the instant an event is judged late or early against. Left out, it is the
    wall clock; with the arrival time of the row, a replay reaches the same verdict.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    earliest = as_of - F.make_dt_interval(mins=F.lit(settings.late_minutes))
    latest = as_of + F.make_dt_interval(mins=F.lit(settings.future_minutes))
    in_range = F.col("speed_int").between(settings.speed_min, settings.speed_max)
    in_time = F.col("event_ts").between(earliest, latest)
    return df.withColumns(
        {
            "speed_valid": F.when(in_range, 1).otherwise(0),
            "time_valid": F.when(in_time, 1).otherwise(0),
        }
    )


def label_reject_reason(df: DataFrame) -> DataFrame:
    """Add reject_reason: the structural flag first, then speed, then time, else OK."""
    rules = [
        (F.col("dq_flag") != OK, F.col("dq_flag")),
        (F.col("speed_valid") == 0, F.lit(INVALID_SPEED)),
        (F.col("time_valid") == 0, F.lit(INVALID_TIME)),
    ]
    return df.withColumn("reject_reason", first_match(rules, F.lit(OK)))


def is_clean() -> Column:
    """Whether a checked row passes every row-level rule."""
    return (F.col("dq_flag") == OK) & (F.col("speed_valid") == 1) & (F.col("time_valid") == 1)


def filter_clean_records(df: DataFrame) -> DataFrame:
    """Rows that pass every row-level rule."""
    return df.filter(is_clean())


def check_rows(
    bronze: DataFrame, settings: Settings = Settings(), as_of: Column | None = None
) -> DataFrame:
    """Bronze rows with every row-level verdict: flag, casts, validity and reason."""
    typed = apply_type_casting(apply_dq_flags(bronze))
    return label_reject_reason(apply_business_validation(typed, settings, as_of))
