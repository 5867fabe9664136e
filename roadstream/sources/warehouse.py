"""The warehouse: which table is where, in which shape, and how rows are merged into it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream import schemas
from roadstream.operators.merge import lacking, offer_counts
from roadstream.settings import Settings
from roadstream.sources.tables import Table

# Tables of messages: a directory per day of arrival, files sorted by offset.
BY_ARRIVAL = {
    "partition_by": ("arrival_date",),
    "day_of": "kafka_timestamp",
    "sort_by": ("kafka_offset",),
}

# The tables of the warehouse, named as their directories.
LAYOUT = {
    "traffic_bronze": {"schema": schemas.STORED_BRONZE, **BY_ARRIVAL},
    "traffic_silver": {"schema": schemas.SILVER, **BY_ARRIVAL},
    "traffic_rejects": {"schema": schemas.REJECTS, **BY_ARRIVAL},
    "dim_zone": {"schema": schemas.DIM_ZONE},
    "dim_road": {"schema": schemas.DIM_ROAD},
    "fact_traffic": {
        "schema": schemas.FACT,
        "partition_by": ("event_date",),
        "sort_by": ("event_ts",),
    },
}


# Tables that keep columns of the payload, and so get the extra ones.
OF_MESSAGES = ("traffic_bronze", "traffic_silver", "traffic_rejects")


def warehouse_tables(spark: SparkSession, settings: Settings) -> dict[str, Table]:
    """Every table of the warehouse, whether it exists yet or not."""
    tables = {}
    for name, shape in LAYOUT.items():
        if name in OF_MESSAGES:
            columns = [*shape["schema"].fields, *settings.extra_columns.fields]
            shape = {**shape, "schema": StructType(columns)}
        path = settings.table_path(name)
        tables[name] = Table(spark, path, format=settings.table_format, **shape)
    return tables


@dataclass(frozen=True)
class MergeResult:
    """Rows offered to an insert-only merge, and rows it added."""

    incoming: int
    inserted: int


def span_counts() -> list[Column]:
    """How many messages there are, and which days and offsets they cover."""
    day, offset = F.to_date("kafka_timestamp"), F.col("kafka_offset")
    return [
        F.count("*").alias("rows"),
        F.collect_set(day).alias("days"),
        F.min(offset).alias("first"),
        F.max(offset).alias("last"),
        F.count_if(day.isNull() | offset.isNull()).alias("unplaced"),
    ]


def message_span(messages: DataFrame) -> Row:
    """The ``span_counts`` of messages."""
    return messages.agg(*span_counts()).first()


def _message() -> Column:
    return F.struct(*schemas.MESSAGE_KEY).alias("message")


def _held_keys(table: Table, span: Row) -> DataFrame:
    """The keys of the messages of a table that a batch of this span can bring again."""
    if span["unplaced"]:
        return table.read().select(_message())
    within = F.col("kafka_offset").between(span["first"], span["last"])
    return table.read_days(span["days"]).filter(within).select(_message())


def unstored(
    messages: DataFrame, span: Row, *tables: Table, keys: DataFrame | None = None
) -> DataFrame:
    """The messages that none of the tables holds.

    A message is known by its partition, offset and time of arrival, so whatever brings it a
    second time (a replayed batch, a new checkpoint) adds nothing. Only the days of the batch
    are listed, and in them only row groups that overlap its offsets are read: as offsets
    rise, that is next to nothing.

    Full rows are dealt out for the comparison only if one of them is held. That is asked first,
    of the keys alone, and not even that where the tables hold nothing in the span. ``keys`` are
    rows with the keys of the messages that are cheaper to read.
    """
    found = [keys for keys in (_held_keys(t, span) for t in tables if t.exists()) if not keys.isEmpty()]
    if not found:
        return messages
    held = reduce(DataFrame.union, found)
    asked = (messages if keys is None else keys).select(_message())
    if asked.join(held, "message", "left_semi").isEmpty():
        return messages
    keyed = messages.withColumn("message", _message())
    return keyed.join(held, "message", "left_anti").drop("message")


def first_open_day(days: DataFrame, margin: int) -> date | None:
    """The first of ``days`` (day, finished) that is not finished, or the one ``margin`` days before
    the newest, if that is earlier; None without days."""
    found = days.agg(
        F.min(F.when(~F.col("finished"), F.col("day"))).alias("open"), F.max("day").alias("newest")
    ).first()
    if found["newest"] is None:
        return None
    recent = found["newest"] - timedelta(days=margin)
    return min(found["open"] or recent, recent)


def split_days(bronze: Table, silver: Table, rejects: Table) -> DataFrame:
    """Days of arrival, and whether silver and quarantine have as many messages of them as bronze.

    Every message ends up in one of the two, once. Only rows are counted: no column is read.
    """
    def counted(table: Table, sign: int) -> DataFrame:
        days = table.read_placed().groupBy(F.col("arrival_date").alias("day"))
        return days.agg((sign * F.count("*")).alias("rows"))

    counts = counted(bronze, 1).union(counted(silver, -1)).union(counted(rejects, -1))
    days = counts.groupBy("day").agg(F.sum("rows").alias("rows"))
    return days.select("day", (F.col("rows") == 0).alias("finished")).where("day IS NOT NULL")


def merged_days(silver: Table, fact: Table) -> DataFrame:
    """Days of arrival, and whether the fact holds the keys of all their silver rows."""
    rows = silver.read_placed().select(F.col("arrival_date").alias("day"), *schemas.FACT_KEY)
    missing = lacking(rows, fact.read(), schemas.FACT_KEY).select("day", F.lit(False).alias("finished"))
    days = rows.select("day").distinct().withColumn("finished", F.lit(True)).union(missing)
    return days.where("day IS NOT NULL").groupBy("day").agg(F.min("finished").alias("finished"))


def upsert_dim(dimension: DataFrame, table: Table, key: str) -> MergeResult:
    """Insert dimension rows, one per key, whose key is new. A known key keeps its attributes.

    Counted first: nearly every batch brings no new key, and is then done without a write,
    which would leave an empty file behind.
    """
    dimension = dimension.persist()
    try:
        offer = offer_counts(dimension, table.read(), [key]).first()
        if offer["new"]:
            table.insert_new(dimension, [key])
        return MergeResult(offer["incoming"], offer["new"])
    finally:
        dimension.unpersist()


def micros(moment: datetime) -> int:
    """Microseconds since the epoch of a collected timestamp, which is in the local zone."""
    return int(moment.replace(microsecond=0).timestamp()) * 1_000_000 + moment.microsecond


def fact_span(facts: DataFrame) -> Row:
    """How many facts there are, and which time and days they cover."""
    time = F.col("event_ts")
    return facts.agg(
        F.count("*").alias("rows"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
        F.collect_set("event_date").alias("days"),
        F.count_if(time.isNull()).alias("timeless"),
    ).first()


def upsert_fact(facts: DataFrame, table: Table, span: Row | None = None) -> MergeResult:
    """Insert facts whose key is new.

    The event time is part of the key, so only rows of the same days and the same span of
    time can match: other days are not listed, other row groups not read. Without a ``span``
    the facts are persisted while it is found; with one they are read once.
    """
    if span is None:
        facts = facts.persist()
        try:
            return upsert_fact(facts, table, fact_span(facts))
        finally:
            facts.unpersist()
    if span["rows"] == 0:
        return MergeResult(0, 0)
    if span["timeless"]:
        return MergeResult(span["rows"], table.insert_new(facts, schemas.FACT_KEY))
    first, last = span["first"], span["last"]
    target = None  # Delta takes the condition instead
    if table.format != "delta":
        target = table.read_days(span["days"]).filter(F.col("event_ts").between(first, last))
    days = ", ".join(f"DATE'{day}'" for day in sorted(span["days"]))
    within = (
        f"held.event_date IN ({days}) AND held.event_ts BETWEEN "
        f"timestamp_micros({micros(first)}) AND timestamp_micros({micros(last)})"
    )
    return MergeResult(span["rows"], table.insert_new(facts, schemas.FACT_KEY, target, within))
