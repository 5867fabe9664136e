"""Streaming sources: the raw message stream, and a growing table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roadstream.schemas import ENVELOPE
from roadstream.settings import Settings
from roadstream.sources.tables import Table


def raw_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    """Messages from Kafka, or from envelope files when ``raw_path`` is set.

    No consumer group is given: the checkpoint holds the offsets, and a group would compete
    with it.
    """
    if settings.raw_path:
        reader = spark.readStream.schema(ENVELOPE)
        reader = reader.option("maxFileAge", settings.raw_max_file_age)
        if settings.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", settings.max_files_per_trigger)
        return reader.parquet(settings.raw_path)
    options = {
        "kafka.bootstrap.servers": settings.kafka_servers,
        "subscribe": settings.kafka_topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": settings.fail_on_data_loss,
    }
    if settings.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = settings.max_offsets_per_trigger
    if settings.kafka_min_partitions:
        options["minPartitions"] = settings.kafka_min_partitions
    return spark.readStream.format("kafka").options(**options).load()


def days_from(first: date) -> str:
    """A path pattern for every ISO date from ``first`` on, and for rows without a date.

    A later date has the same digits up to some place and a greater one there.
    """
    text = first.isoformat()
    later = [
        f"{text[:place]}[{int(digit) + 1}-9]*"
        for place, digit in enumerate(text)
        if digit.isdigit() and digit != "9"
    ]
    return "{" + ",".join([text, *later, "__HIVE_DEFAULT_PARTITION__"]) + "}"


def table_stream(
    table: Table, settings: Settings, columns=None, since: date | None = None
) -> DataFrame:
    """Rows as a table grows. Columns left out are never read.

    With ``since``, only the directories of that day and later ones are listed at a trigger, so
    that its cost does not follow the age of the table. A Delta log needs no listing.
    """
    reader = table.spark.readStream.format(table.format)
    path = table.path
    if settings.max_table_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", settings.max_table_files_per_trigger)
    if table.format == "delta":
        reader = reader.option("ignoreChanges", "true")
    else:
        # Declared, so that it does not matter whether there is a file at the start.
        reader = reader.schema(table.stored_schema).option("maxFileAge", "36500d")
        if since:
            reader = reader.option("basePath", path)
            path = f"{path}/{table.partition_by[0]}={days_from(since)}"
    return reader.load(path).select(*(columns or table.schema.names))
