"""Envelope bytes to parsed, still untyped rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.schemas import BRONZE, PAYLOAD


def decode_envelope(messages: DataFrame) -> DataFrame:
    """Message bytes as text, with where and when the message arrived."""
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def parse_payload(decoded: DataFrame, extra: StructType = StructType()) -> DataFrame:
    """Add the declared payload columns, and ``extra`` ones; what does not parse is NULL and stays
    in raw_json.

    The parsed struct is unpacked by a generator. A filter on a payload column stays above
    it, where ``select("data.*")`` would let the optimizer copy the parse into the filter.
    """
    parsed = F.from_json("raw_json", StructType(PAYLOAD.fields + extra.fields))
    return decoded.select("*", F.inline(F.array(parsed)))


def parse_in_order(decoded: DataFrame, extra: StructType = StructType()) -> DataFrame:
    """As ``parse_payload``, but as a projection: Spark knows that sorted rows are still sorted."""
    parsed = F.from_json("raw_json", StructType(PAYLOAD.fields + extra.fields))
    return decoded.withColumn("payload", parsed).select(*decoded.columns, "payload.*")


def bronze_rows(messages: DataFrame, extra: StructType = StructType()) -> DataFrame:
    return parse_payload(decode_envelope(messages), extra).select(*BRONZE.names, *extra.names)
