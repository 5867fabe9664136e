from __future__ import annotations

import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadstream.schemas import BRONZE  # noqa: E402
from roadstream.session import SPARK_CONF  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("roadstream-tests")
    conf = {
        **SPARK_CONF,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "2000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NOW = datetime(2031, 9, 2, 6, 30, tzinfo=timezone.utc)
ROW = StructType([field for field in BRONZE if field.name != "kafka_partition"])

# A valid row: a value for each type, and those that the rules look at.
BY_TYPE = {"string": "x", "int": 2, "bigint": 0, "timestamp": NOW}


def at(minutes: float = 0) -> str:
    """ISO-8601 text of an instant so many minutes from the arrival of the row."""
    return (NOW + timedelta(minutes=minutes)).isoformat()


def event(**changed) -> dict:
    """A valid bronze row; arguments replace single values."""
    row = {field.name: BY_TYPE[field.dataType.simpleString()] for field in ROW}
    row.update(speed="45", event_time=at())
    row.update(changed)
    return row


@pytest.fixture
def bronze(spark):
    def build(*rows: dict):
        return spark.createDataFrame(list(rows), ROW)

    return build


def rows_of(df, *columns) -> list[tuple]:
    """All rows as sorted tuples, for comparing multisets."""
    chosen = df.select(*(columns or df.columns))
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
