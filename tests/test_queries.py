"""Every named query against its SQL equivalent, run by DuckDB on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import NOW, TESTDATA, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from roadstream.plans import queries
from roadstream.plans.oracle import ORACLE_SQL as ORACLES
from roadstream.plans.queries import QUERIES


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{TESTDATA}/events.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name):
    result = QUERIES[name](spark, TESTDATA)
    expected = oracle.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows_of(result, *columns) == sorted(expected.fetchall(), key=repr)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


def test_what_was_built_is_built_again_for_other_events(spark, tmp_path):
    """The streamed warehouse is known by the content of the events, not by their files."""
    events = spark.read.parquet(f"{TESTDATA}/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "same" / "events.parquet"))
    events.limit(50).write.parquet(str(tmp_path / "other" / "events.parquet"))

    def built(sf_dir):
        return queries._once("test", lambda *_: object(), spark, str(sf_dir))

    assert built(TESTDATA) is built(tmp_path / "same") is not built(tmp_path / "other")


def test_workspaces_are_discarded(spark):
    folder = queries.workspace(spark)
    spark.range(3).write.parquet(folder)
    queries.discard_workspaces(spark)
    assert not Path(folder.removeprefix("file:")).exists() and not queries._FOLDERS


def test_messages_of_rounds_are_numbered_once(spark, monkeypatch, tmp_path):
    """Every copy of a message comes in one round, and the feed is made once for all rounds."""
    made = spark.sparkContext.accumulator(0)

    def text(number: int) -> str:
        made.add(1)
        return str(number)

    ids = spark.range(60).select(F.explode(F.array("id", "id")).alias("offset"))
    drawn = ids.select(
        F.lit(None).cast("binary").alias("key"),
        F.udf(text).asNondeterministic()("offset").cast("binary").alias("value"),
        F.lit(NOW).alias("timestamp"),
        F.lit(0).alias("partition"),
        "offset",
    )
    monkeypatch.setattr(queries, "feed", lambda *_: drawn)
    monkeypatch.setattr(queries, "run_available", lambda *_: None)
    raw = spark.read.parquet(queries._run_streams_in_rounds(spark, str(tmp_path)).raw_path)
    assert rows_of(raw, "offset") == sorted(((n,) for n in range(120)), key=repr)
    assert made.value == 120
