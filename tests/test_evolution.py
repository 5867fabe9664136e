"""Tables that are given columns, and what is stored so that raw text need not be read."""

from __future__ import annotations

import re
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import TESTDATA, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.operators import duplicates, quality
from roadstream.settings import Settings
from roadstream.sources import catalog
from roadstream.sources.feed import dirty_feed
from roadstream.sources.tables import Table
from roadstream.sources.warehouse import warehouse_tables
from roadstream.streaming import jobs

NARROW = StructType().add("k", "integer").add("v", "string")
WIDE = StructType([*NARROW.fields, *StructType().add("w", "string").fields])


def test_a_wider_job_and_a_narrower_one_share_a_table(spark, tmp_path):
    narrow, wide = (Table(spark, str(tmp_path / "t"), schema) for schema in (NARROW, WIDE))
    narrow.create()
    assert narrow.append(spark.createDataFrame([(1, "a")], NARROW)) == 1
    wide.create()
    assert wide.append(spark.createDataFrame([(2, "b", "x"), (3, "c", None)], WIDE)) == 2
    assert rows_of(wide.read()) == [(1, "a", None), (2, "b", "x"), (3, "c", None)]
    narrow.create()  # an older job starts again: the column stays
    assert narrow.append(spark.createDataFrame([(4, "d")], NARROW)) == 1
    assert narrow.columns() == WIDE
    assert rows_of(wide.read(), "k", "w") == [(1, None), (2, "x"), (3, None), (4, None)]
    assert rows_of(narrow.read(), "k") == [(1,), (2,), (3,), (4,)]
    assert narrow.append(spark.createDataFrame([], NARROW)) == 0


def test_a_column_keeps_its_type(spark, tmp_path):
    Table(spark, str(tmp_path / "t"), NARROW).create()
    other = StructType().add("k", "string")
    with pytest.raises(ValueError, match="column k is stored as int, not string"):
        Table(spark, str(tmp_path / "t"), other).create()


def test_extra_keys_have_to_be_new():
    assert Settings(extra_payload=" lane, ,toll").extra_columns.names == ["lane", "toll"]
    with pytest.raises(ValueError, match="speed"):
        Settings(extra_payload="lane,speed")


def test_registered_tables_and_views_show_new_columns(spark, tmp_path):
    plain = Settings(warehouse=str(tmp_path / "warehouse"), database="evolving_test")
    catalog.register_warehouse(spark, plain, str(tmp_path / "database"))
    view, table = "evolving_test.bi_rejects", "evolving_test.traffic_rejects"
    before = spark.table(view).columns
    wide = replace(plain, extra_payload="lane")
    rejects = warehouse_tables(spark, wide)["traffic_rejects"]
    rejects.create()
    catalog.show_new_columns(wide, "traffic_rejects", rejects)
    assert spark.table(view).columns == [*before, "lane"]
    assert spark.table(table).columns[-2:] == ["lane", "arrival_date"]
    catalog.register_warehouse(spark, plain, str(tmp_path / "database"))  # an older version
    assert spark.table(view).columns == [*before, "lane"]


@pytest.fixture(scope="module")
def messages(spark):
    return dirty_feed(spark.read.parquet(f"{TESTDATA}/events.parquet")).drop("key")


def test_copies_of_stored_messages_are_counted_without_their_text(spark, messages, tmp_path):
    settings = Settings(warehouse=str(tmp_path / "warehouse"), raw_path=str(tmp_path / "raw"))
    messages.write.parquet(settings.raw_path)
    jobs.start_bronze(spark, settings, once=True).awaitTermination()
    bronze = warehouse_tables(spark, settings)["traffic_bronze"].read()
    checked = quality.check_rows(bronze, settings, F.col("kafka_timestamp"))
    labelled = duplicates.label_duplicates(checked)
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: (.*)", plan)
    assert len(scans) > 1
    assert len([scan for scan in scans if "raw_json" in scan]) == 1  # the rows themselves
    found = dict(rows_of(labelled.groupBy("dq_flag").count()))
    plain = quality.check_rows(bronze.drop("corrupt"), settings, F.col("kafka_timestamp"))
    assert found == dict(rows_of(plain.groupBy("dq_flag").count()))
    assert found["CORRUPT_JSON"] > 0


def test_an_empty_batch_writes_nothing(spark, messages, tmp_path):
    settings = Settings(warehouse=str(tmp_path / "warehouse"), raw_path=str(tmp_path / "raw"))
    messages.filter("offset < 200").write.parquet(settings.raw_path)
    jobs.run_available(spark, settings)

    def files():
        return sorted(str(p) for p in Path(settings.warehouse).glob("[dft]*/**/*.parquet"))

    before = files()
    assert before
    messages.filter("false").write.mode("append").parquet(settings.raw_path)
    jobs.run_available(spark, settings)
    assert files() == before


def test_a_merge_leaves_nothing_cached(spark, messages, tmp_path):
    settings = Settings(warehouse=str(tmp_path / "warehouse"), raw_path=str(tmp_path / "raw"))
    spark.catalog.clearCache()
    messages.filter("offset < 200").write.parquet(settings.raw_path)
    jobs.run_available(spark, settings)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
