from __future__ import annotations

from collections import Counter

import pytest
from conftest import TESTDATA, at, event, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadstream.operators import duplicates
from roadstream.operators.quality import OK, check_rows, filter_clean_records, is_clean
from roadstream.plans.batch import BatchPipeline
from roadstream.sources.feed import dirty_feed

KEYED = "number int, vehicle_id string, event_ts timestamp, good boolean"


def keyed(spark, pairs):
    rows = [(i, v, None if t is None else at(t), g) for i, (v, t, g) in enumerate(pairs)]
    text = KEYED.replace("timestamp", "string")
    frame = spark.createDataFrame(rows, text)
    return frame.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def expected(pairs):
    counts = Counter((v, t) for v, t, g in pairs if g)
    return sorted((i, counts[(v, t)] if g else 1) for i, (v, t, g) in enumerate(pairs))


PAIRS = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 2), st.booleans()), min_size=1, max_size=25
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=PAIRS)
def test_copies_equal_brute_force(spark, pairs):
    frame = keyed(spark, pairs)
    counted = duplicates.count_copies(frame, F.col("good"))
    assert rows_of(counted, "number", "copies") == sorted(expected(pairs), key=repr)
    good = frame.filter("good")
    single = duplicates.drop_repeated(good)
    kept = [(i,) for i, n in expected(pairs) if n == 1 and pairs[i][2]]
    assert rows_of(single, "number") == sorted(kept, key=repr)


@pytest.mark.parametrize("broadcast_limit", ["10m", "-1"])
def test_hot_key_equals_window(spark, broadcast_limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        number = F.col("id")
        is_hot = number % 3 == 0
        vehicle = F.when(is_hot, "hot").otherwise(F.concat(F.lit("v"), number % 700))
        second = F.when(is_hot, 0).otherwise(number % 11)
        frame = spark.range(3000).select(
            number, vehicle.alias("vehicle_id"), F.timestamp_seconds(second).alias("event_ts")
        )
        window = Window.partitionBy("vehicle_id", "event_ts")
        oracle = frame.withColumn("copies", F.count("*").over(window))
        counted = duplicates.count_copies(frame)
        assert rows_of(counted, "id", "copies") == rows_of(oracle, "id", "copies")
        single = duplicates.drop_repeated(frame)
        assert rows_of(single, "id") == rows_of(oracle.filter("copies = 1"), "id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")


def test_any_number_of_hot_keys_is_spread(spark, monkeypatch):
    """More hot keys than buckets: no task of the join gets much more than its share."""
    monkeypatch.setattr(duplicates, "BUCKETS", 16)
    rows, partitions = 40_000, 20
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": str(partitions),
    }
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        # One key has half of the rows, 40 more share a quarter, the rest occur twice.
        number = F.col("id")
        key = (
            F.when(number % 2 == 0, "half")
            .when(number % 4 == 1, F.concat(F.lit("hot"), F.expr("id div 4") % 40))
            .otherwise(F.concat(F.lit("v"), F.expr("id div 8")))
        )
        frame = spark.range(rows, numPartitions=8).select(
            "id", key.alias("vehicle_id"), F.timestamp_seconds(F.lit(0)).alias("event_ts")
        )
        counted = duplicates.count_copies(frame)
        sizes = counted.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(row["count"] for row in sizes) == rows
        assert max(row["count"] for row in sizes) < 5 * rows / partitions
        copies = dict(rows_of(counted.groupBy("vehicle_id").agg(F.max("copies"))))
        assert copies["half"] == rows // 2 and copies["hot7"] == rows // 160
        assert duplicates.drop_repeated(frame).count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_rows_outside_the_count_spread_over_partitions(spark):
    """NULL keys of rejected rows must not meet in one task of the shuffle join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(4000).select(
            "id",
            F.lit(None).cast("string").alias("vehicle_id"),
            F.lit(None).cast("timestamp").alias("event_ts"),
        )
        good = frame.unionByName(
            spark.range(10).select(
                (F.col("id") + 10**6).alias("id"),
                F.lit("v").alias("vehicle_id"),
                F.timestamp_seconds(F.lit(0)).alias("event_ts"),
            )
        )
        counted = duplicates.count_copies(good, F.col("vehicle_id").isNotNull())
        sizes = counted.filter("vehicle_id IS NULL").groupBy(F.spark_partition_id()).count()
        sizes = [row["count"] for row in sizes.collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_few_repeated_keys_move_no_full_row(spark, tmp_path):
    """The keys are counted without the wide columns, and the wide rows are never shuffled."""
    path = str(tmp_path / "rows")
    spark.range(5000).select(
        "id",
        F.concat(F.lit("v"), F.col("id") % 4990).alias("vehicle_id"),
        F.timestamp_seconds(F.lit(0)).alias("event_ts"),
        F.repeat(F.lit("x"), 200).alias("raw_json"),
    ).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.read.parquet(path)
        for operator in (duplicates.count_copies, duplicates.drop_repeated):
            plan = final_plan(operator(rows))
            assert "SortMergeJoin" not in plan
            moved = [line for line in plan.splitlines() if " Exchange " in line]
            assert moved and not any("raw_json" in line for line in moved)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_copies_of_stored_rows_are_counted_without_their_text(bronze, tmp_path):
    path = str(tmp_path / "checked")
    checked_batch(bronze).write.parquet(path)
    checked = bronze(event()).sparkSession.read.parquet(path)
    counts = duplicates.key_counts(checked.filter(is_clean()))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    (schema,) = [line for line in plan.splitlines() if "ReadSchema" in line]
    read = schema.split("ReadSchema")[1]
    assert "vehicle_id" in read and "raw_json" not in read and "event_time" not in read


def checked_batch(bronze):
    rows = [
        event(kafka_offset=0),
        event(kafka_offset=1, road_id="R300", city_zone="SUBURB"),  # same key, other road
        event(kafka_offset=2, vehicle_id="v-2"),
        event(kafka_offset=3, vehicle_id="v-2"),
        event(kafka_offset=4, vehicle_id="v-2"),
        event(kafka_offset=5, vehicle_id="v-3"),
        event(kafka_offset=6, vehicle_id="v-3", speed="FAST"),  # rejected: no copy of 5
        event(kafka_offset=7, vehicle_id="v-3", event_time=at(1)),
        event(kafka_offset=8, vehicle_id=None, raw_json="CORRUPTED"),
        event(kafka_offset=9, vehicle_id=None, raw_json="CORRUPTED"),
    ]
    return check_rows(bronze(*rows), as_of=F.col("kafka_timestamp"))


LABELS = ["DUPLICATE_EVENT"] * 5 + [OK, "INVALID_SPEED", OK, "CORRUPT_JSON", "CORRUPT_JSON"]


def test_every_copy_is_rejected_and_no_row_is_lost(bronze):
    checked = checked_batch(bronze)
    labelled = duplicates.label_duplicates(checked).orderBy("kafka_offset").collect()
    assert [row["reject_reason"] for row in labelled] == LABELS
    kept = duplicates.drop_repeated(filter_clean_records(checked))
    assert rows_of(kept, "kafka_offset") == [(5,), (7,)]
    rejected = duplicates.rejected_rows(duplicates.label_duplicates(checked))
    quarantined = duplicates.stamp_rejects(rejected, F.col("kafka_timestamp"))
    assert rows_of(quarantined, "kafka_offset", "reject_reason") == [
        (i, label) for i, label in enumerate(LABELS) if label != OK
    ]
    assert checked.count() == kept.count() + quarantined.count()


def test_quarantine_of_an_empty_batch(bronze):
    checked = check_rows(bronze(event()).filter("false"))
    assert duplicates.label_duplicates(checked).count() == 0


def test_full_rows_stay_where_kept_keys_can_be_broadcast(spark):
    """The planner knows the size of kept repeated keys before it would deal out any full row."""
    messages = dirty_feed(spark.read.parquet(f"{TESTDATA}/events.parquet"))
    checked = BatchPipeline(messages).checked.persist()
    kept = []

    def keep(rows):
        kept.append(rows.persist())
        rows.count()
        return rows

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # by its size at run time only
    try:
        labelled = duplicates.label_duplicates(checked, keep)
        found = rows_of(labelled)
        ran = final_plan(labelled)
        joins = [line for line in ran.splitlines() if "Join [vehicle_id" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
        assert found == rows_of(duplicates.label_duplicates(checked))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for rows in (checked, *kept):
            rows.unpersist()


def test_stored_batch_counts_once_and_moves_no_full_row(spark, tmp_path, monkeypatch):
    """Silver and quarantine of a stored batch share the repeated keys, counted before they meet rows."""
    messages = dirty_feed(spark.read.parquet(f"{TESTDATA}/events.parquet"))
    lazy, stored = BatchPipeline(messages), BatchPipeline(messages, folder=str(tmp_path / "batch"))
    counted, count = [], duplicates.key_counts
    monkeypatch.setattr(
        duplicates, "key_counts", lambda *args: counted.append(args) or count(*args)
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # by the number of keys only
    try:
        for rows in (stored.labelled, stored.clean):
            joins = [line for line in final_plan(rows).splitlines() if "Join [vehicle_id" in line]
            assert joins and all("BroadcastHashJoin" in line for line in joins)
        assert len(counted) == 1
        assert rows_of(stored.labelled) == rows_of(lazy.labelled)
        assert rows_of(stored.clean) == rows_of(lazy.clean)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
