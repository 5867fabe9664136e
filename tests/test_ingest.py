from __future__ import annotations

from datetime import datetime

from conftest import rows_of

from roadstream.operators.ingest import bronze_rows
from roadstream.schemas import BRONZE, ENVELOPE

STAMP = datetime(2026, 3, 24, 10, 0)


def parse(spark, *texts):
    values = [None if text is None else text.encode() for text in texts]
    rows = [(value, STAMP, 1, number) for number, value in enumerate(values)]
    return bronze_rows(spark.createDataFrame(rows, ENVELOPE)).orderBy("kafka_offset").collect()


def test_schema_and_metadata(spark):
    frame = bronze_rows(spark.createDataFrame([(b"{}", STAMP, 2, 9)], ENVELOPE))
    assert frame.columns == BRONZE.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in BRONZE]
    assert rows_of(frame, "raw_json", "kafka_partition", "kafka_offset") == [("{}", 2, 9)]


def test_numbers_become_text_and_unknown_keys_stay_raw(spark):
    text = '{"vehicle_id":"v","speed":60,"congestion_level":2,"road_condition":"BAD"}'
    row = parse(spark, text)[0]
    assert (row["vehicle_id"], row["speed"], row["congestion_level"]) == ("v", "60", 2)
    assert row["raw_json"] == text and row["weather"] is None


def test_wrong_types_give_null_fields_only(spark):
    rows = parse(
        spark,
        '{"vehicle_id":"v","congestion_level":"3","speed":"FAST"}',
        '{"vehicle_id":"v","congestion_level":2.0,"speed":{"a":1}}',
    )
    assert [r["congestion_level"] for r in rows] == [None, None]
    assert [r["vehicle_id"] for r in rows] == ["v", "v"]
    assert [r["speed"] for r in rows] == ["FAST", '{"a":1}']


def test_every_message_gives_one_row(spark):
    texts = ["not json", "", "[]", "null", "{}", None, '"text"', '{"vehicle_id":null}']
    rows = parse(spark, *texts)
    assert [r["raw_json"] for r in rows] == texts
    assert all(r["vehicle_id"] is None for r in rows)
