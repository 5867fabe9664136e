from __future__ import annotations

from dataclasses import fields

import pytest

from roadstream.settings import ENVIRONMENT, Settings


def test_defaults():
    settings = Settings.from_env({})
    assert settings == Settings()
    assert (settings.speed_min, settings.speed_max) == (0, 160)
    assert (settings.late_minutes, settings.future_minutes) == (20, 10)
    assert settings.max_offsets_per_trigger is None
    assert (settings.starting_offsets, settings.fail_on_data_loss) == ("earliest", "true")
    triggers = settings.bronze_trigger, settings.silver_trigger, settings.gold_trigger
    assert triggers == ("10 seconds", "15 seconds", "30 seconds")


def test_the_warehouse_has_to_be_named():
    with pytest.raises(ValueError, match="WAREHOUSE_PATH"):
        Settings().table_path("fact_traffic")
    settings = Settings.from_env({"WAREHOUSE_PATH": "hdfs:///w"})
    assert settings.table_path("fact_traffic") == "hdfs:///w/fact_traffic"
    assert settings.checkpoint_path("gold") == "hdfs:///w/chk/gold"
    moved = Settings.from_env({"WAREHOUSE_PATH": "hdfs:///w", "CHECKPOINT_PATH": "hdfs:///c"})
    assert moved.checkpoint_path("gold") == "hdfs:///c/gold"


def test_environment_overrides():
    settings = Settings.from_env(
        {"SPEED_MAX_KMH": "120", "KAFKA_TOPIC": "t", "SHUFFLE_PARTITIONS": "8", "RAW_PATH": ""}
    )
    assert (settings.speed_max, settings.kafka_topic) == (120, "t")
    assert settings.shuffle_partitions == 8 and settings.raw_path is None


def test_every_variable_fills_a_setting():
    assert set(ENVIRONMENT.values()) == {field.name for field in fields(Settings)}


def test_bad_values_are_refused():
    with pytest.raises(ValueError):
        Settings(clock="later")
    with pytest.raises(ValueError):
        Settings(table_format="csv")
    with pytest.raises(ValueError):
        Settings.from_env({"SPEED_MAX_KMH": "fast"})
