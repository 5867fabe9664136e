"""Run settings: one frozen object, built once and passed to whatever needs it."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql.types import StructType

from roadstream.schemas import REJECTS, SILVER

# Environment variable -> setting it fills.
ENVIRONMENT = {
    "SPARK_MASTER_URL": "master",
    "SHUFFLE_PARTITIONS": "shuffle_partitions",
    "SPARK_LOG_LEVEL": "log_level",
    "KAFKA_BOOTSTRAP_SERVERS": "kafka_servers",
    "KAFKA_TOPIC": "kafka_topic",
    "KAFKA_STARTING_OFFSETS": "starting_offsets",
    "KAFKA_MIN_PARTITIONS": "kafka_min_partitions",
    "KAFKA_FAIL_ON_DATA_LOSS": "fail_on_data_loss",
    "MAX_OFFSETS_PER_TRIGGER": "max_offsets_per_trigger",
    "EXTRA_PAYLOAD": "extra_payload",
    "RAW_PATH": "raw_path",
    "RAW_MAX_FILE_AGE": "raw_max_file_age",
    "MAX_FILES_PER_TRIGGER": "max_files_per_trigger",
    "MAX_TABLE_FILES_PER_TRIGGER": "max_table_files_per_trigger",
    "TABLE_STREAM_DAYS": "table_stream_days",
    "HIVE_METASTORE_URI": "hive_metastore_uri",
    "WAREHOUSE_PATH": "warehouse",
    "CHECKPOINT_PATH": "checkpoints",
    "TABLE_FORMAT": "table_format",
    "CATALOG_DATABASE": "database",
    "BRONZE_TRIGGER_INTERVAL": "bronze_trigger",
    "SILVER_TRIGGER_INTERVAL": "silver_trigger",
    "GOLD_TRIGGER_INTERVAL": "gold_trigger",
    "SPEED_MIN_KMH": "speed_min",
    "SPEED_MAX_KMH": "speed_max",
    "LATE_EVENT_MINUTES": "late_minutes",
    "FUTURE_EVENT_MINUTES": "future_minutes",
    "EVENT_CLOCK": "clock",
}


@dataclass(frozen=True)
class Settings:
    """Every tunable of the pipeline, with its default."""

    master: str | None = None  # None: whatever spark-submit was given
    shuffle_partitions: int | None = None  # None: the cluster's own value; AQE coalesces
    log_level: str = "WARN"

    kafka_servers: str = "kafka:9092"
    kafka_topic: str = "traffic-topic"
    starting_offsets: str = "earliest"  # of the first start; afterwards the checkpoint holds them
    kafka_min_partitions: int | None = None  # read a topic with more tasks than partitions
    fail_on_data_loss: str = "true"  # "false" goes on where expired messages are lost
    # Duplicates are judged within a micro-batch, so every limit on its size also sets how far
    # apart two copies may be to reject each other; the fact merge stops those further apart.
    max_offsets_per_trigger: int | None = None
    # Keys of the payload beyond the declared ones, separated by commas. Their values are kept as
    # text in bronze, silver and quarantine; tables that lack the columns get them.
    extra_payload: str | None = None
    raw_path: str | None = None  # set: read envelope files from here instead of Kafka
    raw_max_file_age: str = "36500d"  # files older than the newest by more than this are skipped
    max_files_per_trigger: int | None = None  # of the raw files
    max_table_files_per_trigger: int | None = None  # of the bronze or silver table
    # Silver and gold list, at every trigger, the days of arrival from the first one that is not
    # finished when they start, and at least this many before the newest. None: all days.
    table_stream_days: int | None = None

    hive_metastore_uri: str | None = None
    warehouse: str | None = None  # a folder that every executor reaches; jobs need it
    checkpoints: str | None = None  # None: a folder of the warehouse
    table_format: str = "parquet"  # or "delta" when the connector is installed
    database: str = "mobility"

    bronze_trigger: str = "10 seconds"
    silver_trigger: str = "15 seconds"
    gold_trigger: str = "30 seconds"

    speed_min: int = 0
    speed_max: int = 160
    late_minutes: int = 20
    future_minutes: int = 10
    clock: str = "arrival"  # "arrival": kafka_timestamp of the row; "now": wall clock

    def __post_init__(self):
        if self.clock not in ("arrival", "now"):
            raise ValueError(f"unknown clock {self.clock!r}: arrival or now")
        taken = [n for n in self.extra_columns.names if n in {*SILVER.names, *REJECTS.names, "corrupt"}]
        if taken:
            raise ValueError(f"extra payload keys have to be new: {', '.join(taken)}")
        if self.table_format not in ("parquet", "delta"):
            raise ValueError(f"unknown table_format {self.table_format!r}: parquet or delta")

    @classmethod
    def from_env(cls, environ: Mapping[str, str] = os.environ) -> Settings:
        """Defaults overridden by the variables that are set and not empty."""
        numeric = {f.name for f in fields(cls) if "int" in f.type}
        given = {
            setting: int(environ[name]) if setting in numeric else environ[name]
            for name, setting in ENVIRONMENT.items()
            if environ.get(name)
        }
        return cls(**given)

    @property
    def extra_columns(self) -> StructType:
        """The columns that ``extra_payload`` names."""
        names = [name.strip() for name in (self.extra_payload or "").split(",")]
        columns = StructType()
        for name in filter(None, names):
            columns.add(name, "string")
        return columns

    def table_path(self, table: str) -> str:
        if not self.warehouse:
            raise ValueError("no warehouse: set WAREHOUSE_PATH to a folder that all machines share")
        return f"{self.warehouse}/{table}"

    def checkpoint_path(self, job: str) -> str:
        return f"{self.checkpoints or self.table_path('chk')}/{job}"
