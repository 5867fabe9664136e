"""The whole pipeline over one input, for batch runs and backfills.

``as_of`` defaults to the arrival time of each row, so the result does not depend on when it
is computed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.operators import duplicates, features, ingest, quality, star
from roadstream.settings import Settings

ARRIVAL = "kafka_timestamp"


@dataclass(frozen=True)
class BatchPipeline:
    """Every table of the pipeline over ``messages``, each built when first asked for.

    With a ``folder``, the checked rows and silver are written there once and read back: what
    follows them reads a column-pruned table instead of parsing and deduplicating the messages
    again for every branch of its plan; copies are counted once, over flags and keys alone, and
    the repeated keys stored. Without one, everything stays lazy and nothing is written.
    """

    messages: DataFrame
    settings: Settings = Settings()
    folder: str | None = None

    def _store(self, name: str, rows: DataFrame) -> DataFrame:
        if not self.folder:
            return rows
        path = f"{self.folder}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    @cached_property
    def as_of(self) -> Column:
        if self.settings.clock == "arrival":
            return F.col(ARRIVAL)
        return F.lit(datetime.now(timezone.utc))  # one instant for all tables

    @cached_property
    def bronze(self) -> DataFrame:
        return ingest.bronze_rows(self.messages)

    @cached_property
    def checked(self) -> DataFrame:
        return self._store("checked", quality.check_rows(self.bronze, self.settings, self.as_of))

    @cached_property
    def repeated(self) -> duplicates.Repeated | None:
        """The repeated keys of clean rows, where they are stored for all that need them."""
        if not self.folder:
            return None
        names = iter(("slots", "repeated"))
        return duplicates.find_repeated(
            self.checked, quality.is_clean(), keep=lambda rows: self._store(next(names), rows)
        )

    @cached_property
    def labelled(self) -> DataFrame:
        return duplicates.label_duplicates(self.checked, repeated=self.repeated)

    @cached_property
    def clean(self) -> DataFrame:
        clean = quality.filter_clean_records(self.checked)
        return duplicates.drop_repeated(clean, repeated=self.repeated)

    @cached_property
    def silver(self) -> DataFrame:
        return self._store("silver", features.silver_rows(self.clean))

    @cached_property
    def rejects(self) -> DataFrame:
        return duplicates.stamp_rejects(duplicates.rejected_rows(self.labelled), self.as_of)

    @cached_property
    def dim_zone(self) -> DataFrame:
        return star.dim_zone(self.silver)

    @cached_property
    def dim_road(self) -> DataFrame:
        return star.dim_road(self.silver)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_traffic(self.silver, self.as_of)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fact_traffic": self.fact,
            "dim_zone": self.dim_zone,
            "dim_road": self.dim_road,
            "traffic_rejects": self.rejects,
        }
