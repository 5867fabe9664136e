"""Tables as directories of Parquet, or as Delta tables when that connector is installed.

Both ways to write are safe to repeat: ``insert_new`` adds only rows whose key the table lacks, and
``append`` is given only rows that it lacks (``sources.warehouse.unstored``).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from roadstream.operators.merge import lacking, one_per_key, repeated_keys

# The columns a Parquet table has been given so far, beside its files; Delta keeps them itself.
SCHEMA_FILE = "_schema.json"

# The size Spark aims at for the tasks of a shuffle, and the most that a task is to sort and write.
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SORTED_SIZE = "16m"


@contextmanager
def small_sorts(spark: SparkSession) -> Iterator[None]:
    """Tasks that sort what is written get at most ``SORTED_SIZE`` meanwhile. Rows with their text
    take several times their shuffled size in memory, and larger tasks spill them."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = spark.conf.get(TASK_SIZE)
    if size(before) <= size(SORTED_SIZE):
        yield
        return
    spark.conf.set(TASK_SIZE, SORTED_SIZE)
    try:
        yield
    finally:
        spark.conf.set(TASK_SIZE, before)


def widened(stored: StructType, declared: StructType) -> StructType:
    """The stored columns, then the declared ones that are new. One type a column."""
    for column in declared:
        if column.name in stored.names and stored[column.name].dataType != column.dataType:
            held = stored[column.name].dataType.simpleString()
            wanted = column.dataType.simpleString()
            raise ValueError(f"column {column.name} is stored as {held}, not {wanted}")
    return StructType([*stored.fields, *[c for c in declared if c.name not in stored.names]])


@dataclass(frozen=True)
class Table:
    """A table directory.

    Rows are sorted by ``sort_by`` within each file, for readers that filter on it. ``day_of`` is
    the time column whose date, not a column of the schema, partitions the table.
    """

    spark: SparkSession
    path: str
    schema: StructType
    format: str = "parquet"
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    day_of: str | None = None

    @property
    def stored_schema(self) -> StructType:
        """The schema with the partition columns that are not part of it."""
        extra = [StructField(c, DateType()) for c in self.partition_by if c not in self.schema.names]
        return StructType([*self.schema.fields, *extra])

    def _hadoop(self, location: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self) -> bool:
        """Whether the table has been created."""
        if self.format == "delta":
            from delta.tables import DeltaTable  # optional connector

            return DeltaTable.isDeltaTable(self.spark, self.path)
        files, path = self._hadoop(self.path)
        return files.exists(path)

    def create(self) -> None:
        """Make an empty table unless there is one, so that streams and views can start on it; a
        table that lacks declared columns gets them."""
        if self.format == "delta":
            if not self.exists():
                self._append(self.spark.createDataFrame([], self.stored_schema))
        else:
            files, path = self._hadoop(self.path)
            files.mkdirs(path)
            self.widen()

    def columns(self) -> StructType:
        """All columns the table has been given, by this job or others."""
        if self.format == "delta":
            return self.spark.read.format("delta").load(self.path).schema
        files, path = self._hadoop(f"{self.path}/{SCHEMA_FILE}")
        if not files.exists(path):
            return self.schema
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return StructType.fromJson(json.loads(text))

    def widen(self) -> StructType:
        """Add the declared columns that the table lacks; all of its columns afterwards.

        Files written before have NULL there. Columns that only others declared stay, with NULL
        in the rows of this job. A column of another type is an error, before anything is
        written. Delta tables are widened by the append itself.
        """
        stored = self.columns()
        columns = widened(stored, self.schema)
        files, path = self._hadoop(f"{self.path}/{SCHEMA_FILE}")
        if columns != stored or not files.exists(path):
            stream = files.create(path, True)
            try:
                stream.write(bytearray(columns.json().encode()))
            finally:
                stream.close()
        return columns

    def read(self) -> DataFrame:
        """All rows; none when the table does not exist yet."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.format(self.format)
        if self.format != "delta":
            reader = reader.schema(self.stored_schema)
        return reader.load(self.path).select(*self.schema.names)

    def read_placed(self) -> DataFrame:
        """All rows with the columns that partition the table, also those not in the schema."""
        if self.format == "delta" or not self.exists():
            return self.read() if self.exists() else self.spark.createDataFrame([], self.stored_schema)
        return self.spark.read.schema(self.stored_schema).parquet(self.path)

    def read_days(self, days: Iterable[date]) -> DataFrame:
        """Rows of some days of a table partitioned by day.

        Only the directories of those days are listed, however many the table has.
        """
        if self.format == "delta":
            return self.read().filter(F.col(self.partition_by[0]).isin(list(days)))
        wanted = ",".join(day.isoformat() for day in days)
        pattern = f"{self.path}/{self.partition_by[0]}={{{wanted}}}"
        files, path = self._hadoop(pattern)
        if not files.globStatus(path):
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.stored_schema).option("basePath", self.path)
        return reader.parquet(pattern).select(*self.schema.names)

    def insert_new(
        self, incoming: DataFrame, keys, target: DataFrame | None = None, within: str = ""
    ) -> int:
        """Add the incoming rows whose key the table lacks; how many were added.

        ``target`` is the part of the table that can hold those keys, if not all of it, and
        ``within`` the same as a condition on a Delta table called ``held``. A repeated or
        half-finished write is completed by running it again.
        """
        if self.format == "delta":
            return self._merge_delta(incoming, keys, within)
        target = self.read() if target is None else target
        if target.isEmpty():
            return self._append_one_per_key(incoming, keys)
        # The incoming rows and the target are read once; what is new, once and for all steps.
        new = lacking(incoming, target, keys).persist()
        try:
            return self._append_one_per_key(new, keys)
        finally:
            new.unpersist()

    def _append_one_per_key(self, rows: DataFrame, keys) -> int:
        # Most batches repeat no key. The keys alone tell, and no full row is dealt out for it.
        if not repeated_keys(rows, keys).isEmpty():
            rows = one_per_key(rows, keys)
        return self.append(rows.select(*self.schema.names))

    def append(
        self, rows: DataFrame, finish: Callable[[DataFrame], DataFrame] | None = None, **options
    ) -> int:
        """Add rows: few files per partition value, each sorted. How many were added, as counted
        by the tasks that write them. ``finish`` is a projection that adds columns to the sorted
        rows, which are dealt out and sorted without them."""
        added = Observation()
        if self.day_of:
            rows = rows.withColumn(self.partition_by[0], F.to_date(self.day_of))
        if self.format != "delta":
            if self.partition_by:
                # AQE splits a value that holds much.
                rows = rows.hint("rebalance", *self.partition_by)
        rows = rows.observe(added, F.count("*").alias("rows"))
        if self.format == "delta":
            options.setdefault("mergeSchema", "true")
        elif self.partition_by or self.sort_by:
            # The write sorts by partition anyway; this is the same sort, with more columns.
            rows = rows.sortWithinPartitions(*self.partition_by, *self.sort_by)
        if finish:
            placed = [c for c in self.partition_by if c not in self.schema.names]
            rows = finish(rows).select(*self.schema.names, *placed)
        with small_sorts(rows.sparkSession):
            self._append(rows, **options)
        return added.get["rows"]

    def _append(self, rows: DataFrame, **options) -> None:
        writer = rows.write.format(self.format).mode("append").options(**options)
        writer.partitionBy(*self.partition_by).save(self.path)

    def _merge_delta(self, incoming: DataFrame, keys, within: str) -> int:
        from delta.tables import DeltaTable  # optional connector

        self.create()
        source = one_per_key(incoming, keys).select(*self.schema.names)
        match = " AND ".join([f"held.{key} <=> new.{key}" for key in keys] + [within] * bool(within))
        table = DeltaTable.forPath(self.spark, self.path)
        merge = table.alias("held").merge(source.alias("new"), match).whenNotMatchedInsertAll()
        result = merge.execute()  # newer connectors return the counts of this very merge
        if result is None:
            metrics = table.history(1).select("operationMetrics.numTargetRowsInserted").first()
            return int(metrics[0] or 0)
        return int(result.first()["num_inserted_rows"] or 0)
