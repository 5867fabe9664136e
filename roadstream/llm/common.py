"""Helpers that the operators of this package share."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The named columns (all by default) as one struct, so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in (columns or df.columns)]).alias(ROW)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows: a batch may hold 10,000 long texts, and Python should
    have only some of them as objects at a time."""
    for batch in batches:
        size = batch.num_rows if isinstance(batch, pa.RecordBatch) else len(batch)
        for at in range(0, size, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Let Spark hand Python a few megabytes at a time. Whole batches of 10,000 texts are held at
    both ends, by every task, in memory that neither end gives back."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def id_hash(doc_id: Column) -> Column:
    """The number that deals rows into learning and held-out rows."""
    return F.crc32(doc_id.cast("string"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for files all executors share (spark.checkpoint.dir).
    A folder of our own is taken only where the setting is absent and all tasks run in this
    process, as in local tests; a cluster that names none is an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-checkpoints-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` read back from the shared checkpoint folder, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table of Parquet files in the shared folder, of which later readers take only
    the columns they need; and the table's folder, for ``discard``."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, n: str, most: int = 1000) -> DataFrame:
    """``rows`` with the columns of their group, null keys being a group of their own.

    ``groups`` has one row for each key of ``rows`` and its number of rows, ``n``. Groups that
    hold one row in ``most`` or more, of which there are at most ``most``, are broadcast; the
    rows of the others are shuffled by key, where none is large. So no key fills a task.
    ``rows`` and ``groups`` are used several times and should be stored.
    """
    total = groups.agg(F.sum(n)).first()[0] or 0
    named = groups.withColumnRenamed(key, "__key")
    large = F.broadcast(named.where(F.col(n) * most >= total))
    small = named.where(F.col(n) * most < total)
    same = F.col(key).eqNullSafe(F.col("__key"))
    of_large = rows.join(large, same, "inner")
    of_small = rows.join(large, same, "left_anti").join(small, same, "inner")
    return of_large.unionByName(of_small).drop("__key")


def is_finite_vector(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    infinite = F.lit(float("inf"))
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < infinite),
    )
    return F.coalesce(fine, F.lit(False))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, exactly, for a power of two as scale: as doubles, or as
    Python integers where a product is beyond the range of doubles."""
    with np.errstate(over="ignore"):
        made = np.floor(values.astype(np.float64) * scale)
    if np.isfinite(made).all():
        return made
    flat = [math.floor(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    return as_integers(np.array(flat, dtype=object).reshape(values.shape))


def as_integers(values: np.ndarray) -> np.ndarray:
    """Whole numbers of any type as an array of Python integers."""
    made = np.empty(values.size, dtype=object)
    made[:] = [int(x) for x in values.ravel().tolist()]
    return made.reshape(values.shape)


def largest(values: np.ndarray) -> float:
    """The largest absolute value, as a double; infinite beyond their range."""
    if not values.size:
        return 0.0
    if values.dtype != object:
        return float(np.abs(values).max())
    most = max(abs(x) for x in values.ravel().tolist())
    return float(most) if most < 1 << 1000 else math.inf
