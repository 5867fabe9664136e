"""Duplicate detection: every copy of a repeated key is rejected, none is kept.

The copies of a key are counted by a plain aggregation over the two key columns, which
Spark combines before the shuffle, so a key that holds a third of the rows is one row per
map task there. Only then do the counts meet the full rows, and there no key may fill a task,
however many keys are hot:

* keys are hashed into ``BUCKETS`` buckets, and a bucket gets as many slots as it holds times the
  average number of rows of a bucket, so all slots together are at most twice the buckets;
* a row goes to one of its bucket's slots by a hash of the whole row, and the repeated keys of the
  bucket are there in each of its slots.

The slots of the buckets are the only thing broadcast, at most ``BUCKETS`` rows of two numbers.

The repeated keys are repartitioned after the ``copies > 1`` filter. Their size is therefore known
to the adaptive planner: when they fit its broadcast limit, the rows need not be shuffled. It may
deal out the rows meanwhile, so a job passes ``keep``, which stores slots and repeated keys: then they
are counted before any full row moves, and are there for every use. They can be found in rows that
have little more than the keys, and label the full ones.

The keys of the counted rows must not be NULL; the quality rules guarantee that for clean
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.operators.quality import DUPLICATE_EVENT, OK, is_clean
from roadstream.schemas import BRONZE, DUPLICATE_KEY

BUCKETS = 4096

# Repeated keys that are broadcast once they are stored and counted: about 100 MB as a hash table.
BROADCAST_KEYS = 1_000_000


def _bucket(keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def key_counts(rows: DataFrame, keys=DUPLICATE_KEY) -> DataFrame:
    """How often each key occurs, with its bucket."""
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    counts = rows.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counts.withColumn("bucket", _bucket(keys))


def bucket_slots(counts: DataFrame) -> DataFrame:
    """How many slots each bucket gets: its rows over the average of all buckets, rounded up."""
    load = counts.groupBy("bucket").agg(F.sum("copies").alias("load"))
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    share = F.col("load") / F.sum("load").over(everything)  # a window over the buckets
    slots = load.select("bucket", F.ceil(share * BUCKETS).cast("int").alias("slots"))
    return F.broadcast(slots)


# Stores small rows that are used more than once, and gives them back.
Keep = Callable[[DataFrame], DataFrame]


class Repeated(NamedTuple):
    """The slots of the buckets, the repeated keys in each of them, and whether these are known to
    be few enough to be broadcast."""

    slots: DataFrame
    keys: DataFrame
    few: bool


def find_repeated(
    rows: DataFrame, among: Column, keys=DUPLICATE_KEY, keep: Keep | None = None
) -> Repeated:
    """What labels the copies of repeated keys, found over the rows where ``among``."""
    counts = key_counts(rows.filter(among), keys)
    slots = bucket_slots(counts)
    if keep:
        slots = F.broadcast(keep(slots))
    every_slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1))
    repeated = (
        counts.filter(F.col("copies") > 1)
        .join(slots, "bucket")
        .select(*keys, F.col("copies").alias("found"), every_slot.alias("slot"))
        .repartition(*keys, "slot")
    )
    if keep:
        repeated = keep(repeated)
        if repeated.count() <= BROADCAST_KEYS:
            return Repeated(slots, F.broadcast(repeated), True)
    return Repeated(slots, repeated, False)


def _with_copies(rows: DataFrame, among: Column, keys, repeated: Repeated) -> DataFrame:
    """``rows`` with ``found``: the copies of a repeated key, NULL for every other row."""
    slots = repeated.slots
    own = F.xxhash64(F.spark_partition_id(), *rows.columns)
    placed = rows.withColumn("bucket", F.when(among, _bucket(keys))).join(slots, "bucket", "left")
    # Rows outside the count need no partner; numbers below zero spread them and match nothing.
    slot = F.coalesce(F.pmod(own, F.col("slots")), -1 - F.pmod(own, F.lit(1 << 30))).cast("int")
    return placed.withColumn("slot", slot).join(repeated.keys, [*keys, "slot"], "left")


def count_copies(
    df: DataFrame,
    among: Column | None = None,
    keys=DUPLICATE_KEY,
    keep: Keep | None = None,
    repeated: Repeated | None = None,
) -> DataFrame:
    """Add ``copies``: how many rows share this row's key, counted over rows where ``among``.

    Rows outside ``among`` get 1. ``repeated`` are its repeated keys, where they are known.
    """
    among = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    counted = _with_copies(df, among, keys, repeated or find_repeated(df, among, keys, keep))
    return counted.select(*df.columns, F.coalesce("found", F.lit(1)).cast("long").alias("copies"))


def drop_repeated(
    rows: DataFrame, keys=DUPLICATE_KEY, repeated: Repeated | None = None
) -> DataFrame:
    """Rows whose key occurs once."""
    among = F.lit(True)
    repeated = repeated or find_repeated(rows, among, keys)
    return _with_copies(rows, among, keys, repeated).filter("found IS NULL").select(*rows.columns)


def label_duplicates(
    checked: DataFrame, keep: Keep | None = None, repeated: Repeated | None = None
) -> DataFrame:
    """Turn the reason of every copy of a repeated clean row into DUPLICATE_EVENT."""
    counted = count_copies(checked, is_clean(), keep=keep, repeated=repeated)
    reason = F.when(F.col("copies") > 1, DUPLICATE_EVENT).otherwise(F.col("reject_reason"))
    return counted.withColumn("reject_reason", reason).drop("copies")


def duplicate_events(labelled: DataFrame) -> DataFrame:
    """Every copy of a repeated clean row, of rows that label_duplicates has labelled."""
    return labelled.filter(F.col("reject_reason") == DUPLICATE_EVENT)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Rows that fail a rule."""
    return checked.filter(F.col("reject_reason") != OK)


def stamp_rejects(
    rejected: DataFrame, rejected_at: Column | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Rejected rows in the shape of the quarantine table, with ``extra`` columns."""
    stamp = F.current_timestamp() if rejected_at is None else rejected_at
    verdict = ["dq_flag", "speed_int", "event_ts", "speed_valid", "time_valid", "reject_reason"]
    kept = [c for c in BRONZE.names if c in rejected.columns]
    return rejected.select(*kept, *verdict, stamp.alias("rejected_at"), *extra)

