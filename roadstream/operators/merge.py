"""Insert-only merge as DataFrame operators: which incoming rows does the target lack?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key(keys):
    return F.struct(*keys).alias("merge_key")


def repeated_keys(rows: DataFrame, keys) -> DataFrame:
    """The keys, NULL keys included, that several rows have."""
    counts = rows.groupBy(_key(keys)).agg(F.count("*").alias("n"))
    return counts.filter("n > 1").select("merge_key")


def one_per_key(rows: DataFrame, keys) -> DataFrame:
    """One row per key, NULL keys included; of several, the smallest, whatever the run.

    Keys are counted first, by hash and without the other columns. Rows whose key occurs once, as
    good as all, pass as they are; only rows of repeated keys are compared, and their minimum
    is combined before the shuffle, so that a hot key is one row per map task.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    repeated = repeated_keys(rows, keys)
    keyed = rows.withColumn("merge_key", _key(keys))
    single = keyed.join(repeated, "merge_key", "left_anti").select(*rows.columns)
    several = keyed.join(repeated, "merge_key", "left_semi")
    least = several.groupBy("merge_key").agg(F.min(F.struct(*rest)).alias("merge_row"))
    return single.union(least.select("merge_key.*", "merge_row.*").select(*rows.columns))


def offer_counts(incoming: DataFrame, target: DataFrame, keys) -> DataFrame:
    """One row: how many keys are offered, and how many of them the target does not hold."""
    keys = list(keys)
    offered = incoming.select(F.struct(*keys).alias("merge_key")).distinct()
    held = target.select(F.struct(*keys).alias("merge_key"), F.lit(1).alias("held"))
    return offered.join(held, "merge_key", "left").agg(
        F.count("*").alias("incoming"), F.count_if(F.col("held").isNull()).alias("new")
    )


def lacking(incoming: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Incoming rows whose key the target does not hold.

    Both sides are matched on a struct of the key columns: two structs are equal when their
    fields are, NULL included, so a rerun inserts nothing even for NULL roads or zones.
    """
    keys = list(keys)
    held = target.select(_key(keys))
    new = incoming.withColumn("merge_key", _key(keys)).join(held, "merge_key", "left_anti")
    return new.select(*incoming.columns)


def rows_to_insert(incoming: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Incoming rows, one per key, whose key the target does not hold. What it holds leaves first.

    ``one_per_key`` uses its rows several times: store or persist ``lacking`` rows in between
    where the incoming ones are costly.
    """
    return one_per_key(lacking(incoming, target, keys), keys)
