"""Session builder for the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from roadstream.settings import Settings

# What the results and the stored tables depend on.
TABLE_CONF = {
    # hour(), to_date() and offset-less timestamps all read the session zone.
    "spark.sql.session.timeZone": "UTC",
    # The default, INT96, keeps no minimum and maximum: no row group could be skipped by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# What lets the work grow with the rows alone.
SCALE_CONF = {
    # The adaptive planner takes a hash join over a sort-merge join, and spares the sort of
    # the wide side, only where every build partition has proved to be this small. It ignores
    # a limit below the advisory size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Measured at run time, so wider than the estimate-based default of 10m. With less, larger
    # inputs deal out all full rows to label the copies of a few.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}

SPARK_CONF = {
    **TABLE_CONF,
    **SCALE_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Fewer, fuller output files and reduce tasks rather than one per core.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
}

DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def prepare_session(spark: SparkSession) -> None:
    """Give a session made elsewhere the settings that results and tables depend on, and
    those without which its joins sort and spill full rows."""
    for key, value in {**TABLE_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)


def build_session(app: str, settings: Settings, **more: str) -> SparkSession:
    """A session with the pipeline's settings; ``more`` adds Spark options, dots as ``__``."""
    builder = SparkSession.builder.appName(app)
    if settings.master:
        builder = builder.master(settings.master)
    conf = dict(SPARK_CONF)
    if settings.shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(settings.shuffle_partitions)
    if settings.table_format == "delta":
        conf.update(DELTA_CONF)
    if settings.hive_metastore_uri:
        conf["spark.hadoop.hive.metastore.uris"] = settings.hive_metastore_uri
        builder = builder.enableHiveSupport()
    conf.update({key.replace("__", "."): value for key, value in more.items()})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(settings.log_level)
    return spark
