"""The tables and views of a warehouse, registered in the session's catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from roadstream.plans import views
from roadstream.schemas import BI_CONTRACTS
from roadstream.settings import Settings
from roadstream.sources.tables import Table
from roadstream.sources.warehouse import LAYOUT, warehouse_tables

REGISTERED = ("fact_traffic", "dim_zone", "dim_road", "traffic_rejects")


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database unless it is there."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def _declared(columns) -> str:
    return ", ".join(f"{column.name} {column.dataType.simpleString()}" for column in columns)


def register_table(spark: SparkSession, name: str, table: Table) -> None:
    """Register a table directory under ``name``; its rows stay where they are. If it is registered
    already, columns that it has been given since are added."""
    table.create()
    if table.format == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING delta LOCATION '{table.path}'")
        return
    columns = table.columns()
    held = [c for c in table.stored_schema if c.name not in table.schema.names]  # partitions
    by = f"PARTITIONED BY ({', '.join(table.partition_by)}) " if table.partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_declared([*columns, *held])}) USING parquet "
        f"{by}LOCATION '{table.path}'"
    )
    shown = spark.table(name).columns
    new = [column for column in columns if column.name not in shown]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_declared(new)})")
    refresh_table(spark, name, table)


def refresh_table(spark: SparkSession, name: str, table: Table) -> None:
    """Make files and partitions written since registration visible."""
    if table.partition_by:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def show_new_rows(settings: Settings, name: str, table: Table, days) -> None:
    """Make rows just written visible in the catalog, if the table is registered there.

    Only the ``days`` written are added, so the cost does not grow with the table; all of them
    if the days are not known (None). Delta tables need nothing.
    """
    spark, full = table.spark, f"{settings.database}.{name}"
    if table.format == "delta" or not spark.catalog.tableExists(full):
        return
    if days is None:
        refresh_table(spark, full, table)
        return
    if table.partition_by and days:
        column = table.partition_by[0]
        parts = " ".join(f"PARTITION ({column} = DATE'{day}')" for day in sorted(days))
        spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(full)


def show_new_columns(settings: Settings, name: str, table: Table) -> None:
    """Show columns that a registered table has been given, in the catalog and in the views."""
    spark, full = table.spark, f"{settings.database}.{name}"
    if not spark.catalog.tableExists(full):
        return
    if set(table.columns().names) - set(spark.table(full).columns):
        register_table(spark, full, table)
        register_views(spark, settings.database)


def refresh_warehouse(spark: SparkSession, settings: Settings) -> None:
    """Refresh every registered table. Delta tables need none."""
    if settings.table_format != "delta":
        tables = warehouse_tables(spark, settings)
        for name in REGISTERED:
            refresh_table(spark, f"{settings.database}.{name}", tables[name])


def register_views(spark: SparkSession, database: str) -> None:
    """Make, or make anew, the cast contracts and the views. Contracts end with the columns that
    their tables have been given beyond the declared ones."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)  # view texts name their inputs bare
    try:
        for name, (source, _) in BI_CONTRACTS.items():
            known = {*LAYOUT[source]["schema"].names, *LAYOUT[source].get("partition_by", ())}
            extra = [c for c in spark.table(source).columns if c not in known]
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {views.contract_sql(name, extra)}")
        for name in views.VIEWS:
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {views.view_sql(name)}")
    finally:
        spark.catalog.setCurrentDatabase(before)


def register_warehouse(
    spark: SparkSession, settings: Settings, location: str | None = None
) -> None:
    """Register the database, its four tables, the cast contracts and the views."""
    create_database(spark, settings.database, location)
    tables = warehouse_tables(spark, settings)
    for name in REGISTERED:
        register_table(spark, f"{settings.database}.{name}", tables[name])
    register_views(spark, settings.database)


def verification_counts(spark: SparkSession, database: str) -> DataFrame:
    """How many rows each registered table holds."""
    counts = [
        spark.table(f"{database}.{name}").selectExpr(
            f"'{name}' AS table_name", "count(*) AS row_count"
        )
        for name in REGISTERED
    ]
    return reduce(DataFrame.unionByName, counts)
