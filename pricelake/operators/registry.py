"""Registration of silver tables and an inventory of what is registered."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.sinks import merged_by_date, write_parquet
from pricelake.schemas import MONTH_PARTITIONS, SILVER
from pricelake.sources.landing import NO_VALUE, folder_values

DATABASES = ("silver", "gold", "gold_metadata")
#: Partitions one statement adds; a statement for each costs far more than the partition.
PARTITIONS_A_STATEMENT = 500


def create_databases(spark: SparkSession, root: str, names: tuple[str, ...] = DATABASES) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}.db'")


def register_silver(spark: SparkSession, table: str, location: str, name: str | None = None) -> str:
    """Drop and re-create one external silver table, then find its partitions.

    The product feed has one location per segment; register each under its own name.
    """
    columns, partitions = SILVER[table]
    target = name or f"silver.{table}"
    data = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns.fields)
    keys = ", ".join(f"{p} STRING" for p in partitions)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(
        f"CREATE TABLE {target} ({data}, {keys}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}'"
    )
    sync_partitions(spark, [target])
    return target


def register_files(spark: SparkSession, name: str, location: str) -> str:
    """Register unpartitioned Parquet files with the schema they carry."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return name


def register_all(spark: SparkSession, locations: Mapping[str, str]) -> list[str]:
    return [register_silver(spark, table, location) for table, location in locations.items()]


def sync_partitions(spark: SparkSession, tables: list[str]) -> None:
    """Make partitions written since registration visible; run before the gold build."""
    for table in tables:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def add_partitions(spark: SparkSession, table: str, written: DataFrame, partitions: tuple[str, ...]) -> list[dict[str, str]]:
    """Make the partitions a load wrote visible by name; no other folder is listed. ``written`` has their values, which are few."""
    found = [row.asDict() for row in written.select(*partitions).distinct().collect()]
    for first in range(0, len(found), PARTITIONS_A_STATEMENT):
        named = " ".join(f"PARTITION ({_spec(values)})" for values in found[first : first + PARTITIONS_A_STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {named}")
    return found


def _spec(values: Mapping[str, str | None]) -> str:
    return ", ".join(f"{k} = '{NO_VALUE if v is None else v}'" for k, v in values.items())


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return described.data_type.rstrip("/")


def add_missing_columns(spark: SparkSession, table: str, rows: DataFrame) -> list[str]:
    """Columns of ``rows`` the table lacks, added to its declaration; stored files without them read as NULL."""
    known = {c.lower() for c in spark.table(table).columns}
    new = [f for f in rows.schema.fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    return [f.name for f in new]


def write_version(spark: SparkSession, table: str, incoming: DataFrame, day: str = "res_dt") -> str:
    """The months ``incoming`` touches with its dates replaced, written to a folder of their own below the table; nothing sees it yet.

    Schema and partitions come from the catalog: only the touched months are opened, and no footer to learn the schema.
    """
    add_missing_columns(spark, table, incoming)
    path = f"{table_location(spark, table)}/_version-{uuid.uuid4().hex}"
    write_parquet(merged_by_date(spark.table(table), incoming, day), path, MONTH_PARTITIONS)
    return path


def point_to_version(spark: SparkSession, table: str, version: str) -> None:
    """Let the catalog read each month of a written version from there: the one visible step, and it moves no file."""
    known = {row.partition.replace("=null", f"={NO_VALUE}") for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = ""
    for year in folder_values(spark, version, "year", nulls=True):
        for month in folder_values(spark, f"{version}/year={year}", "month", nulls=True):
            name = f"year={year}/month={month}"
            spec, place = _spec({"year": year, "month": month}), f"'{version}/{name}'"
            if name in known:
                spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {place}")
            else:
                new += f" PARTITION ({spec}) LOCATION {place}"
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS{new}")
    spark.catalog.refreshTable(table)


def swap_months(spark: SparkSession, table: str, incoming: DataFrame, day: str = "res_dt") -> None:
    """``merge_by_date`` for a registered table: the new months are written beside the old ones, then the catalog is pointed to them.

    A load that breaks before the last step leaves the table as it was, and the next run ends its work. Nothing that is read is
    overwritten; ``drop_old_versions`` removes what no month points to any more. Empty input touches nothing.
    """
    point_to_version(spark, table, write_version(spark, table, incoming, day))


def drop_old_versions(spark: SparkSession, table: str) -> list[str]:
    """Remove version folders no partition of the table points to. To be run when no reader of the older state is left."""
    root = table_location(spark, table)
    used = set()
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = _spec(dict(part.split("=", 1) for part in row.partition.split("/")))
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where("col_name = 'Location'").first()
        used |= {part for part in place.data_type.split("/") if part.startswith("_version-")}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_version-*")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in store.globStatus(folder) or [] if s.getPath().getName() not in used]
    for path in old:
        store.delete(path, True)
    return sorted(path.getName() for path in old)


def inventory(spark: SparkSession, databases: list[str]) -> DataFrame:
    """One row per registered table: its database, column count and row count.

    Row counts come from Parquet footers; the tables are counted in one job.
    """
    counted = None
    for database in databases:
        for table in spark.catalog.listTables(database):
            if table.isTemporary:
                continue
            frame = spark.table(f"{database}.{table.name}")
            row = frame.agg(F.count("*").alias("row_count")).select(
                F.lit(database).alias("database_name"),
                F.lit(table.name).alias("table_name"),
                F.lit(len(frame.columns)).cast("bigint").alias("column_count"),
                "row_count",
            )
            counted = row if counted is None else counted.unionAll(row)
    if counted is None:
        return spark.createDataFrame([], "database_name string, table_name string, column_count bigint, row_count bigint")
    return counted
