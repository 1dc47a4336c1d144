"""Declared tables and CSV dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.fixed import REGIONS
from pricelake.functions import pad_codes
from pricelake.schemas import COORDINATES, PRODUCTS, SEASONS, silver_read_schema
from pricelake.session import shuffles_removed, work_path

#: Quotes are doubled inside quotes, as CSV writers do; Spark's own default is a backslash.
CSV_DIALECT = {"quote": '"', "escape": '"'}


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with declared columns; a missing path is an empty frame ("no history yet")."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_stored(spark: SparkSession, path: str, like: T.StructType, partitions: Sequence[str] = ()) -> DataFrame:
    """Parquet with all columns any of its files has, partition columns as strings; a missing path is an empty frame
    with the columns of ``like``."""
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], like)
    data = [f for f in found.fields if f.name not in partitions]
    return spark.read.schema(T.StructType([*data, *[T.StructField(p, T.StringType()) for p in partitions]])).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write rows once to the shared folder and go on from there, where a plan needs them more than
    once and their making (parsing JSON) costs more than reading Parquet. A lost executor re-reads
    files instead of parsing again."""
    path = work_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def newest_partition(spark: SparkSession, table: str, column: str = "dt") -> str | None:
    """Largest value of a partition column of a registered table, from its partition list; no file is opened. None without one."""
    names = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    return names.select(F.max(F.when(value != "__HIVE_DEFAULT_PARTITION__", value))).first()[0]


def read_silver(spark: SparkSession, path: str, table: str) -> DataFrame:
    return read_parquet(spark, path, silver_read_schema(table))


def silver(spark: SparkSession, table: str, database: str = "silver") -> DataFrame:
    """A registered silver table by name."""
    return spark.table(f"{database}.{table}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with declared types; codes stay text, so leading zeros live. A quoted text may hold quotes
    (doubled), commas and line breaks."""
    return spark.read.schema(schema).options(header=True, enforceSchema=False, multiLine=True, **CSV_DIALECT).csv(path)


def seasons(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SEASONS)


def products(spark: SparkSession, path: str) -> DataFrame:
    return pad_codes(read_csv(spark, path, PRODUCTS))


def coordinates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Region coordinates: a CSV, or the fixed list of 24."""
    if path:
        return read_csv(spark, path, COORDINATES)
    rows = [(code, *place) for code, place in REGIONS.items()]
    return F.broadcast(spark.createDataFrame(rows, COORDINATES))
