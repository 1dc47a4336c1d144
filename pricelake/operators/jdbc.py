"""Publication of marts to a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column type of the target database for each Spark type.
COLUMN_TYPES = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.ByteType: "SMALLINT",
    T.DoubleType: "DOUBLE PRECISION",
    T.FloatType: "REAL",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
    T.DateType: "DATE",
    T.BooleanType: "BOOLEAN",
}


def column_type(kind: T.DataType) -> str:
    """Target type of a column; anything flat and not listed is TEXT, nested types are refused."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise TypeError(f"a mart column cannot be {kind.simpleString()}")
    return COLUMN_TYPES.get(type(kind), "TEXT")


def column_types(schema: T.StructType) -> str:
    """Column list for the writer, which creates a missing table with these types."""
    return ", ".join(f"`{f.name}` {column_type(f.dataType)}" for f in schema.fields)


def publish(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, writers: int = 8) -> None:
    """Full load: create the table if it is missing, else empty it, then insert in parallel batches.

    Each task commits its own rows, so a failed load leaves the table part-filled and must be
    run again; an empty mart empties its table. Empty texts stay empty texts. Where readers must never see a part-filled
    table, publish to a staging table and swap the names in one transaction of the database.
    """
    options = {"batchsize": "10000", "isolationLevel": "READ_COMMITTED", **(properties or {})}
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=table, truncate="true", createTableColumnTypes=column_types(df.schema), numPartitions=str(writers), **options)
        .save()
    )


def publish_marts(spark: SparkSession, gold_root: str, marts: list[str], url: str, schema: str = "mart", **options) -> None:
    """Load each mart folder below ``gold_root`` into ``schema``."""
    for mart in marts:
        publish(spark.read.parquet(f"{gold_root}/{mart}"), url, f"{schema}.{mart}", **options)
