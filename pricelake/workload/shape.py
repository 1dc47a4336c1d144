"""Result columns in types both engines print alike: whole numbers as BIGINT, dates as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
