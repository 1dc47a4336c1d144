"""Ranks over groups and dates that hold for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.lookup import lookup_join
from pricelake.session import work_path
from pricelake.sources.tables import staged

# Copies of one row are expanded in runs of this many.
RUN = 100_000


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str) -> DataFrame:
    """First ``k`` rows of each group with their row number.

    Spark trims each map task to ``k`` rows per group before the shuffle, so a group's
    size does not matter.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``row_number()`` of every row of its group, without gathering a group in one task.

    Equal rows are counted first, distinct rows are range-partitioned by group and order
    and written once to the shared folder (their partition number must not change between the
    two reads), then the rank is the number of rows in earlier partitions of the group plus
    the running number inside the partition. ``order`` must order distinct rows totally.
    """
    spark = df.sparkSession
    columns = df.columns
    path = work_path(spark, "ranges")
    keys = [F.col(c).asc_nulls_last() for c in group]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    counted.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)

    ranges = spark.read.parquet(path)
    # NULL is a group of its own: joined through a key that is never NULL.
    ranges = ranges.withColumn("_group", F.to_json(F.struct(*group), {"ignoreNullFields": "false"}))
    per_range = ranges.groupBy("_group", "_range").agg(F.sum("_copies").alias("_in_range"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each group and range, written once, so that it is measured and joined without being made again.
    offsets = staged(
        per_range.select("_group", "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_before")),
        "offsets",
    )
    inside = Window.partitionBy("_group", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = lookup_join(
        ranges.withColumn("_until", F.sum("_copies").over(inside)), offsets, ["_group", "_range"], "inner"
    )
    first = F.col("_before") + F.col("_until") - F.col("_copies")
    runs = numbered.select(
        *columns,
        first.alias("_first"),
        "_copies",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / RUN))).alias("_run"),
    )
    offset_in_run = F.sequence(F.col("_run") * RUN + 1, F.least((F.col("_run") + 1) * RUN, F.col("_copies")))
    return runs.select(*columns, "_first", F.explode(offset_in_run).alias("_nth")).select(
        *columns, (F.col("_first") + F.col("_nth")).alias(name)
    )


def rank_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """``rank() OVER (ORDER BY column DESC)`` for a column of few values, such as a date.

    Rows are counted per value and the running sum is taken over values. The ranks, a row a value, are written out; while they measure
    small they go to the rows, which stay where they are. NULL ranks last, as one value.
    """
    key = F.coalesce(F.col(column).cast("string"), F.lit("\x00"))
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    above = Window.orderBy(F.col(column).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(key.alias("_key"), (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(name))
    return lookup_join(df.withColumn("_key", key), staged(ranks, "ranks"), ["_key"]).drop("_key")


def newest(df: DataFrame, column: str, known: str | None = None) -> DataFrame:
    """Rows holding the maximum of ``column``, i.e. those of rank 1 by it.

    ``known`` is the maximum where the caller has it, from partition names: then one partition is read and nothing else.
    Otherwise a scalar maximum prunes partitions and needs no sort. The null-safe comparison keeps a table
    whose every value is NULL, where all rows tie.
    """
    if known is not None:
        return df.where(F.col(column) == known)
    return df.where(df[column].eqNullSafe(df.agg(F.max(column)).scalar()))
