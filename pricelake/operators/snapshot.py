"""Stamping of a batch with its snapshot date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import compact_date, padded
from pricelake.functions.dates import landing_date
from pricelake.operators.lookup import lookup_join


def stamp_snapshot(df: DataFrame, batch: str = "batch", position: tuple[str, ...] = ("file_path", "pos")) -> DataFrame:
    """Replace year and month and add dt from the response date of each batch's first dated row."""
    return with_snapshot(df, batch_dates(df, batch, position), batch)


def batch_dates(df: DataFrame, batch: str = "batch", position: tuple[str, ...] = ("file_path", "pos")) -> DataFrame:
    """Snapshot date of each batch: the response date of its first row that has one, by path and position.

    The minimum is combined on the map side. A batch without a dated row has no date.
    """
    first = F.min_by("res_dt", F.struct(*position))
    return df.where("res_dt IS NOT NULL").groupBy(batch).agg(first.alias("_snapshot"))


def with_snapshot(df: DataFrame, dates: DataFrame, batch: str = "batch", stored: bool = False) -> DataFrame:
    """Year, month and dt from the date of each row's batch, in place of its own.

    The whole batch gets one date on purpose: a product last surveyed earlier stays part of
    the newest snapshot. A batch without a dated row takes its landing date, which is what ``batch`` holds.
    """
    stamped = lookup_join(df.drop("year", "month", "dt"), dates, [batch], stored=stored)
    day = F.coalesce(F.col("_snapshot"), landing_date(F.col(batch).cast("string")))
    return stamped.withColumns(
        {
            "year": F.year(day).cast("string"),
            "month": padded(F.month(day).cast("string")),
            "dt": compact_date(day),
        }
    ).drop("_snapshot")


def month_partitions(df: DataFrame, day: str = "res_dt") -> DataFrame:
    """String year and month partition columns from each row's own date."""
    return df.withColumns(
        {"year": F.year(day).cast("string"), "month": padded(F.month(day).cast("string"))}
    )
