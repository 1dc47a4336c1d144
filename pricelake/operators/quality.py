"""Data checks. Each returns rows ``(table_name, check_name, column_name, failing_rows, passed)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.operators.ranking import newest


def _report(failing: DataFrame, table: str, check: str, column: str | Column) -> DataFrame:
    return failing.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        (F.lit(column) if isinstance(column, str) else column).alias("column_name"),
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
        (F.col("failing_rows") == 0).alias("passed"),
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs of every column counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failing_rows")) for c in columns])
    return _report(counts.select(F.inline(pairs)), table, "not_null", F.col("column_name"))


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list; NULL passes."""
    outside = ~F.col(column).isin(*values)
    return _report(df.agg(F.count_if(outside).alias("failing_rows")), table, "accepted_values", column)


def unique_key(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Key combinations held by more than one row."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("_copies")).where("_copies > 1")
    return _report(repeated.agg(F.count("*").alias("failing_rows")), table, "unique", ",".join(columns))


def same_month(df: DataFrame, table: str, present: str, season: str) -> DataFrame:
    """Rows whose two months differ; a NULL month passes."""
    differs = F.col(present) != F.col(season)
    return _report(df.agg(F.count_if(differs).alias("failing_rows")), table, "same_month", f"{present},{season}")


def not_empty(df: DataFrame, table: str) -> DataFrame:
    """Fails with one failing row when the table holds nothing. The scan stops at the first row."""
    missing = F.when(F.count("*") == 0, 1).otherwise(0).alias("failing_rows")
    return _report(df.limit(1).agg(missing), table, "not_empty", "")


def numeric_text(df: DataFrame, table: str, column: str) -> DataFrame:
    """Texts that a cast to double would lose."""
    lost = F.col(column).isNotNull() & F.col(column).try_cast("double").isNull()
    return _report(df.agg(F.count_if(lost).alias("failing_rows")), table, "numeric", column)


def reconcile_newest(source: DataFrame, model: DataFrame, table: str, date: str = "dt", known: str | None = None) -> DataFrame:
    """The newest date of the source and the model built on it must have equally many rows. ``known`` is that date where the
    caller has it from partition names.

    The two one-row counts are put together by a union and a sum, without a join.
    """
    signed = newest(source, date, known).agg(F.count("*").alias("n")).unionAll(model.agg((-F.count("*")).alias("n")))
    return _report(signed.agg(F.abs(F.sum("n")).alias("failing_rows")), table, "reconcile", date)


def dropped_rows(df: DataFrame, required: str) -> DataFrame:
    """Rows before and after dropping those without ``required``."""
    kept = F.count(F.col(required))
    return df.agg(
        F.count("*").alias("rows_before"), kept.alias("rows_after"), (F.count("*") - kept).alias("rows_dropped")
    )


def all_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, checks)
