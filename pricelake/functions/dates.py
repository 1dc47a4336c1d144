"""Date parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.fixed import UNKNOWN_WEEKDAY, WEEKDAY_NAMES
from pricelake.functions.padding import padded, strip


#: Texts a cast reads as the pattern ``yyyy-MM-dd`` does, at a fraction of its cost.
_YEAR = r"[1-9][0-9]{3}"
_DAY = rf"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}}\z"


def try_iso_date(value: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE, NULL when it does not parse."""
    text = value.cast("string")
    return F.when(text.rlike(_DAY), text.try_cast("date")).otherwise(F.try_to_date(value, "yyyy-MM-dd"))


def landing_date(value: Column) -> Column:
    """Date of a landing folder, which is written with dashes or without; NULL when it is neither."""
    return F.coalesce(try_iso_date(value), F.try_to_date(value, "yyyyMMdd"))


def compact_date(value: Column) -> Column:
    """``2025-12-11`` -> ``20251211``; takes DATE or text."""
    return F.replace(value.cast("string"), F.lit("-"), F.lit(""))


def date_from_parts(year: Column, month_day: Column) -> Column:
    """DATE from a year and ``MM/dd`` text; NULL without exactly one slash or when no such day exists.

    Texts of the usual width go by a cast: the parts of others are split off and filled anew in every branch below."""
    usual = year.cast("string").rlike(rf"^{_YEAR}\z") & month_day.rlike(r"^[0-9]{2}/[0-9]{2}\z")
    common = F.concat_ws("-", year.cast("string"), F.replace(month_day, F.lit("/"), F.lit("-"))).try_cast("date")
    parts = F.split(strip(month_day), "/")
    text = F.concat_ws("-", year.cast("string"), padded(F.get(parts, F.lit(0))), padded(F.get(parts, F.lit(1))))
    return F.when(usual, common).when((F.size(parts) == 2) & year.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def add_date_features(df: DataFrame, column: str) -> DataFrame:
    """Parse ``column`` to DATE, unless it is one, and add year, month, ISO week and weekday columns.

    A frame without the column is returned as it is. The ISO week stands beside the
    calendar year: 2025-12-29 is week 1 with year 2025.
    """
    if column not in df.columns:
        return df
    day = F.col(column)
    number = F.weekday(day)
    names = F.array(*[F.lit(name) for name in WEEKDAY_NAMES])
    is_date = isinstance(df.schema[column].dataType, T.DateType)
    dated = df if is_date else df.withColumn(column, try_iso_date(day))
    return dated.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "week_of_year": F.weekofyear(day),
            "weekday_num": number,
            "weekday_nm": F.coalesce(F.get(names, number), F.lit(UNKNOWN_WEEKDAY)),
            "weekend_yn": F.coalesce(number >= 5, F.lit(False)),
        }
    )
