"""Declared schemas. Prices are doubles, partition columns are strings."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """``name type`` pairs to a schema; needs no running session, unlike Spark's own reader."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DATE_BLOCK = "res_dt date, week_of_year int, weekday_num int, weekday_nm string, weekend_yn boolean"

API1 = _struct(
    f"{DATE_BLOCK}, product_cls_cd string, product_cls_nm string, category_cd string, category_nm string, "
    "country_cd string, country_nm string, item_nm string, item_cd string, kind_nm string, kind_cd string, "
    "rank_nm string, rank_cd string, unit string, base_dt string, base_pr double, prev_1d_dt string, "
    "prev_1d_pr double, prev_1w_dt string, prev_1w_pr double, prev_2w_dt string, prev_2w_pr double, "
    "prev_1m_dt string, prev_1m_pr double, prev_1y_dt string, prev_1y_pr double, avg_tp string, avg_pr double"
)
API10 = _struct(
    "product_no int, product_cls_cd string, product_cls_nm string, category_cd string, category_nm string, "
    "item_cd string, item_nm string, kind_cd string, kind_nm string, product_cls_unit string, base_dt string, "
    "base_pr double, prev_1d_dt string, prev_1d_pr double, direction_tp string, direction_pct string, "
    "prev_1m_dt string, prev_1m_pr double, prev_1y_dt string, prev_1y_pr double, country_cd string, "
    f"country_nm string, {DATE_BLOCK}"
)
API13 = _struct(
    "product_cls_cd string, product_cls_nm string, category_cd string, category_nm string, item_cd string, "
    "item_nm string, kind_cd string, kind_nm string, product_cls_unit string, rank_cd string, rank_nm string, "
    f"country_cd string, market_nm string, price double, {DATE_BLOCK}"
)
API17 = _struct(
    f"{DATE_BLOCK}, product_no double, product_cls_cd string, product_cls_nm string, product_cls_unit string, "
    "country_cd string, country_nm string, category_cd string, category_nm string, item_cd string, "
    "item_nm string, kind_cd string, kind_nm string, rank_cd string, rank_nm string, market_nm string, price double"
)

MONTH_PARTITIONS = ("year", "month")
SNAPSHOT_PARTITIONS = ("year", "month", "dt")

# Silver table -> (data columns, partition columns).
SILVER = {
    "api1": (API1, SNAPSHOT_PARTITIONS),
    "api10": (API10, SNAPSHOT_PARTITIONS),
    "api13": (API13, MONTH_PARTITIONS),
    "api17": (API17, MONTH_PARTITIONS),
}

COORDINATES = _struct("country_cd string, country_nm string, latitude double, longitude double")
SEASONS = _struct(
    "season string, month int, item_nm string, kind_nm string, product_no double, category_nm string"
)
PRODUCTS = _struct(
    "product_no bigint, product_cls_cd string, product_cls_nm string, product_cls_unit string, "
    "category_cd string, category_nm string, item_cd string, item_nm string, kind_cd string, kind_nm string, "
    "rank_cd string, rank_nm string"
)

# Folder levels of a landed document, outermost first; a feed uses those it has.
LANDING_KEYS = ("dt", "product_cls", "country", "category", "item", "kind", "product_rank")


def silver_read_schema(table: str) -> T.StructType:
    """Data columns followed by the string partition columns."""
    columns, partitions = SILVER[table]
    return T.StructType(list(columns.fields) + [T.StructField(p, T.StringType()) for p in partitions])
