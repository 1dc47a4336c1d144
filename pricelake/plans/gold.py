"""Gold models. A ``stg``-level model is a plain function; a mart is what gets written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.fixed import CHAIN_CHANNEL, CHAIN_SUFFIX, DROP, KEEP, RISE, TRADITIONAL_CHANNEL
from pricelake.functions import market_category
from pricelake.operators.lookup import lookup_join
from pricelake.operators.ranking import newest, number_within, top_per_group

# Columns of the models, in order.
SNAPSHOT_COLUMNS = (
    "product_no",
    "category_nm",
    "item_nm",
    "kind_nm",
    "product_cls_unit",
    "country_cd",
    "country_nm",
    "res_dt",
    "base_dt",
    "base_pr",
    "prev_1d_dt",
    "prev_1d_pr",
    "prev_1d_dir_tp",
    "prev_1d_dir_pct",
    "prev_1m_dt",
    "prev_1m_pr",
    "prev_1y_dt",
    "prev_1y_pr",
    "dt",
)
CHANGE_COLUMNS = (
    "product_no",
    "category_nm",
    "item_nm",
    "kind_nm",
    "product_cls_unit",
    "country_cd",
    "country_nm",
    "res_dt",
    "base_dt",
    "base_pr",
    "prev_1d_dt",
    "prev_1d_pr",
    "prev_1d_dir_pct",
)
TOP3_COLUMNS = (
    "item_nm",
    "kind_nm",
    "product_cls_unit",
    "country_cd",
    "country_nm",
    "res_dt",
    "base_dt",
    "base_pr",
    "prev_1d_dt",
    "prev_1d_pr",
    "prev_1d_dir_pct",
    "ranking",
)
SEASON_COLUMNS = (
    "product_no",
    "category_nm",
    "item_nm",
    "kind_nm",
    "product_cls_unit",
    "country_nm",
    "latitude",
    "longitude",
    "dt",
    "base_dt",
    "base_pr",
    "prev_1y_dt",
    "prev_1y_pr",
    "present_month",
    "season",
    "season_month",
)


def load_stamp() -> Column:
    return F.current_timestamp().cast("string")


def latest_snapshot(api10: DataFrame, known: str | None = None) -> DataFrame:
    """Product prices of the newest snapshot, whose date is ``known`` for a registered table. A percentage that is no
    number becomes NULL."""
    return newest(api10, "dt", known).withColumns(
        {"prev_1d_dir_tp": F.col("direction_tp"), "prev_1d_dir_pct": F.col("direction_pct").try_cast("double")}
    ).select(*SNAPSHOT_COLUMNS)


def price_changes(snapshot: DataFrame, direction: str) -> DataFrame:
    return snapshot.where(F.col("prev_1d_dir_tp") == direction).select(*CHANGE_COLUMNS)


def change_order() -> list[Column]:
    """Largest percentage first; equal ones are ordered by every other column, so reruns agree."""
    ties = [c for c in CHANGE_COLUMNS if c not in ("country_cd", "prev_1d_dir_pct")]
    return [F.col("prev_1d_dir_pct").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]


def price_changes_ranked(snapshot: DataFrame, direction: str) -> DataFrame:
    """Every change numbered within its region."""
    return number_within(price_changes(snapshot, direction), ["country_cd"], change_order(), "ranking")


def price_change_top3(snapshot: DataFrame, direction: str) -> DataFrame:
    """Three largest changes per region."""
    top = top_per_group(price_changes(snapshot, direction), ["country_cd"], change_order(), 3, "ranking")
    return top.select(*TOP3_COLUMNS)


def price_region_count(snapshot: DataFrame) -> DataFrame:
    kinds = {"rise_count": RISE, "drop_count": DROP, "keep_count": KEEP}
    return snapshot.groupBy("country_nm").agg(
        *[F.count_if(F.col("prev_1d_dir_tp") == code).alias(name) for name, code in kinds.items()]
    )


def direction_count(snapshot: DataFrame) -> DataFrame:
    keys = ["item_nm", "kind_nm", "prev_1d_dir_tp"]
    counts = snapshot.where("prev_1d_dir_tp IS NOT NULL").groupBy(*keys)
    return counts.agg(F.count("prev_1d_dir_tp").alias("direction_count")).orderBy(*[F.asc_nulls_last(k) for k in keys])


def update_status(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("country_nm").alias("country_count"),
        F.max("res_dt").alias("latest_date"),
    )


def season_region_all(snapshot: DataFrame, coordinates: DataFrame, seasons: DataFrame) -> DataFrame:
    """Snapshot with region coordinates and the season of product and month, where there is one."""
    places = coordinates.select("country_cd", "latitude", "longitude")
    dated = lookup_join(snapshot, places, ["country_cd"]).withColumns(
        {
            "present_month": F.substring("dt", 5, 2).try_cast("int"),
            "_product": F.col("product_no").cast("double"),
            "_month": F.substring("dt", 5, 2).try_cast("int"),
        }
    )
    months = seasons.select(
        F.col("product_no").alias("_product"), F.col("month").alias("_month"), "season", F.col("month").alias("season_month")
    )
    return lookup_join(dated, months, ["_product", "_month"]).select(*SEASON_COLUMNS)


def season_region_product(snapshot: DataFrame, coordinates: DataFrame, seasons: DataFrame) -> DataFrame:
    """Only products in season; the filter turns the season join into an inner one."""
    return season_region_all(snapshot, coordinates, seasons).where("season IS NOT NULL")


def eco_market_category(api13: DataFrame) -> DataFrame:
    return api13.withColumn("market_category", market_category(F.col("market_nm")))


def _price_statistics() -> list[Column]:
    return [
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("*").alias("record_count"),
    ]


def eco_price_stats(api13: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Organic prices per day, item and market category."""
    keys = ["res_dt", "item_cd", "item_nm", "category_nm", "market_category"]
    priced = eco_market_category(api13).where("price IS NOT NULL")
    return (
        priced.groupBy(*keys, "year", "month")
        .agg(*_price_statistics())
        .withColumn("created_at", load_stamp() if created_at is None else created_at)
        .select(*keys, "record_count", "avg_price", "min_price", "max_price", "created_at", "year", "month")
    )


def _retail_comparison(rows: DataFrame, places: list[str], created_at: Column | None) -> DataFrame:
    days = ["res_dt", "year", "month", "week_of_year", "weekday_nm", "weekend_yn"]
    keys = [*days, *places, "category_nm", "item_nm", "kind_nm", "rank_nm"]
    stats = ["avg_price", "min_price", "max_price", "record_count", "market_count"]
    return (
        rows.groupBy(*keys)
        .agg(*_price_statistics(), F.countDistinct("market_nm").alias("market_count"))
        .withColumns({"year": F.col("year").try_cast("int"), "month": F.col("month").try_cast("int")})
        .withColumn("created_at", load_stamp() if created_at is None else created_at)
        .select(*keys, *stats, "created_at")
    )


def retail_channel_comparison(api17: DataFrame, created_at: Column | None = None, suffix: str = CHAIN_SUFFIX) -> DataFrame:
    """Retail prices of chain stores against traditional markets."""
    channel = F.when(F.col("market_nm").endswith(suffix), CHAIN_CHANNEL).otherwise(TRADITIONAL_CHANNEL)
    rows = api17.where("price IS NOT NULL AND market_nm IS NOT NULL").withColumn("channel_type", channel)
    return _retail_comparison(rows, ["channel_type"], created_at)


def retail_region_comparison(api17: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Retail prices per region."""
    rows = api17.where("price IS NOT NULL AND country_nm IS NOT NULL")
    return _retail_comparison(rows, ["country_cd", "country_nm"], created_at)
