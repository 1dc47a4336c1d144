"""The daily chain after landing: sync partitions, build every mart, check, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelake.fixed import DROP, MARKET_CATEGORIES, RISE
from pricelake.operators import quality
from pricelake.operators.registry import sync_partitions
from pricelake.operators.sinks import write_parquet
from pricelake.plans import gold
from pricelake.sources.tables import newest_partition, silver, staged

NOT_NULL = {
    "mart_price_rise_top3": ["country_cd", "ranking"],
    "mart_price_drop_top3": ["country_cd", "ranking"],
    "mart_season_region_product": ["latitude", "longitude"],
    "mart_retail_channel_comparison": ["res_dt", "record_count", "avg_price"],
    "mart_retail_region_comparison": ["res_dt", "country_cd", "avg_price"],
    "mart_eco_price_statistics_by_category": ["res_dt", "item_cd", "market_category", "record_count", "avg_price"],
}


def mart_frames(
    snapshot: DataFrame, api13: DataFrame, api17: DataFrame, coordinates: DataFrame, seasons: DataFrame
) -> dict[str, DataFrame]:
    """All nine marts, lazily."""
    return {
        "mart_price_rise_top3": gold.price_change_top3(snapshot, RISE),
        "mart_price_drop_top3": gold.price_change_top3(snapshot, DROP),
        "mart_price_region_count": gold.price_region_count(snapshot),
        "mart_price_region_direction_count": gold.direction_count(snapshot),
        "mart_update_status": gold.update_status(snapshot),
        "mart_season_region_product": gold.season_region_product(snapshot, coordinates, seasons),
        "mart_eco_price_statistics_by_category": gold.eco_price_stats(api13),
        "mart_retail_channel_comparison": gold.retail_channel_comparison(api17),
        "mart_retail_region_comparison": gold.retail_region_comparison(api17),
    }


def checks(marts: dict[str, DataFrame], api10: DataFrame, snapshot: DataFrame, known: str | None = None) -> DataFrame:
    """Every data check of the gold layer as one report."""
    report = [quality.not_null(marts[name], name, columns) for name, columns in NOT_NULL.items()]
    for name in ("mart_price_rise_top3", "mart_price_drop_top3"):
        report.append(quality.unique_key(marts[name], name, ["country_cd", "ranking"]))
    season, eco = "mart_season_region_product", "mart_eco_price_statistics_by_category"
    report.append(quality.same_month(marts[season], season, "present_month", "season_month"))
    report.append(quality.accepted_values(marts[eco], eco, "market_category", MARKET_CATEGORIES))
    for name in ("mart_price_rise_top3", "mart_price_drop_top3", season):
        report.append(quality.not_empty(marts[name], name))
    report.append(quality.reconcile_newest(api10, snapshot, "api10", known=known))
    return quality.all_checks(report)


def build_gold(
    spark: SparkSession, gold_root: str, coordinates: DataFrame, seasons: DataFrame, database: str = "silver"
) -> DataFrame:
    """Write every mart from the registered silver tables and return the check report.

    The newest snapshot, whose date is in the partition names, feeds six marts, so it is written out once; a lost executor only
    means that files are read again. Checks read the written marts, not their plans.
    """
    sync_partitions(spark, [f"{database}.{table}" for table in ("api1", "api10", "api13", "api17")])
    api10 = silver(spark, "api10", database)
    known = newest_partition(spark, f"{database}.api10")
    snapshot = staged(gold.latest_snapshot(api10, known), "snapshot")
    frames = mart_frames(snapshot, silver(spark, "api13", database), silver(spark, "api17", database), coordinates, seasons)
    written = write_marts(frames, gold_root)
    return checks(written, api10, snapshot, known)


def write_marts(frames: dict[str, DataFrame], gold_root: str) -> dict[str, DataFrame]:
    """Every mart written below the root, and read from there."""
    for name, frame in frames.items():
        write_parquet(frame, f"{gold_root}/{name}")
    return {name: frame.sparkSession.read.schema(frame.schema).parquet(f"{gold_root}/{name}") for name, frame in frames.items()}
