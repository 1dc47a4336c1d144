"""Request parameters of the feeds, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.fixed import CATEGORIES, PRODUCT_CLASSES, REGION_NAMES, WHOLESALE_CITIES


def _codes(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def wholesale_regions() -> list[str]:
    return [code for code, name in REGION_NAMES.items() if name in WHOLESALE_CITIES]


def category_requests(run_dates: DataFrame, day: str = "run_date") -> DataFrame:
    """Requests of the category feed for each run date: the retail class, every category, every
    wholesale city and once without a region. The code lists are literals, so this is a fixed
    fan-out of each row and no join."""
    retail = [c for c in PRODUCT_CLASSES if c == "01"]
    return (
        run_dates.select(F.date_sub(day, 1).alias("regday"))
        .withColumn("product_cls_code", F.explode(_codes(retail)))
        .withColumn("category_code", F.explode(_codes(CATEGORIES)))
        .withColumn("country_code", F.explode(_codes([*wholesale_regions(), None])))
    )


def product_requests(run_dates: DataFrame, day: str = "run_date") -> DataFrame:
    """Requests of the product feed: one per retail region."""
    return run_dates.select(F.col(day).alias("regday"), F.explode(_codes(REGION_NAMES)).alias("country_code"))


def tree_requests(trees: DataFrame, value: str = "value") -> DataFrame:
    """Requests of the region feed: a nested category, product, variety, rank tree flattened.
    A variety without rank codes gives no request."""
    variety = "struct<retail_codes:array<string>>"
    product = f"struct<varieties:map<string,{variety}>>"
    category = f"struct<products:map<string,{product}>>"
    tree = F.from_json(F.col(value), f"map<string,{category}>")
    return (
        trees.select(F.explode(tree).alias("item_category_code", "category"))
        .select("item_category_code", F.explode("category.products").alias("item_code", "product"))
        .select("item_category_code", "item_code", F.explode("product.varieties").alias("kind_code", "variety"))
        .select(
            "item_category_code",
            "item_code",
            "kind_code",
            F.explode("variety.retail_codes").alias("product_rank_code"),
        )
    )
