"""Landed documents to silver rows. Every job is one lazy plan over a document frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.fixed import (
    CATEGORIES,
    NATIONWIDE_CODE,
    NATIONWIDE_NAME,
    PATH_NAMES,
    PRODUCT_CLASSES,
    PRODUCT_NAMES,
    PSEUDO_REGIONS,
    REGION_NAMES,
    UNKNOWN_CATEGORY,
    UNKNOWN_CLASS,
    UNKNOWN_REGION,
)
from pricelake.functions import add_date_features, code_columns, name_of_code, normalize_price, split_name
from pricelake.functions.dates import landing_date
from pricelake.operators.documents import explode_items, explode_prices, explode_records, region_date
from pricelake.operators.lookup import lookup_join
from pricelake.operators.sinks import segment_of
from pricelake.operators.snapshot import month_partitions
from pricelake.schemas import API1, API10, API17

def ordered(df: DataFrame, first: Sequence[str], keep_rest: bool = False) -> DataFrame:
    """Columns in a fixed order as far as present, optionally followed by the others."""
    columns = [c for c in first if c in df.columns]
    return df.select(*columns, *([c for c in df.columns if c not in columns] if keep_rest else []))


def with_code_names(df: DataFrame) -> DataFrame:
    """Names for class, category and region codes, with a default for unknown codes."""
    regions = {**REGION_NAMES, NATIONWIDE_CODE: NATIONWIDE_NAME}
    return df.withColumns(
        {
            "product_cls_nm": name_of_code(F.col("product_cls_cd"), PRODUCT_CLASSES, UNKNOWN_CLASS),
            "category_nm": name_of_code(F.col("category_cd"), CATEGORIES, UNKNOWN_CATEGORY),
            "country_nm": name_of_code(F.col("country_cd"), regions, UNKNOWN_REGION),
        }
    )


FATE = "fate"


def with_fate(rows: DataFrame) -> DataFrame:
    """Rows of an explode with outcomes, with what becomes of each: ``kept``, or why its document gives none."""
    return rows.withColumn(FATE, F.when(F.col("outcome") == "rows", "kept").otherwise(F.col("outcome")))


def sift(rows: DataFrame, passes: Column, reason: str) -> DataFrame:
    """Rows that pass; a frame with fates keeps the others too, and says why they do not."""
    if FATE not in rows.columns:
        return rows.where(passes)
    fails = (F.col(FATE) == "kept") & ~F.coalesce(passes, F.lit(False))
    return rows.withColumn(FATE, F.when(fails, reason).otherwise(F.col(FATE)))


def category_rows(docs: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Category feed before the price filter: exploded items with their path codes."""
    paths = {k: F.coalesce(F.col(k), F.lit("")) for k in ("product_cls", "category", "country")}
    rows = explode_items(docs) if items is None else items
    return rows.withColumns(paths).withColumnsRenamed({**PATH_NAMES, "dt": "res_dt"})


def category_silver(docs: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Category feed (table api1) from documents with ``dt``, ``product_cls``, ``country`` and ``category``.

    Rows without a base price are dropped, and so are those of a landing date that is none, with dashes or without. ``dt`` and the
    month partitions come from the landing date, so a rerun replaces exactly its day. ``items`` are the exploded items
    where the caller has them; with fates, all rows come back with their document's path, position and landing date.
    """
    rows = category_rows(docs, items)
    more = [c for c in (FATE, "outcome") if c in rows.columns]
    if more:
        rows = rows.withColumn("landed", F.col("res_dt"))
        more += ["file_path", "pos", "landed"]
    dated = sift(rows.withColumn("res_dt", landing_date(F.col("res_dt"))), F.col("res_dt").isNotNull(), "undated")
    priced = sift(dated, F.col("base_pr").isNotNull(), "no_price")
    dated = add_date_features(with_code_names(priced), "res_dt").drop("year", "month")
    dated = dated.withColumn("dt", F.date_format("res_dt", "yyyyMMdd"))
    return month_partitions(dated).select(*API1.fieldNames(), "year", "month", "dt", *more)


def product_rows(docs: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Product feed, typed and renamed: retail class only, with the output segment of each row."""
    raw = (explode_prices(docs) if raw is None else raw).drop("dt", "product_cls", "country", "condition", "error_code", "price")
    item, kind = split_name(F.col("productName"))
    typed = raw.withColumns(
        {
            "item_nm": item,
            "kind_nm": kind,
            **{p: normalize_price(F.col(p)) for p in ("dpr1", "dpr2", "dpr3", "dpr4")},
            "productno": F.col("productno").try_cast("int"),
        }
    ).drop("productName")
    named = code_columns(add_date_features(typed, "lastest_day").withColumnsRenamed(PRODUCT_NAMES))
    return sift(named, F.col("product_cls_cd") == "01", "other_class").withColumn("segment", segment_of(F.col("category_cd")))


def product_codes(products: DataFrame, extra_rows: Sequence[tuple] = ()) -> DataFrame:
    """Metadata columns the product feed takes, with literal rows added by the caller."""
    codes = products.select("product_no", "item_cd", "kind_cd", "rank_cd", "rank_nm")
    if extra_rows:
        codes = codes.unionByName(products.sparkSession.createDataFrame(list(extra_rows), codes.schema))
    return codes


def product_silver(docs: DataFrame, codes: DataFrame, extra: Sequence[str] = (), rows: DataFrame | None = None) -> DataFrame:
    """Product feed (table api10). Only the main segment carries item and kind codes; they come
    from the product metadata, which fans out where it repeats a product. ``rows`` are the typed rows where the caller has them."""
    rows = (product_rows(docs) if rows is None else rows).where("segment IS NOT NULL").withColumn(
        "_main_no", F.when(F.col("segment") == "main", F.col("product_no").cast("bigint"))
    )
    meta = codes.withColumnRenamed("product_no", "_main_no")
    # One join for all rows: a branch of their own for rows without a product to look up would parse every document twice.
    return ordered(lookup_join(rows, meta, ["_main_no"]), [*API10.fieldNames(), "segment", "file_path", "pos", *extra])


def place_code(place: Column) -> Column:
    """Region of a path: daily folders hold the code, backfill folders the name."""
    codes = {name: code for code, name in REGION_NAMES.items()}
    pairs = [F.lit(part) for pair in codes.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), place), place)


def region_rows(docs: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Region feed before the metadata join: typed, dated, without the pseudo regions."""
    records = (explode_records(docs) if records is None else records).drop("dt").withColumnsRenamed({"countyname": "county_nm", "marketname": "market_nm"})
    dated = add_date_features(records.withColumn("res_dt", region_date()), "res_dt").drop("year", "month")
    code = place_code(F.col("country"))
    typed = dated.withColumns(
        {
            "price": normalize_price(F.col("price")),
            "country": code,
            "country_nm": name_of_code(code, REGION_NAMES, UNKNOWN_REGION),
        }
    )
    real = ~F.coalesce(F.col("county_nm").isin(*PSEUDO_REGIONS), F.lit(False))
    return sift(typed, real, "pseudo_region").drop("yyyy", "regday", "itemname", "kindname").withColumnsRenamed(PATH_NAMES)


def region_silver(docs: DataFrame, products: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Region feed (table api17): metadata joined on five codes, each row in its own month. ``rows`` are the typed rows where the
    caller has them."""
    keys = ["product_cls_cd", "category_cd", "item_cd", "kind_cd", "rank_cd"]
    joined = lookup_join(region_rows(docs) if rows is None else rows, products, keys).drop("county_nm", "file_path", "pos")
    typed = joined.withColumn("product_no", F.col("product_no").cast("double"))
    return ordered(month_partitions(typed), API17.fieldNames(), keep_rest=True)
