"""Landing keys of a response, taken from the request conditions it echoes.

Responses whose date cannot be found are not landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.fixed import NATIONWIDE_CODE
from pricelake.functions import compact_date
from pricelake.operators.documents import condition_date, condition_field, first_condition
from pricelake.sources.landing import once


def _or(text: Column, default: str) -> Column:
    return F.when(text == "", default).otherwise(text)


def category_keys(responses: DataFrame) -> DataFrame:
    """Category feed: a request without a region covers the whole country."""
    value = F.col("_condition")
    keyed = once(responses).withColumn("_condition", first_condition(F.col("value"))).withColumns(
        {
            "dt": condition_field(value, "p_regday"),
            "product_cls": _or(condition_field(value, "p_product_cls_code"), "01"),
            "country": _or(condition_field(value, "p_country_code"), NATIONWIDE_CODE),
            "category": condition_field(value, "p_category_code"),
        }
    )
    return once(keyed.drop("_condition"), "dt").where("dt <> ''")


def product_keys(responses: DataFrame, region: str) -> DataFrame:
    """Product feed: the date without dashes, and the requested region, which is also stamped into
    the document because the response does not name it. ``region`` is the column that holds it."""
    responses, text = once(responses), F.trim("value")
    stamp = F.to_json(F.struct(F.col(region).alias("_country_code")))
    rest = F.substring(text, 2, 2**31 - 1)
    stamped = F.concat(F.rtrim(stamp, F.lit("}")), F.lit(","), rest)
    keyed = responses.withColumns(
        {
            "dt": compact_date(condition_date(F.col("value"))),
            "product_cls": F.lit("01"),
            "country": F.col(region),
            "value": F.when(F.col(region).isNotNull(), stamped).otherwise(text),
        }
    )
    return once(keyed, "dt").where("dt IS NOT NULL")


def organic_keys(responses: DataFrame) -> DataFrame:
    """Organic feed: always the retail class and the whole country."""
    value = F.col("_condition")
    names = {"category": "p_itemcategorycode", "item": "p_itemcode", "kind": "p_kindcode", "product_rank": "p_productrankcode"}
    keyed = once(responses).withColumn("_condition", first_condition(F.col("value"))).withColumns(
        {
            "dt": condition_field(value, "p_regday"),
            "product_cls": F.lit("01"),
            "country": F.lit(NATIONWIDE_CODE),
            **{key: condition_field(value, field) for key, field in names.items()},
        }
    )
    return once(keyed.drop("_condition"), "dt").where("dt <> ''")
