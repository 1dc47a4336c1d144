"""Landed documents to rows, and their classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators import documents as ops
from pricelake.operators import quality
from pricelake.operators.landing_keys import category_keys, product_keys
from pricelake.plans.silver import category_rows
from pricelake.sources.landing import once, parsed
from pricelake.workload import feeds
from pricelake.workload.shape import plain

LABELS = list(ops.CATEGORY_LABELS.values())
PRICES = list(ops.CATEGORY_PRICES.values())


def explode_items(spark, sf_dir):
    return plain(ops.explode_items(feeds.category_docs(spark, sf_dir)))


def explode_prices(spark, sf_dir):
    return plain(ops.explode_prices(feeds.product_docs(spark, sf_dir)))


def explode_records(spark, sf_dir):
    return plain(ops.explode_records(feeds.region_docs(spark, sf_dir)))


def classify_responses(spark, sf_dir):
    """Statuses of the category feed, with no-data responses refused and allowed."""
    refused = ops.with_status(feeds.category_docs(spark, sf_dir), "status")
    # Allowing no data changes one status only, so one parse serves for both.
    statuses = refused.withColumn("status_allowed", F.when(F.col("status") == "empty", "ok").otherwise(F.col("status")))
    return statuses.groupBy("category", "status", "status_allowed").agg(F.count("*").alias("documents"))


def classify_price_lists(spark, sf_dir):
    docs = ops.with_price_list_status(feeds.product_docs(spark, sf_dir), "status")
    return docs.groupBy("dt", "status").agg(F.count("*").alias("documents"))


def condition_fields(spark, sf_dir):
    """Request fields of each category response: a padded text, a number (no text) and an absent one."""
    docs = once(feeds.category_docs(spark, sf_dir)).withColumn("first", ops.first_condition(F.col("value")))
    fields = {k: ops.condition_field(F.col("first"), k) for k in ("p_regday", "p_number", "p_country_code")}
    return docs.select("file_path", *[c.alias(k) for k, c in fields.items()])


def condition_dates(spark, sf_dir):
    docs = once(feeds.product_docs(spark, sf_dir))
    return docs.select("file_path", ops.condition_date(F.col("value")).alias("dt"))


def category_landing_keys(spark, sf_dir):
    """Keys of category responses from what they echo: here only the day, so class and region take
    their defaults."""
    responses = feeds.category_docs(spark, sf_dir).select("value")
    return category_keys(responses).groupBy("dt", "product_cls", "country", "category").agg(F.count("*").alias("documents"))


def product_landing_keys(spark, sf_dir):
    """Keys of product responses, with the requested region stamped into each document."""
    responses = feeds.product_docs(spark, sf_dir).select("value", F.col("country").alias("region"))
    keyed = product_keys(responses, "region")
    stamped = parsed(F.col("value"), "struct<_country_code:string,error_code:string>")
    return keyed.select(
        "dt", "product_cls", "country", stamped["_country_code"].alias("stamped"), stamped["error_code"].alias("error_code")
    )


def group_by_date(spark, sf_dir):
    """Records of region responses with the date they land under."""
    records = ops.group_by_date(ops.explode_response_records(feeds.region_responses(spark, sf_dir)))
    return plain(records.select("pos", "marketname", "price", "yyyy", "regday", "dt"))


def drop_missing_price(spark, sf_dir):
    rows = category_rows(feeds.category_docs(spark, sf_dir)).dropna(subset=["base_pr"])
    return plain(rows.select("file_path", "pos", "item_nm", "base_pr"))


def drop_accounting(spark, sf_dir):
    return quality.dropped_rows(category_rows(feeds.category_docs(spark, sf_dir)), "base_pr")


QUERIES = {
    f.__name__: f
    for f in (
        explode_items,
        explode_prices,
        explode_records,
        classify_responses,
        classify_price_lists,
        condition_fields,
        condition_dates,
        category_landing_keys,
        product_landing_keys,
        group_by_date,
        drop_missing_price,
        drop_accounting,
    )
}

_REGDAY = """CASE WHEN l_discount = 0.03 THEN month(l_shipdate) || '/' || day(l_shipdate)
    WHEN l_discount = 0.04 THEN strftime(l_shipdate, '%m%d') ELSE strftime(l_shipdate, '%m/%d') END"""
_YEAR = "CASE WHEN l_discount <> 0.05 THEN strftime(l_shipdate, '%Y') END"

ORACLES = {
    "explode_items": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT file_path, dt, product_cls, country, category, CAST(pos AS BIGINT) AS pos, {", ".join(LABELS + PRICES)}
FROM labelled""",
    "explode_prices": f"""WITH {feeds.PRODUCT_DOCS_SQL}
SELECT dt, '01' AS product_cls, country, file_path, CAST(pos AS BIGINT) AS pos, '000' AS error_code,
  '["' || strftime(l_shipdate, '%Y-%m-%d') || '","x"]' AS condition, CAST(NULL AS VARCHAR) AS price,
  product_cls_code, '소매' AS product_cls_name, category_code, '부류' AS category_name,
  CAST(l_partkey AS VARCHAR) AS productno, strftime(l_shipdate, '%Y-%m-%d') AS lastest_day, product_name AS productName,
  '1kg' AS unit, strftime(l_shipdate, '%m/%d') AS day1, strftime(l_shipdate, '%m/%d') AS day2,
  strftime(l_shipdate, '%m/%d') AS day3, strftime(l_shipdate, '%m/%d') AS day4,
  CASE WHEN l_discount <> 0.03 THEN format('{{:,.2f}}', price1) END AS dpr1,
  ' ' || format('{{:,.2f}}', price2) || ' ' AS dpr2,
  CASE WHEN l_discount = 0.04 THEN '-' ELSE CAST(CAST(price3 AS DECIMAL(14, 2)) AS VARCHAR) END AS dpr3,
  CAST(CAST(price4 AS DECIMAL(14, 2)) AS VARCHAR) AS dpr4, direction,
  CASE WHEN l_discount = 0.02 THEN '[n/a]' ELSE CAST(l_discount AS VARCHAR) END AS value, country AS county_code,
  '지역' AS county_name
FROM raw_rows
UNION ALL
SELECT dt, '01', country, 'raw/api-10/dt=' || dt || '/product_cls=01/country=' || country || '/' || l_orderkey || '-'
    || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '/data.json', 0, '000',
  '["' || strftime(l_shipdate, '%Y-%m-%d') || '","x"]', 'none', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM docs WHERE l_tax = 0.0""",
    "explode_records": f"""WITH {feeds.REGION_ROWS_SQL}
SELECT 'raw/api-17/dt=' || strftime(l_shipdate, '%Y-%m-%d') || '/product_cls=' || product_cls || '/country=' || place
    || '/category=' || (['100', '200', '300', '400', '500', '600'])[l_partkey % 6 + 1] || '/item=' || l_partkey
    || '/kind=' || CASE WHEN l_partkey % 120 < 10 THEN '0' ELSE '' END || l_partkey % 120
    || '/product_rank=04/data.json' AS file_path,
  strftime(l_shipdate, '%Y-%m-%d') AS dt, '품목' AS itemname, '품종' AS kindname,
  CASE WHEN l_discount = 0.06 THEN '-' ELSE format('{{:,.2f}}', l_extendedprice + k) END AS price,
  product_cls, place AS country, (['100', '200', '300', '400', '500', '600'])[l_partkey % 6 + 1] AS category,
  CAST(l_partkey AS VARCHAR) AS item, CASE WHEN l_partkey % 120 < 10 THEN '0' ELSE '' END || l_partkey % 120 AS kind,
  '04' AS product_rank, CAST(k - 1 AS BIGINT) AS pos,
  CASE l_discount WHEN 0.0 THEN '평균' WHEN 0.01 THEN '평년' WHEN 0.02 THEN NULL ELSE '시장지역' END AS countyname,
  'M' || l_suppkey AS marketname, {_YEAR} AS yyyy, {_REGDAY} AS regday
FROM records""",
    "classify_responses": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT category, CASE l_tax WHEN 0.0 THEN 'empty' WHEN 0.01 THEN 'broken' WHEN 0.02 THEN 'error:200' ELSE 'ok' END
    AS status,
  CASE l_tax WHEN 0.01 THEN 'broken' WHEN 0.02 THEN 'error:200' ELSE 'ok' END AS status_allowed,
  count(*) AS documents
FROM docs GROUP BY 1, 2, 3""",
    "classify_price_lists": f"""WITH {feeds.PRODUCT_DOCS_SQL}
SELECT dt, CASE l_tax WHEN 0.0 THEN 'not_a_list' WHEN 0.01 THEN 'broken' WHEN 0.02 THEN 'empty'
    WHEN 0.03 THEN 'not_a_list' ELSE 'ok' END AS status, count(*) AS documents
FROM docs GROUP BY 1, 2""",
    "condition_fields": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT 'raw/api-1/dt=' || dt || '/product_cls=' || product_cls || '/country=' || country || '/category=' || category
    || '/data.json' AS file_path,
  CASE WHEN l_tax < 0.025 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS p_regday,
  '' AS p_number, '' AS p_country_code FROM docs""",
    "condition_dates": f"""WITH {feeds.PRODUCT_DOCS_SQL}
SELECT 'raw/api-10/dt=' || dt || '/product_cls=01/country=' || country || '/' || l_orderkey || '-'
    || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '/data.json' AS file_path,
  CASE WHEN l_tax <> 0.01 THEN strftime(l_shipdate, '%Y-%m-%d') END AS dt FROM docs""",
    "category_landing_keys": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, '01' AS product_cls, 'all' AS country, '' AS category,
  count(*) AS documents FROM docs WHERE l_tax > 0.025 GROUP BY 1""",
    "product_landing_keys": f"""WITH {feeds.PRODUCT_DOCS_SQL}
SELECT strftime(l_shipdate, '%Y%m%d') AS dt, '01' AS product_cls, country, country AS stamped, '000' AS error_code
FROM docs WHERE l_tax <> 0.01""",
    "group_by_date": f"""WITH {feeds.REGION_ROWS_SQL}
SELECT CAST(k - 1 AS BIGINT) AS pos, 'M' || l_suppkey AS marketname,
  CASE WHEN l_discount = 0.06 THEN '-' ELSE format('{{:,.2f}}', l_extendedprice + k) END AS price,
  {_YEAR} AS yyyy, {_REGDAY} AS regday, {_YEAR} || '-' || replace({_REGDAY}, '/', '-') AS dt
FROM records WHERE l_discount <> 0.05""",
    "drop_missing_price": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT file_path, CAST(pos AS BIGINT) AS pos, item_nm, base_pr FROM labelled WHERE base_pr IS NOT NULL""",
    "drop_accounting": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT count(*) AS rows_before, count(base_pr) AS rows_after, count(*) - count(base_pr) AS rows_dropped
FROM labelled""",
}
