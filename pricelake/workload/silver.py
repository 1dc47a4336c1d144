"""The silver jobs end to end."""

from __future__ import annotations

from pricelake.plans import silver as plans
from pricelake.plans.loads import stamped_products
from pricelake.sources.landing import latest_date
from pricelake.workload import feeds
from pricelake.workload.shape import plain


def api1_silver(spark, sf_dir):
    return plain(plans.category_silver(feeds.category_docs(spark, sf_dir)))


def product_codes(spark, sf_dir):
    return plans.product_codes(feeds.products(spark, sf_dir), [(0, "616", "01", "21", "中")])


def api10_silver(spark, sf_dir):
    """The daily job: newest landing date of the retail class, stamped with its snapshot date."""
    docs = latest_date(feeds.product_docs(spark, sf_dir), "01")
    return plain(stamped_products(docs, product_codes(spark, sf_dir)))


def api10_silver_history(spark, sf_dir):
    docs = feeds.product_docs(spark, sf_dir)
    rows = plans.product_silver(docs.withColumn("batch", docs.dt), product_codes(spark, sf_dir), extra=["batch"])
    return plain(rows.drop("file_path", "pos"))


def api17_silver(spark, sf_dir):
    return plain(plans.region_silver(feeds.region_docs(spark, sf_dir), feeds.products(spark, sf_dir)))


def api17_backfill(spark, sf_dir):
    """The same job over documents that were landed by year and region name."""
    docs = feeds.region_docs(spark, sf_dir, backfill=True)
    return plain(plans.region_silver(docs, feeds.products(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (api1_silver, api10_silver, api10_silver_history, api17_silver, api17_backfill)}

_DAY = """CAST(extract(week FROM l_shipdate) AS BIGINT) AS week_of_year,
  CAST(extract(isodow FROM l_shipdate) - 1 AS BIGINT) AS weekday_num,
  (['월요일', '화요일', '수요일', '목요일', '금요일', '토요일', '일요일'])[extract(isodow FROM l_shipdate)] AS weekday_nm,
  extract(isodow FROM l_shipdate) >= 6 AS weekend_yn"""


def _names(code: str, names: dict[str, str], default: str) -> str:
    return f"CASE {code} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE '{default}' END"


_ROW_DAY = """CAST(extract(week FROM {day}) AS BIGINT) AS week_of_year,
  CAST(extract(isodow FROM {day}) - 1 AS BIGINT) AS weekday_num,
  coalesce((['월요일', '화요일', '수요일', '목요일', '금요일', '토요일', '일요일'])[extract(isodow FROM {day})], '알수없음') AS weekday_nm,
  coalesce(extract(isodow FROM {day}) >= 6, false) AS weekend_yn"""


def product_rows_sql(day: str = "l_shipdate") -> str:
    """Product rows whose records carry the given date."""
    return f"""{feeds.PRODUCT_DOCS_SQL}, {feeds.PRODUCTS_SQL},
codes AS (SELECT product_no, item_cd, kind_cd, rank_cd FROM products UNION ALL SELECT 0, '616', '01', '21'),
kept AS (SELECT *, CASE WHEN category_code IN ('100', '200', '300', '600') THEN 'main' WHEN category_code = '500'
    THEN 'livestock' ELSE 'grocery' END AS segment FROM raw_rows
  WHERE product_cls_code = '01' AND category_code <> '700'),
product_rows AS (
  SELECT l_partkey AS product_no, product_cls_code AS product_cls_cd, '소매' AS product_cls_nm,
    category_code AS category_cd, '부류' AS category_nm, item_cd, split_part(product_name, '/', 1) AS item_nm, kind_cd,
    CASE WHEN l_returnflag <> 'N' THEN 'a / b' END AS kind_nm, '1kg' AS product_cls_unit,
    strftime(l_shipdate, '%m/%d') AS base_dt, price1 AS base_pr, strftime(l_shipdate, '%m/%d') AS prev_1d_dt,
    price2 AS prev_1d_pr, direction AS direction_tp,
    CASE WHEN l_discount = 0.02 THEN '[n/a]' ELSE CAST(l_discount AS VARCHAR) END AS direction_pct,
    strftime(l_shipdate, '%m/%d') AS prev_1m_dt, price3 AS prev_1m_pr, strftime(l_shipdate, '%m/%d') AS prev_1y_dt,
    price4 AS prev_1y_pr, country AS country_cd, '지역' AS country_nm,
    strftime({day}, '%Y-%m-%d') AS res_dt, {_ROW_DAY.format(day=f"({day})")}, segment, dt AS batch, file_path, pos
  FROM kept LEFT JOIN codes ON segment = 'main' AND l_partkey = product_no)"""


PRODUCT_ROWS_SQL = product_rows_sql()

REGION_SQL = f"""WITH {feeds.REGION_ROWS_SQL}, {feeds.PRODUCTS_SQL}
SELECT CAST(res_dt AS VARCHAR) AS res_dt, week_of_year, weekday_num, weekday_nm, weekend_yn,
  CAST(p.product_no AS DOUBLE) AS product_no, product_cls AS product_cls_cd, p.product_cls_nm, p.product_cls_unit,
  place AS country_cd, place_nm AS country_nm,
  (['100', '200', '300', '400', '500', '600'])[l_partkey % 6 + 1] AS category_cd, p.category_nm,
  CAST(l_partkey AS VARCHAR) AS item_cd, p.item_nm,
  CASE WHEN l_partkey % 120 < 10 THEN '0' ELSE '' END || l_partkey % 120 AS kind_cd, p.kind_nm, '04' AS rank_cd,
  p.rank_nm, 'M' || l_suppkey AS market_nm, price, year, month
FROM region_rows LEFT JOIN products p ON product_cls = p.product_cls_cd AND l_partkey = p.product_no"""

ORACLES = {
    "api1_silver": f"""WITH {feeds.CATEGORY_DOCS_SQL}
SELECT dt AS res_dt, {_DAY}, product_cls AS product_cls_cd,
  {_names("product_cls", {"01": "소매", "02": "도매"}, "미분류")} AS product_cls_nm, category AS category_cd,
  {_names("category", feeds.CATEGORIES, "미분류")} AS category_nm, country AS country_cd,
  {_names("country", {**feeds.REGION_NAMES, "all": "전국"}, "기타")} AS country_nm,
  item_nm, item_cd, kind_nm, kind_cd, rank_nm, rank_cd, unit, base_dt, base_pr, prev_1d_dt, prev_1d_pr, prev_1w_dt,
  prev_1w_pr, prev_2w_dt, prev_2w_pr, prev_1m_dt, prev_1m_pr, prev_1y_dt, prev_1y_pr, avg_tp, avg_pr,
  strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month, strftime(l_shipdate, '%Y%m%d') AS dt
FROM labelled WHERE base_pr IS NOT NULL""",
    "api10_silver": f"""WITH {PRODUCT_ROWS_SQL},
newest AS (SELECT * FROM product_rows WHERE batch = (SELECT max(dt) FROM docs)),
stamped AS (SELECT *, first_value(res_dt) OVER (ORDER BY file_path, pos) AS day FROM newest)
SELECT * EXCLUDE (batch, file_path, pos, day), substr(day, 1, 4) AS year, substr(day, 6, 2) AS month,
  replace(day, '-', '') AS dt FROM stamped""",
    "api10_silver_history": f"WITH {PRODUCT_ROWS_SQL} SELECT * EXCLUDE (file_path, pos) FROM product_rows",
    "api17_silver": REGION_SQL,
    "api17_backfill": REGION_SQL,
}
