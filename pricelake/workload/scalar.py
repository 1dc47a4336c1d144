"""Column functions, lookups and request rows over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake import functions as fn
from pricelake.fixed import (
    CATEGORIES,
    PSEUDO_REGIONS,
    REGION_NAMES,
    WEEKDAY_NAMES,
)
from pricelake.functions.text import mark_quoted_brackets
from pricelake.operators.lookup import lookup_join
from pricelake.operators.requests import category_requests, tree_requests, wholesale_regions
from pricelake.plans.silver import product_codes, with_code_names
from pricelake.sources.landing import parsed
from pricelake.workload import feeds
from pricelake.workload.shape import plain

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark, sf_dir):
    return feeds.table(spark, sf_dir, "lineitem")


def _dirty():
    """A price text that depends on the tax rate: grouped, spaced, broken, special or missing."""
    tax, grouped = F.col("l_tax"), F.format_number("l_extendedprice", 2)
    return (
        F.when(tax == 0.0, F.concat(F.lit(" "), grouped, F.lit("  ")))
        .when(tax == 0.01, F.regexp_replace(grouped, ",", " "))
        .when(tax == 0.02, "-")
        .when(tax == 0.03, "")
        .when(tax == 0.04, F.lit(None))
        .when(tax == 0.05, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("d")))
        .when(tax == 0.06, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("e2")))
        .when(tax == 0.07, F.concat(F.lit("1_"), F.col("l_linenumber").cast("string")))
        .otherwise(grouped)
    )


def normalize_price(spark, sf_dir):
    return plain(_lines(spark, sf_dir).select(*LINE, fn.normalize_price(_dirty()).alias("price")))


def clean_price(spark, sf_dir):
    return plain(_lines(spark, sf_dir).select(*LINE, fn.clean_price(_dirty()).alias("price")))


def date_features(spark, sf_dir):
    day = F.when(F.col("l_tax") == 0.0, F.date_format("l_shipdate", "yyyy/MM/dd")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return plain(fn.add_date_features(_lines(spark, sf_dir).select(*LINE, day.alias("res_dt")), "res_dt"))


def code_columns(spark, sf_dir):
    rows = feeds.table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif("p_size", F.lit(7)).alias("size_cd"), F.col("p_brand").alias("brand_cd")
    )
    return fn.code_columns(rows)


def pad_codes(spark, sf_dir):
    return feeds.products(spark, sf_dir)


def split_name(spark, sf_dir):
    name = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.concat_ws(" / ", "p_name", "p_brand", "p_type"))
    item, kind = fn.split_name(name)
    part = feeds.table(spark, sf_dir, "part")
    return part.select("p_partkey", item.alias("item_nm"), kind.alias("kind_nm"))


def parse_regday(spark, sf_dir):
    """Month and day with and without zeros, with spaces, without a slash, with two, and impossible days."""
    rate, ship = F.col("l_discount"), F.col("l_shipdate")
    text = (
        F.when(rate == 0.0, F.date_format(ship, "M/d"))
        .when(rate == 0.01, F.concat(F.lit(" "), F.date_format(ship, "MM/dd"), F.lit("\t")))
        .when(rate == 0.02, F.date_format(ship, "MMdd"))
        .when(rate == 0.03, F.date_format(ship, "MM/dd/1"))
        .when(rate == 0.04, F.lit("2/30"))
        .when(rate == 0.05, F.lit(""))
        .otherwise(F.date_format(ship, "MM/dd"))
    )
    year = F.when(rate != 0.06, F.date_format(ship, "yyyy"))
    return plain(_lines(spark, sf_dir).select(*LINE, fn.date_from_parts(year, text).alias("res_dt")))


def code_lookup(spark, sf_dir):
    coded = _lines(spark, sf_dir).select(
        *LINE,
        F.when(F.col("l_linestatus") == "O", "01").when(F.col("l_returnflag") == "A", "02").otherwise(F.lit("03"))
        .alias("product_cls_cd"),
        feeds._pick(feeds.PATH_CATEGORIES, F.col("l_linenumber") - 1).alias("category_cd"),
        feeds._place().alias("country_cd"),
    )
    return plain(with_code_names(coded))


def list_collapse(spark, sf_dir):
    """Event documents whose leaf is a number, an empty list, a list or a text that looks like one."""
    k = F.get_json_object("props", "$.k")
    leaf = (
        F.when(F.col("event_type") == "click", F.format_string('["%s",1]', k))
        .when(F.col("event_type") == "error", "[]")
        .when(F.col("event_type") == "view", F.format_string('"[%s"', k))
        .otherwise(k)
    )
    doc = F.format_string('{"k": %s, "n": {"k": "x"}}', leaf)
    events = feeds.table(spark, sf_dir, "events").select("event_id", mark_quoted_brackets(doc).alias("value"))
    text = parsed(F.col("value"), "struct<k:string>")["k"]
    return events.select("event_id", fn.first_of_list(text).alias("k"))


def path_attributes(spark, sf_dir):
    """Landing keys out of path texts, some with a region name and some without a region."""
    region = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("country=서울/"))
        .otherwise(F.format_string("country=%d/", F.col("o_custkey")))
    )
    path = F.concat(
        F.lit("raw/api-17/dt="), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/product_cls=01/"), region,
        F.lit("item="), F.col("o_orderstatus"), F.lit("/data.json"),
    )
    paths = feeds.table(spark, sf_dir, "orders").select("o_orderkey", path.alias("file_path"))
    keys = ("dt", "product_cls", "country", "category", "item")
    empty = paths.withColumns({f"{k}_or_empty": fn.path_attribute(F.col("file_path"), k, "") for k in ("country",)})
    return empty.withColumns({k: fn.path_attribute(F.col("file_path"), k) for k in keys}).drop("file_path")


def product_meta_join(spark, sf_dir):
    """Order lines with the codes of their product; one extra metadata row makes product 0 match twice."""
    codes = product_codes(feeds.products(spark, sf_dir), [(0, "616", "01", "21", "中")])
    lines = _lines(spark, sf_dir).select(*LINE, F.nullif("l_partkey", F.lit(7)).alias("product_no"))
    return plain(lookup_join(lines, codes, ["product_no"]))


def product_meta_join5(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(
        *LINE,
        F.when(F.col("l_linestatus") == "O", "01").alias("product_cls_cd"),
        feeds._pick(tuple(CATEGORIES), F.col("l_partkey") % 6).alias("category_cd"),
        F.col("l_partkey").cast("string").alias("item_cd"),
        F.format_string("%02d", F.col("l_partkey") % 120).alias("kind_cd"),
        F.when(F.col("l_returnflag") == "A", "03").otherwise("04").alias("rank_cd"),
    )
    keys = ["product_cls_cd", "category_cd", "item_cd", "kind_cd", "rank_cd"]
    return plain(lookup_join(lines, feeds.products(spark, sf_dir), keys))


def exclude_pseudo_regions(spark, sf_dir):
    county = (
        F.when(F.col("l_discount") == 0.0, "평균")
        .when(F.col("l_discount") == 0.01, "평년")
        .when(F.col("l_discount") != 0.02, F.col("l_returnflag"))
    )
    lines = _lines(spark, sf_dir).select(*LINE, county.alias("county_nm"))
    return plain(lines.where(~F.coalesce(F.col("county_nm").isin(*PSEUDO_REGIONS), F.lit(False))))


def request_grid(spark, sf_dir):
    """Requests of every day an order was placed, as run date."""
    days = feeds.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    return plain(category_requests(days))


def param_tree_explode(spark, sf_dir):
    """One request tree per part; parts of one type have no rank code and so no request."""
    ranks = F.when(F.col("p_type") == "PROMO", F.lit("[]")).otherwise(F.lit('["04","05"]'))
    tree = F.format_string(
        '{"%s":{"products":{"%s":{"varieties":{"%d":{"retail_codes":%s},"x":{"retail_codes":["%d"]}}}}}}',
        "p_type", "p_brand", "p_size", ranks, "p_partkey",
    )
    return tree_requests(feeds.table(spark, sf_dir, "part").select(tree.alias("value")))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_price,
        clean_price,
        date_features,
        code_columns,
        pad_codes,
        split_name,
        parse_regday,
        code_lookup,
        list_collapse,
        path_attributes,
        product_meta_join,
        product_meta_join5,
        exclude_pseudo_regions,
        request_grid,
        param_tree_explode,
    )
}

_LINE = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey"
_WEEKDAYS = "[" + ", ".join(f"'{d}'" for d in WEEKDAY_NAMES) + "]"


def _names(code: str, names: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE {code} {cases} ELSE '{default}' END"


_PRODUCT_COLUMNS = "product_no, product_cls_nm, product_cls_unit, category_nm, item_nm, kind_nm, rank_nm"

ORACLES = {
    "normalize_price": f"""SELECT {_LINE}, CASE WHEN l_tax IN (0.0, 0.01, 0.08) THEN l_extendedprice
  WHEN l_tax = 0.06 THEN l_quantity * 100 END AS price FROM lineitem""",
    "clean_price": f"""SELECT {_LINE}, CASE WHEN l_tax IN (0.0, 0.08) THEN l_extendedprice
  WHEN l_tax = 0.01 AND l_extendedprice < 1000 THEN l_extendedprice
  WHEN l_tax = 0.06 THEN l_quantity * 100 WHEN l_tax = 0.07 THEN CAST(10 + l_linenumber AS DOUBLE) END AS price
FROM lineitem""",
    "date_features": f"""WITH d AS (
  SELECT *, CASE WHEN l_tax <> 0.0 THEN CAST(l_shipdate AS DATE) END AS day FROM lineitem)
SELECT {_LINE}, CAST(day AS VARCHAR) AS res_dt, CAST(year(day) AS BIGINT) AS year, CAST(month(day) AS BIGINT) AS month,
  CAST(extract(week FROM day) AS BIGINT) AS week_of_year, CAST(extract(isodow FROM day) - 1 AS BIGINT) AS weekday_num,
  coalesce(({_WEEKDAYS})[extract(isodow FROM day)], '알수없음') AS weekday_nm,
  coalesce(extract(isodow FROM day) >= 6, false) AS weekend_yn FROM d""",
    "code_columns": """SELECT p_partkey, CAST(NULLIF(p_size, 7) AS VARCHAR) AS size_cd, p_brand AS brand_cd FROM part""",
    "pad_codes": f"WITH {feeds.PRODUCTS_SQL} SELECT * FROM products",
    "split_name": """WITH n AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name
    ELSE concat_ws(' / ', p_name, p_brand, p_type) END AS name FROM part)
SELECT p_partkey, split_part(name, '/', 1) AS item_nm,
  CASE WHEN contains(name, '/') THEN substr(name, strpos(name, '/') + 1) END AS kind_nm FROM n""",
    "parse_regday": f"""SELECT {_LINE}, CASE WHEN l_discount IN (0.02, 0.03, 0.04, 0.05, 0.06) THEN NULL
  ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS res_dt FROM lineitem""",
    "code_lookup": f"""WITH c AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN '01' WHEN l_returnflag = 'A' THEN '02'
    ELSE '03' END AS product_cls_cd, ({feeds._values(feeds.PATH_CATEGORIES)})[l_linenumber] AS category_cd,
    ({feeds._values(feeds.PLACES)})[CAST(l_quantity AS INTEGER) % {len(feeds.PLACES)} + 1] AS country_cd FROM lineitem)
SELECT {_LINE}, product_cls_cd, category_cd, country_cd,
  {_names("product_cls_cd", {"01": "소매", "02": "도매"}, "미분류")} AS product_cls_nm,
  {_names("category_cd", CATEGORIES, "미분류")} AS category_nm,
  {_names("country_cd", {**REGION_NAMES, "all": "전국"}, "기타")} AS country_nm FROM c""",
    "list_collapse": """SELECT event_id, CASE event_type WHEN 'error' THEN NULL
  WHEN 'view' THEN '[' || json_extract_string(props, '$.k') ELSE json_extract_string(props, '$.k') END AS k
FROM events""",
    "path_attributes": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dt, '01' AS product_cls,
  CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN '서울' ELSE CAST(o_custkey AS VARCHAR) END AS country,
  CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '2-HIGH' THEN '서울' ELSE CAST(o_custkey AS VARCHAR) END
    AS country_or_empty,
  CAST(NULL AS VARCHAR) AS category, o_orderstatus AS item FROM orders""",
    "product_meta_join": f"""WITH {feeds.PRODUCTS_SQL},
codes AS (SELECT product_no, item_cd, kind_cd, rank_cd, rank_nm FROM products
  UNION ALL SELECT 0, '616', '01', '21', '中'),
lines AS (SELECT *, NULLIF(l_partkey, 7) AS key_no FROM lineitem)
SELECT {_LINE}, key_no AS product_no, item_cd, kind_cd, rank_cd, rank_nm
FROM lines LEFT JOIN codes ON key_no = product_no""",
    "product_meta_join5": f"""WITH {feeds.PRODUCTS_SQL},
lines AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN '01' END AS product_cls_cd,
    (['100', '200', '300', '400', '500', '600'])[l_partkey % 6 + 1] AS category_cd,
    CAST(l_partkey AS VARCHAR) AS item_cd,
    CASE WHEN l_partkey % 120 < 10 THEN '0' ELSE '' END || l_partkey % 120 AS kind_cd,
    CASE WHEN l_returnflag = 'A' THEN '03' ELSE '04' END AS rank_cd FROM lineitem)
SELECT {_LINE}, product_cls_cd, category_cd, item_cd, kind_cd, rank_cd, {_PRODUCT_COLUMNS}
FROM lines LEFT JOIN products USING (product_cls_cd, category_cd, item_cd, kind_cd, rank_cd)""",
    "exclude_pseudo_regions": f"""SELECT {_LINE}, CASE WHEN l_discount = 0.02 THEN NULL ELSE l_returnflag END AS county_nm
FROM lineitem WHERE l_discount NOT IN (0.0, 0.01)""",
    "request_grid": f"""SELECT CAST(d - 1 AS VARCHAR) AS regday, '01' AS product_cls_code, category_code, country_code
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
  (SELECT unnest({feeds._values(CATEGORIES)}) AS category_code),
  (SELECT unnest({feeds._values(wholesale_regions())}) AS country_code UNION ALL SELECT NULL)""",
    "param_tree_explode": """SELECT p_type AS item_category_code, p_brand AS item_code, CAST(p_size AS VARCHAR) AS kind_code,
  code AS product_rank_code FROM part, (VALUES ('04'), ('05')) AS c(code) WHERE p_type <> 'PROMO'
UNION ALL SELECT p_type, p_brand, 'x', CAST(p_partkey AS VARCHAR) FROM part""",
}
