"""The given tables in the shapes the jobs read: silver tables, dimensions and landed documents.

Every frame covers its whole table. Sales rows keep their order lines through left joins, so a
plan that needs no dimension column drops the join. NULLs, dirty texts and odd document
shapes are put in by value (a tax or discount rate), the same way on the SQL side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.fixed import CATEGORIES, REGION_NAMES
from pricelake.functions import add_date_features, pad_codes
from pricelake.operators.snapshot import month_partitions
from pricelake.session import split_wide_methods

# Places a document can name: every region, the nationwide request and an unknown code.
PLACES = (*REGION_NAMES, "all", "9999")
PATH_CATEGORIES = (*CATEGORIES, "700")
PRODUCT_CATEGORIES = ("100", "200", "300", "500", "600", "700", "800")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, orders: bool = False) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    if orders:
        order = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
        lines = lines.join(order, lines.l_orderkey == order.o_orderkey, "left")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(part, F.col("l_partkey") == part.p_partkey, "left")
        .join(supplier, F.col("l_suppkey") == supplier.s_suppkey, "left")
        .join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")
    )


def _priced() -> Column:
    return F.when(F.col("l_tax") != 0.08, F.col("l_extendedprice"))


def _region() -> dict[str, Column]:
    return {
        "country_cd": F.nullif(F.col("s_nationkey"), F.lit(7)).cast("string"),
        "country_nm": F.nullif(F.col("n_name"), F.lit("NATION_7")),
    }


def api10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product prices; the shipping year is the snapshot."""
    month_day = F.date_format("l_shipdate", "MM/dd")
    direction = (
        F.when(F.col("l_returnflag") == "A", "1")
        .when(F.col("l_returnflag") == "N", "0")
        .when(F.col("l_linestatus") == "F", "2")
    )
    columns = {
        "product_no": F.col("l_partkey").cast("int"),
        "category_nm": F.col("p_type"),
        "item_nm": F.col("p_name"),
        "kind_nm": F.col("p_brand"),
        "product_cls_unit": F.concat(F.col("p_size").cast("string"), F.lit("kg")),
        **_region(),
        "res_dt": F.col("l_shipdate").cast("date"),
        "base_dt": month_day,
        "base_pr": _priced(),
        "prev_1d_dt": month_day,
        "prev_1d_pr": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "direction_tp": direction,
        "direction_pct": F.when(F.col("l_discount") == 0.1, "n/a").otherwise(F.col("l_discount").cast("string")),
        "prev_1m_dt": month_day,
        "prev_1m_pr": F.col("l_extendedprice") + F.col("l_tax"),
        "prev_1y_dt": month_day,
        "prev_1y_pr": F.col("l_quantity"),
        "year": F.date_format("l_shipdate", "yyyy"),
        "month": F.lit("11"),
        "dt": F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("1101")),
    }
    return sales(spark, sf_dir).select(*[c.alias(n) for n, c in columns.items()])


API10_SQL = """
sales AS (
  SELECT * FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey),
api10 AS (
  SELECT CAST(l_partkey AS INTEGER) AS product_no, p_type AS category_nm, p_name AS item_nm, p_brand AS kind_nm,
    p_size || 'kg' AS product_cls_unit, CAST(NULLIF(s_nationkey, 7) AS VARCHAR) AS country_cd,
    NULLIF(n_name, 'NATION_7') AS country_nm, CAST(l_shipdate AS DATE) AS res_dt,
    strftime(l_shipdate, '%m/%d') AS base_dt, CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS base_pr,
    strftime(l_shipdate, '%m/%d') AS prev_1d_dt, l_extendedprice * (1 - l_discount) AS prev_1d_pr,
    CASE WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '0' WHEN l_linestatus = 'F' THEN '2' END
      AS direction_tp,
    CASE WHEN l_discount <> 0.1 THEN l_discount END AS direction_pct,
    strftime(l_shipdate, '%m/%d') AS prev_1m_dt, l_extendedprice + l_tax AS prev_1m_pr,
    strftime(l_shipdate, '%m/%d') AS prev_1y_dt, l_quantity AS prev_1y_pr,
    strftime(l_shipdate, '%Y') AS year, '11' AS month, strftime(l_shipdate, '%Y') || '1101' AS dt
  FROM sales),
snapshot AS (
  SELECT *, direction_tp AS prev_1d_dir_tp, direction_pct AS prev_1d_dir_pct
  FROM api10 WHERE dt = (SELECT max(dt) FROM api10))
"""


def api17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail prices per market; two in ten markets are NULL or of the chain suffix."""
    columns = {
        "res_dt": F.col("l_shipdate").cast("date"),
        "product_no": F.col("l_partkey").cast("double"),
        **_region(),
        "category_nm": F.col("p_type"),
        "item_nm": F.col("p_name"),
        "kind_nm": F.col("p_brand"),
        "rank_nm": F.col("o_orderstatus"),
        "market_nm": F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")),
        "price": _priced(),
    }
    rows = sales(spark, sf_dir, orders=True).select(*[c.alias(n) for n, c in columns.items()])
    return month_partitions(add_date_features(rows, "res_dt"))


API17_SQL = """
sales AS (
  SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey),
api17 AS (
  SELECT CAST(l_shipdate AS DATE) AS res_dt, CAST(NULLIF(s_nationkey, 7) AS VARCHAR) AS country_cd,
    NULLIF(n_name, 'NATION_7') AS country_nm, p_type AS category_nm, p_name AS item_nm, p_brand AS kind_nm,
    o_orderstatus AS rank_nm, NULLIF(o_orderpriority, '1-URGENT') AS market_nm,
    CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS price,
    strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month,
    CAST(extract(week FROM l_shipdate) AS BIGINT) AS week_of_year,
    (['월요일', '화요일', '수요일', '목요일', '금요일', '토요일', '일요일'])[extract(isodow FROM l_shipdate)]
      AS weekday_nm,
    extract(isodow FROM l_shipdate) >= 6 AS weekend_yn
  FROM sales)
"""


def api13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organic prices; market names with one dash, two, none and NULL."""
    priority = F.col("o_orderpriority")
    market = (
        F.when(priority == "1-URGENT", "강남 - 전문점")
        .when(priority == "2-HIGH", "A-대형마트-B")
        .when(priority == "3-MEDIUM", "생협")
        .when(priority == "4-NOT SPECIFIED", None)
        .otherwise(priority)
    )
    columns = {
        "product_cls_cd": F.lit("01"),
        "category_nm": F.col("p_type"),
        "item_cd": F.col("l_linenumber").cast("string"),
        "item_nm": F.col("p_type"),
        "kind_nm": F.col("p_brand"),
        "rank_nm": F.col("o_orderstatus"),
        "country_cd": _region()["country_cd"],
        "market_nm": market,
        "price": _priced(),
        "res_dt": F.col("l_shipdate").cast("date"),
    }
    return month_partitions(sales(spark, sf_dir, orders=True).select(*[c.alias(n) for n, c in columns.items()]))


API13_SQL = """
sales AS (
  SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey),
api13 AS (
  SELECT p_type AS category_nm, CAST(l_linenumber AS VARCHAR) AS item_cd, p_type AS item_nm, p_brand AS kind_nm,
    o_orderstatus AS rank_nm, CAST(NULLIF(s_nationkey, 7) AS VARCHAR) AS country_cd,
    CASE o_orderpriority WHEN '1-URGENT' THEN '강남 - 전문점' WHEN '2-HIGH' THEN 'A-대형마트-B'
      WHEN '3-MEDIUM' THEN '생협' WHEN '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS market_nm,
    CASE o_orderpriority WHEN '1-URGENT' THEN '전문점' WHEN '2-HIGH' THEN '대형마트'
      WHEN '3-MEDIUM' THEN '생협' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'LOW' END AS market_category,
    CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS price, CAST(l_shipdate AS DATE) AS res_dt,
    strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month
  FROM sales)
"""


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of season per product."""
    month = F.explode(F.array(F.col("p_size") % 12 + 1, (F.col("p_size") + 6) % 12 + 1)).alias("month")
    season = (
        F.when(F.col("month").isin(3, 4, 5), "봄")
        .when(F.col("month").isin(6, 7, 8), "여름")
        .when(F.col("month").isin(9, 10, 11), "가을")
        .otherwise("겨울")
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_name", "p_brand", "p_type", F.col("p_partkey").cast("double").alias("product_no"), month)
        .select(
            season.alias("season"),
            "month",
            F.col("p_name").alias("item_nm"),
            F.col("p_brand").alias("kind_nm"),
            "product_no",
            F.col("p_type").alias("category_nm"),
        )
    )


SEASONS_SQL = """
months AS (
  SELECT part.*, unnest([p_size % 12 + 1, (p_size + 6) % 12 + 1]) AS month FROM part),
seasons AS (
  SELECT CASE WHEN month IN (3, 4, 5) THEN '봄' WHEN month IN (6, 7, 8) THEN '여름'
      WHEN month IN (9, 10, 11) THEN '가을' ELSE '겨울' END AS season,
    month, p_name AS item_nm, p_brand AS kind_nm, CAST(p_partkey AS DOUBLE) AS product_no, p_type AS category_nm
  FROM months)
"""


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("country_cd"),
        F.col("n_name").alias("country_nm"),
        (F.col("n_nationkey") * 0.5 + 30).alias("latitude"),
        (F.col("n_nationkey") * 0.25 + 120).alias("longitude"),
    )


def products(spark: SparkSession, sf_dir: str, unpadded: bool = False) -> DataFrame:
    """Product metadata, one row per part."""
    category = F.get(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("p_partkey") % 6).cast("int"))
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_no"),
        F.lit("1").alias("product_cls_cd"),
        F.lit("소매").alias("product_cls_nm"),
        F.concat(F.col("p_size").cast("string"), F.lit("kg")).alias("product_cls_unit"),
        category.alias("category_cd"),
        F.col("p_type").alias("category_nm"),
        F.col("p_partkey").cast("string").alias("item_cd"),
        F.col("p_name").alias("item_nm"),
        (F.col("p_partkey") % 120).cast("string").alias("kind_cd"),
        F.col("p_brand").alias("kind_nm"),
        F.lit("4").alias("rank_cd"),
        F.lit("상품").alias("rank_nm"),
    )
    return raw if unpadded else pad_codes(raw)


PRODUCTS_SQL = """
products AS (
  SELECT p_partkey AS product_no, '01' AS product_cls_cd, '소매' AS product_cls_nm,
    p_size || 'kg' AS product_cls_unit,
    (['100', '200', '300', '400', '500', '600'])[p_partkey % 6 + 1] AS category_cd, p_type AS category_nm,
    CAST(p_partkey AS VARCHAR) AS item_cd, p_name AS item_nm,
    CASE WHEN p_partkey % 120 < 10 THEN '0' ELSE '' END || p_partkey % 120 AS kind_cd, p_brand AS kind_nm,
    '04' AS rank_cd, '상품' AS rank_nm
  FROM part)
"""


# --- landed documents ---------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines to build documents from, spread by order: building is heavy on the CPU, and so are the wide projections that
    parse them, whatever session runs them."""
    split_wide_methods(spark)
    return table(spark, sf_dir, "lineitem").repartition("l_orderkey")


def _dated(spark: SparkSession, sf_dir: str, **more: Column) -> DataFrame:
    """Lines with the texts of their shipping date, which a document names many times and its key once more."""
    days = {"_day": F.date_format("l_shipdate", "yyyy-MM-dd"), "_month_day": F.date_format("l_shipdate", "MM/dd")}
    return _lines(spark, sf_dir).withColumns(days | more)


def _text(value: Column | str) -> Column:
    """A JSON text. Nothing is escaped: the documents hold numbers, dates and fixed texts only."""
    return F.lit(f'"{value}"') if isinstance(value, str) else F.concat(F.lit('"'), value, F.lit('"'))


def _object(members: dict[str, Column | str]) -> Column:
    """A JSON object of columns that hold JSON and of fixed texts, without the members that are NULL. Joining texts takes a fraction of
    what ``to_json`` does."""
    parts, fixed = [], []
    for name, value in members.items():
        if isinstance(value, str):
            fixed.append(f'"{name}":"{value}"')
            continue
        if fixed:
            parts.append(F.lit(",".join(fixed)))
            fixed = []
        parts.append(F.concat(F.lit(f'"{name}":'), value))
    if fixed:
        parts.append(F.lit(",".join(fixed)))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _list(*items: Column) -> Column:
    """A JSON list of columns that hold JSON."""
    return F.concat(F.lit("["), F.concat_ws(",", *[F.coalesce(i, F.lit("null")) for i in items]), F.lit("]"))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _place() -> Column:
    return _pick(PLACES, F.col("l_quantity").cast("int") % len(PLACES))


def _path(feed: str, keys: list[str], *folders: Column) -> Column:
    parts = [F.concat(F.lit(f"{k}="), F.col(k)) for k in keys]
    return F.concat_ws("/", F.lit(f"raw/{feed}"), *parts, *folders, F.lit("data.json"))


def _price(step: int) -> Column:
    """Price with two decimals and commas between thousands; those of the usual size are put together from their cents."""
    price = F.col("l_extendedprice") + step
    cents = F.round(price * 100).cast("bigint").cast("string")
    small = F.concat(F.left(cents, F.length(cents) - 2), F.lit("."), F.right(cents, F.lit(2)))
    large = F.concat(F.left(cents, F.length(cents) - 5), F.lit(","), F.substring(cents, -5, 3), F.lit("."), F.right(cents, F.lit(2)))
    return F.when(price.between(1000, 999_999), large).when(price.between(1, 999), small).otherwise(F.format_number(price, 2))


def _plain_price(step: int) -> Column:
    return (F.col("l_extendedprice") + step).cast("decimal(14,2)").cast("string")


def category_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response of the category feed per order line: an item list, one item, no data, an error,
    broken text or a list with a hole."""
    rate = F.col("l_discount")

    def item(k: int) -> Column:
        base = F.when(rate == 0.1, "-").when(rate == 0.09, "").when(rate == 0.08, "1 2").otherwise(_price(10 * k + 1))
        return _object(
            {
                "item_name": _text(F.concat(F.lit(" P"), F.col("l_partkey").cast("string"), F.lit(" "))),
                "item_code": _text(F.col("l_suppkey").cast("string")),
                "kind_name": F.when(rate != 0.0, '"kind"'),
                "kind_code": f"0{k}",
                "rank": F.when(rate == 0.01, "null").otherwise('"상품"'),
                "rank_code": "04",
                "unit": "1kg",
                "day1": _text(F.concat(F.lit("당일 ("), F.col("_month_day"), F.lit(")"))),
                **{f"day{j}": f"D{j}" for j in range(2, 8)},
                "dpr1": _text(base),
                **{f"dpr{j}": _text(_plain_price(10 * k + j)) for j in range(2, 8)},
            }
        )

    def response(items: Column) -> Column:
        condition = {"p_regday": _text(F.concat(F.lit(" "), F.col("_day"), F.lit(" "))), "p_number": F.col("l_linenumber").cast("string")}
        return _object({"condition": _list(_object(condition)), "data": _object({"error_code": "000", "item": items})})

    tax, flag = F.col("l_tax"), F.col("l_returnflag")
    value = (
        F.when(tax == 0.0, '{"condition":[],"data":["001"]}')
        .when(tax == 0.01, '{"data":{"error_code":"000","item":[')
        .when(tax == 0.02, '{"data":{"error_code":"200"}}')
        .when((tax == 0.03) & (flag == "A"), response(F.lit("[null]")))
        .when(flag == "A", response(_list(item(1), item(2))))
        .when(flag == "N", response(item(1)))
        .otherwise(response(_list(item(1))))
    )
    keys = {
        "dt": F.col("_day"),
        "product_cls": F.when(F.col("l_linestatus") == "O", "01").otherwise("02"),
        "country": _place(),
        "category": _pick(PATH_CATEGORIES, F.col("l_linenumber") - 1),
    }
    docs = _dated(spark, sf_dir).select(value.alias("value"), *[c.alias(k) for k, c in keys.items()])
    return docs.withColumn("file_path", _path("api-1", list(keys)))


def _values(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CATEGORY_DOCS_SQL = f"""
docs AS (
  SELECT *, strftime(l_shipdate, '%Y-%m-%d') AS dt,
    CASE WHEN l_linestatus = 'O' THEN '01' ELSE '02' END AS product_cls,
    ({_values(PLACES)})[CAST(l_quantity AS INTEGER) % {len(PLACES)} + 1] AS country,
    ({_values(PATH_CATEGORIES)})[l_linenumber] AS category,
    CASE WHEN l_tax < 0.025 OR (l_tax = 0.03 AND l_returnflag = 'A') THEN 0
      WHEN l_returnflag = 'A' THEN 2 ELSE 1 END AS n_items
  FROM lineitem),
items AS (
  SELECT docs.*, unnest(range(1, n_items + 1)) AS k FROM docs),
labelled AS (
  SELECT *, 'raw/api-1/dt=' || dt || '/product_cls=' || product_cls || '/country=' || country || '/category='
      || category || '/data.json' AS file_path, k - 1 AS pos,
    'P' || l_partkey AS item_nm, CAST(l_suppkey AS VARCHAR) AS item_cd,
    CASE WHEN l_discount <> 0.0 THEN 'kind' ELSE '' END AS kind_nm, '0' || k AS kind_cd,
    CASE WHEN l_discount <> 0.01 THEN '상품' END AS rank_nm, '04' AS rank_cd, '1kg' AS unit,
    '당일 (' || strftime(l_shipdate, '%m/%d') || ')' AS base_dt, 'D2' AS prev_1d_dt, 'D3' AS prev_1w_dt,
    'D4' AS prev_2w_dt, 'D5' AS prev_1m_dt, 'D6' AS prev_1y_dt, 'D7' AS avg_tp,
    CASE WHEN l_discount < 0.075 THEN round(l_extendedprice + 10 * k + 1, 2) END AS base_pr,
    round(l_extendedprice + 10 * k + 2, 2) AS prev_1d_pr, round(l_extendedprice + 10 * k + 3, 2) AS prev_1w_pr,
    round(l_extendedprice + 10 * k + 4, 2) AS prev_2w_pr, round(l_extendedprice + 10 * k + 5, 2) AS prev_1m_pr,
    round(l_extendedprice + 10 * k + 6, 2) AS prev_1y_pr, round(l_extendedprice + 10 * k + 7, 2) AS avg_pr
  FROM items)
"""


def product_docs(spark: SparkSession, sf_dir: str, response_day: Column | None = None) -> DataFrame:
    """One response of the product feed per order line, landed under its shipping year. ``response_day`` is the date its
    records carry, the shipping date unless given.

    Leaves are texts, empty lists, one-element lists and texts that begin with a bracket; the price field is a
    list of one or two records, an empty list, a text, missing, or the document is broken.
    """
    rate, flag = F.col("l_discount"), F.col("l_returnflag")
    day = F.date_format("l_shipdate" if response_day is None else response_day, "yyyy-MM-dd")

    def record(k: int) -> Column:
        direction = F.when(rate == 0.0, "[]").when(rate == 0.01, '["1"]').otherwise('"0"')
        change = F.when(rate == 0.02, "[n/a]").otherwise(rate.cast("string"))
        name = F.when(flag == "N", F.lit("plain")).otherwise(F.concat(F.lit("P"), F.col("l_partkey"), F.lit("/a / b")))
        cls = _text(F.when(F.col("l_linestatus") == "F", "02").otherwise("01")) if k == 2 else "01"
        return _object(
            {
                "product_cls_code": cls,
                "product_cls_name": "소매",
                "category_code": _text(_pick(PRODUCT_CATEGORIES, F.col("l_linenumber") - 1)),
                "category_name": "부류",
                "productno": _text(F.col("l_partkey").cast("string")),
                "lastest_day": _text(F.col("_response_day")),
                "productName": _text(name),
                "unit": "1kg",
                **{f"day{j}": _text(F.col("_month_day")) for j in range(1, 5)},
                "dpr1": F.when(rate == 0.03, "[]").otherwise(_text(_price(10 * k + 1))),
                "dpr2": _text(F.concat(F.lit(" "), _price(10 * k + 2), F.lit(" "))),
                "dpr3": _text(F.when(rate == 0.04, "-").otherwise(_plain_price(10 * k + 3))),
                "dpr4": _text(_plain_price(10 * k + 4)),
                "direction": direction,
                "value": _text(change),
                "county_code": _text(_place()),
                "county_name": "지역",
            }
        )

    def response(price: Column) -> Column:
        condition = _list(_list(_text(F.col("_response_day")), _text("x")))
        return _object({"condition": condition, "error_code": "000", "price": price})

    tax = F.col("l_tax")
    value = (
        F.when(tax == 0.0, response(_text("none")))
        .when(tax == 0.01, '{"price":[{"productno":"1"')
        .when(tax == 0.02, response(F.lit("[]")))
        .when(tax == 0.03, response(F.lit(None).cast("string")))
        .when(flag == "A", response(_list(record(1), record(2))))
        .otherwise(response(_list(record(1))))
    )
    keys = {
        "dt": F.concat(F.substring("_day", 1, 4), F.lit("1101")),
        "product_cls": F.lit("01"),
        "country": _place(),
    }
    docs = _dated(spark, sf_dir, _response_day=day).select(
        value.alias("value"), *[c.alias(k) for k, c in keys.items()], "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return docs.select("value", *keys, _path("api-10", list(keys), line).alias("file_path"))


PRODUCT_DOCS_SQL = f"""
docs AS (
  SELECT *, strftime(l_shipdate, '%Y') || '1101' AS dt,
    ({_values(PLACES)})[CAST(l_quantity AS INTEGER) % {len(PLACES)} + 1] AS country,
    CASE WHEN l_tax < 0.035 THEN 0 WHEN l_returnflag = 'A' THEN 2 ELSE 1 END AS n_items
  FROM lineitem),
items AS (
  SELECT docs.*, unnest(range(1, n_items + 1)) AS k FROM docs),
raw_rows AS (
  SELECT *, 'raw/api-10/dt=' || dt || '/product_cls=01/country=' || country || '/' || l_orderkey || '-'
      || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '/data.json' AS file_path, k - 1 AS pos,
    CASE WHEN k = 2 AND l_linestatus = 'F' THEN '02' ELSE '01' END AS product_cls_code,
    ({_values(PRODUCT_CATEGORIES)})[l_linenumber] AS category_code,
    CASE WHEN l_returnflag = 'N' THEN 'plain' ELSE 'P' || l_partkey || '/a / b' END AS product_name,
    CASE WHEN l_discount = 0.0 THEN NULL WHEN l_discount = 0.01 THEN '1' ELSE '0' END AS direction,
    CASE WHEN l_discount <> 0.03 THEN round(l_extendedprice + 10 * k + 1, 2) END AS price1,
    round(l_extendedprice + 10 * k + 2, 2) AS price2,
    CASE WHEN l_discount <> 0.04 THEN round(l_extendedprice + 10 * k + 3, 2) END AS price3,
    round(l_extendedprice + 10 * k + 4, 2) AS price4
  FROM items)
"""


def _region_record(step: int) -> Column:
    rate = F.col("l_discount")
    county = (
        F.when(rate == 0.0, "평균").when(rate == 0.01, "평년").when(rate == 0.02, None).otherwise(F.lit("시장지역"))
    )
    day = (
        F.when(rate == 0.03, F.date_format("l_shipdate", "M/d"))
        .when(rate == 0.04, F.date_format("l_shipdate", "MMdd"))
        .otherwise(F.date_format("l_shipdate", "MM/dd"))
    )
    return _object(
        {
            "itemname": "품목",
            "kindname": "품종",
            "countyname": _text(county),
            "marketname": _text(F.concat(F.lit("M"), F.col("l_suppkey"))),
            "yyyy": _text(F.when(rate != 0.05, F.date_format("l_shipdate", "yyyy"))),
            "regday": _text(day),
            "price": _text(F.when(rate == 0.06, "-").otherwise(_price(step))),
        }
    )


def region_docs(spark: SparkSession, sf_dir: str, backfill: bool = False) -> DataFrame:
    """One landed document of the region feed per order line: a list of one or two records.

    Daily documents lie under their day and name a region by code; backfilled ones lie under
    their year and name it by name.
    """
    tax, flag = F.col("l_tax"), F.col("l_returnflag")
    value = (
        F.when(tax == 0.0, "[]")
        .when(tax == 0.01, '[{"price":"1"},')
        .when(flag == "A", _list(_region_record(1), _region_record(2)))
        .otherwise(_list(_region_record(1)))
    )
    part_no = F.col("l_partkey")
    place = _pick((*REGION_NAMES.values(), "all", "9999"), F.col("l_quantity").cast("int") % len(PLACES))
    keys = {
        "dt": F.date_format("l_shipdate", "yyyy" if backfill else "yyyy-MM-dd"),
        "product_cls": F.when(F.col("l_linestatus") == "O", "01").otherwise("02"),
        "country": place if backfill else _place(),
        "category": _pick(tuple(CATEGORIES), part_no % 6),
        "item": part_no.cast("string"),
        "kind": F.format_string("%02d", part_no % 120),
        "product_rank": F.lit("04"),
    }
    docs = _lines(spark, sf_dir).select(value.alias("value"), *[c.alias(k) for k, c in keys.items()])
    return docs.withColumn("file_path", _path("api-17", list(keys)))


REGION_ROWS_SQL = f"""
lines AS (
  SELECT *, CASE WHEN l_tax < 0.015 THEN 0 WHEN l_returnflag = 'A' THEN 2 ELSE 1 END AS n_items,
    CASE WHEN l_linestatus = 'O' THEN '01' ELSE '02' END AS product_cls,
    ({_values(PLACES)})[CAST(l_quantity AS INTEGER) % {len(PLACES)} + 1] AS place,
    ({_values([*REGION_NAMES.values(), '기타', '기타'])})[CAST(l_quantity AS INTEGER) % {len(PLACES)} + 1] AS place_nm
  FROM lineitem),
records AS (
  SELECT lines.*, unnest(range(1, n_items + 1)) AS k, CAST(l_shipdate AS DATE) AS ship FROM lines),
dated AS (
  SELECT *, CASE WHEN l_discount IN (0.04, 0.05) THEN NULL ELSE ship END AS res_dt,
    CASE WHEN l_discount <> 0.06 THEN round(l_extendedprice + k, 2) END AS price
  FROM records),
region_rows AS (
  SELECT *, CAST(extract(week FROM res_dt) AS BIGINT) AS week_of_year,
    CAST(extract(isodow FROM res_dt) - 1 AS BIGINT) AS weekday_num,
    coalesce((['월요일', '화요일', '수요일', '목요일', '금요일', '토요일', '일요일'])[extract(isodow FROM res_dt)],
      '알수없음') AS weekday_nm,
    coalesce(extract(isodow FROM res_dt) >= 6, false) AS weekend_yn,
    strftime(res_dt, '%Y') AS year, strftime(res_dt, '%m') AS month
  FROM dated WHERE l_discount NOT IN (0.0, 0.01))
"""


def region_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of the region feed before landing: two records, one record, an error or no data."""
    tax, flag = F.col("l_tax"), F.col("l_returnflag")

    def response(items: Column) -> Column:
        return _object({"data": _object({"error_code": "000", "item": items})})

    value = (
        F.when(tax == 0.0, '{"data":["001"]}')
        .when(tax == 0.01, '{"data":{"error_code":"900"}}')
        .when(flag == "A", response(_list(_region_record(1), _region_record(2))))
        .when(flag == "N", response(_region_record(1)))
        .otherwise(response(_list(_region_record(1))))
    )
    return _lines(spark, sf_dir).select(value.alias("value"))
