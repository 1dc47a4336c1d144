"""Gold models and the data checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.fixed import CHAIN_CHANNEL, DROP, MARKET_CATEGORIES, RISE, TRADITIONAL_CHANNEL
from pricelake.operators import quality
from pricelake.operators.ranking import rank_by
from pricelake.plans import gold
from pricelake.workload import feeds
from pricelake.workload.shape import plain, rounded

STAMP = "2026-01-01 00:00:00"
# Suffix that stands for a retail chain among the order priorities.
SUFFIX = "-HIGH"


def snapshot(spark, sf_dir):
    return gold.latest_snapshot(feeds.api10(spark, sf_dir))


def latest_snapshot(spark, sf_dir):
    return plain(snapshot(spark, sf_dir))


def latest_snapshot_rank(spark, sf_dir):
    ranked = rank_by(feeds.api10(spark, sf_dir), "dt", "rnk")
    return plain(ranked.withColumn("direction_pct", F.col("direction_pct").try_cast("double")))


def price_rise_ranked(spark, sf_dir):
    return plain(gold.price_changes_ranked(snapshot(spark, sf_dir), RISE))


def price_drop_ranked(spark, sf_dir):
    return plain(gold.price_changes_ranked(snapshot(spark, sf_dir), DROP))


def price_rise_top3(spark, sf_dir):
    return plain(gold.price_change_top3(snapshot(spark, sf_dir), RISE))


def price_drop_top3(spark, sf_dir):
    return plain(gold.price_change_top3(snapshot(spark, sf_dir), DROP))


def price_region_count(spark, sf_dir):
    return gold.price_region_count(snapshot(spark, sf_dir))


def direction_count(spark, sf_dir):
    return gold.direction_count(snapshot(spark, sf_dir))


def update_status(spark, sf_dir):
    return plain(gold.update_status(snapshot(spark, sf_dir)))


def _season_inputs(spark, sf_dir):
    return snapshot(spark, sf_dir), feeds.coordinates(spark, sf_dir), feeds.seasons(spark, sf_dir)


def season_region_all(spark, sf_dir):
    return plain(gold.season_region_all(*_season_inputs(spark, sf_dir)))


def season_region_product(spark, sf_dir):
    return plain(gold.season_region_product(*_season_inputs(spark, sf_dir)))


def eco_market_category(spark, sf_dir):
    labelled = gold.eco_market_category(feeds.api13(spark, sf_dir))
    return plain(labelled.select("res_dt", "item_cd", "country_cd", "market_nm", "market_category", "price"))


def eco_price_stats(spark, sf_dir):
    return plain(rounded(gold.eco_price_stats(feeds.api13(spark, sf_dir), F.lit(STAMP)), "avg_price"))


def retail_channel_comparison(spark, sf_dir):
    mart = gold.retail_channel_comparison(feeds.api17(spark, sf_dir), F.lit(STAMP), SUFFIX)
    return plain(rounded(mart, "avg_price"))


def retail_region_comparison(spark, sf_dir):
    return plain(rounded(gold.retail_region_comparison(feeds.api17(spark, sf_dir), F.lit(STAMP)), "avg_price"))


def load_stamp(spark, sf_dir):
    """The default load stamp: present, and one value per run."""
    mart = gold.retail_region_comparison(feeds.api17(spark, sf_dir))
    return mart.groupBy("country_nm").agg(
        F.count_if(F.col("created_at").isNull()).alias("unstamped"),
        F.countDistinct("created_at").alias("stamps"),
        F.count("*").alias("mart_rows"),
    )


def dq_not_null(spark, sf_dir):
    eco = gold.eco_price_stats(feeds.api13(spark, sf_dir), F.lit(STAMP))
    columns = ["res_dt", "item_cd", "market_category", "record_count", "avg_price"]
    return quality.not_null(eco, "mart_eco_price_statistics_by_category", columns)


def dq_accepted_values(spark, sf_dir):
    eco = gold.eco_price_stats(feeds.api13(spark, sf_dir), F.lit(STAMP))
    return quality.accepted_values(eco, "mart_eco_price_statistics_by_category", "market_category", MARKET_CATEGORIES)


def dq_unique_rank(spark, sf_dir):
    """The rank key of the mart, and a key that is known to repeat."""
    top = gold.price_change_top3(snapshot(spark, sf_dir), RISE)
    good = quality.unique_key(top, "mart_price_rise_top3", ["country_cd", "ranking"])
    return good.unionAll(quality.unique_key(feeds.api10(spark, sf_dir), "api10", ["country_cd", "dt"]))


def dq_not_empty(spark, sf_dir):
    top = gold.price_change_top3(snapshot(spark, sf_dir), RISE)
    nothing = gold.price_change_top3(snapshot(spark, sf_dir), "no such direction")
    return quality.not_empty(top, "mart_price_rise_top3").unionAll(quality.not_empty(nothing, "planted"))


def dq_numeric(spark, sf_dir):
    return quality.numeric_text(feeds.api10(spark, sf_dir), "api10", "direction_pct")


def count_reconcile(spark, sf_dir):
    """The snapshot must hold as many rows as its source's newest date; one without rises must not."""
    source, model = feeds.api10(spark, sf_dir), snapshot(spark, sf_dir)
    good = quality.reconcile_newest(source, model, "api10")
    return good.unionAll(quality.reconcile_newest(source, model.where("prev_1d_dir_tp <> '1'"), "planted"))


def dq_season_month(spark, sf_dir):
    season = gold.season_region_all(*_season_inputs(spark, sf_dir))
    good = quality.same_month(season, "stg_season_region_all_product", "present_month", "season_month")
    planted = season.withColumn("season_month", F.substring("base_dt", 1, 2).cast("int"))
    return good.unionAll(quality.same_month(planted, "planted", "present_month", "season_month"))


QUERIES = {
    f.__name__: f
    for f in (
        latest_snapshot,
        latest_snapshot_rank,
        price_rise_ranked,
        price_drop_ranked,
        price_rise_top3,
        price_drop_top3,
        price_region_count,
        direction_count,
        update_status,
        season_region_all,
        season_region_product,
        eco_market_category,
        eco_price_stats,
        retail_channel_comparison,
        retail_region_comparison,
        load_stamp,
        dq_not_null,
        dq_accepted_values,
        dq_unique_rank,
        dq_season_month,
        dq_not_empty,
        dq_numeric,
        count_reconcile,
    )
}

_RANK = """row_number() OVER (PARTITION BY country_cd ORDER BY prev_1d_dir_pct DESC NULLS LAST,
      product_no NULLS LAST, category_nm NULLS LAST, item_nm NULLS LAST, kind_nm NULLS LAST,
      product_cls_unit NULLS LAST, country_nm NULLS LAST, res_dt NULLS LAST, base_dt NULLS LAST,
      base_pr NULLS LAST, prev_1d_dt NULLS LAST, prev_1d_pr NULLS LAST)"""


def _ranked(direction: str) -> str:
    return f"""WITH {feeds.API10_SQL}
SELECT CAST(product_no AS BIGINT) AS product_no, category_nm, item_nm, kind_nm, product_cls_unit, country_cd,
  country_nm, CAST(res_dt AS VARCHAR) AS res_dt, base_dt, base_pr, prev_1d_dt, prev_1d_pr, prev_1d_dir_pct,
  CAST({_RANK} AS BIGINT) AS ranking
FROM snapshot WHERE prev_1d_dir_tp = '{direction}'"""


def _top3(direction: str) -> str:
    return f"""SELECT item_nm, kind_nm, product_cls_unit, country_cd, country_nm, res_dt, base_dt, base_pr,
  prev_1d_dt, prev_1d_pr, prev_1d_dir_pct, ranking FROM ({_ranked(direction)}) WHERE ranking <= 3"""


_SEASON = f"""{feeds.API10_SQL}, {feeds.SEASONS_SQL},
joined AS (
  SELECT snapshot.*, n_nationkey * 0.5 + 30 AS latitude, n_nationkey * 0.25 + 120 AS longitude, season,
    seasons.month AS season_month
  FROM snapshot LEFT JOIN nation ON snapshot.country_cd = CAST(n_nationkey AS VARCHAR)
  LEFT JOIN seasons ON snapshot.product_no = seasons.product_no AND seasons.month = 11)"""
_SEASON_SELECT = """SELECT CAST(product_no AS BIGINT) AS product_no, category_nm, item_nm, kind_nm, product_cls_unit,
  country_nm, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, dt, base_dt, base_pr,
  prev_1y_dt, prev_1y_pr, CAST(11 AS BIGINT) AS present_month, season, CAST(season_month AS BIGINT) AS season_month
FROM joined"""

_ECO_KEYS = "res_dt, item_cd, item_nm, category_nm, market_category"
_ECO = f"""{feeds.API13_SQL},
eco AS (
  SELECT {_ECO_KEYS}, count(*) AS record_count, round(avg(price), 4) AS avg_price, min(price) AS min_price,
    max(price) AS max_price, '{STAMP}' AS created_at, year, month
  FROM api13 WHERE price IS NOT NULL GROUP BY {_ECO_KEYS}, year, month)"""

_STATS = """round(avg(price), 4) AS avg_price, min(price) AS min_price, max(price) AS max_price,
  count(*) AS record_count, count(DISTINCT market_nm) AS market_count"""
_DAYS = """CAST(res_dt AS VARCHAR) AS res_dt, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
  week_of_year, weekday_nm, weekend_yn"""
_CHANNEL = f"CASE WHEN market_nm LIKE '%{SUFFIX}' THEN '{CHAIN_CHANNEL}' ELSE '{TRADITIONAL_CHANNEL}' END"


def _check(table: str, check: str, column: str, failing: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name,
  CAST(n AS BIGINT) AS failing_rows, n = 0 AS passed FROM ({failing})"""


def _eco_nulls(column: str) -> str:
    failing = f"SELECT count(*) AS n FROM eco WHERE {column} IS NULL"
    return _check("mart_eco_price_statistics_by_category", "not_null", column, failing)


#: Counts over the rises of the newest snapshot and over the snapshot itself.
_REPEATED_RANKS = f"""SELECT count(*) AS n FROM (
  SELECT 1 FROM (SELECT country_cd, {_RANK} AS ranking FROM snapshot WHERE prev_1d_dir_tp = '1')
  WHERE ranking <= 3 GROUP BY country_cd, ranking HAVING count(*) > 1)"""
_MISSING_ROWS = "SELECT abs((SELECT count(*) FROM api10 WHERE dt = (SELECT max(dt) FROM api10)) - count(*)) AS n FROM snapshot"

ORACLES = {
    "latest_snapshot": f"""WITH {feeds.API10_SQL}
SELECT CAST(product_no AS BIGINT) AS product_no, category_nm, item_nm, kind_nm, product_cls_unit, country_cd,
  country_nm, CAST(res_dt AS VARCHAR) AS res_dt, base_dt, base_pr, prev_1d_dt, prev_1d_pr, prev_1d_dir_tp,
  prev_1d_dir_pct, prev_1m_dt, prev_1m_pr, prev_1y_dt, prev_1y_pr, dt FROM snapshot""",
    "latest_snapshot_rank": f"""WITH {feeds.API10_SQL}
SELECT * REPLACE (CAST(product_no AS BIGINT) AS product_no, CAST(res_dt AS VARCHAR) AS res_dt),
  CAST(rank() OVER (ORDER BY dt DESC) AS BIGINT) AS rnk FROM api10""",
    "price_rise_ranked": _ranked(RISE),
    "price_drop_ranked": _ranked(DROP),
    "price_rise_top3": _top3(RISE),
    "price_drop_top3": _top3(DROP),
    "price_region_count": f"""WITH {feeds.API10_SQL}
SELECT country_nm, CAST(sum(CASE WHEN prev_1d_dir_tp = '1' THEN 1 ELSE 0 END) AS BIGINT) AS rise_count,
  CAST(sum(CASE WHEN prev_1d_dir_tp = '0' THEN 1 ELSE 0 END) AS BIGINT) AS drop_count,
  CAST(sum(CASE WHEN prev_1d_dir_tp = '2' THEN 1 ELSE 0 END) AS BIGINT) AS keep_count
FROM snapshot GROUP BY country_nm""",
    "direction_count": f"""WITH {feeds.API10_SQL}
SELECT item_nm, kind_nm, prev_1d_dir_tp, count(prev_1d_dir_tp) AS direction_count
FROM snapshot WHERE prev_1d_dir_tp IS NOT NULL GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "update_status": f"""WITH {feeds.API10_SQL}
SELECT count(*) AS row_count, count(DISTINCT country_nm) AS country_count,
  CAST(max(res_dt) AS VARCHAR) AS latest_date FROM snapshot""",
    "season_region_all": f"WITH {_SEASON} {_SEASON_SELECT}",
    "season_region_product": f"WITH {_SEASON} {_SEASON_SELECT} WHERE season IS NOT NULL",
    "eco_market_category": f"""WITH {feeds.API13_SQL}
SELECT CAST(res_dt AS VARCHAR) AS res_dt, item_cd, country_cd, market_nm,
  CASE WHEN market_nm LIKE '%-%' THEN trim(split_part(market_nm, '-', 2)) ELSE market_nm END AS market_category,
  price FROM api13""",
    "eco_price_stats": f"WITH {_ECO} SELECT * REPLACE (CAST(res_dt AS VARCHAR) AS res_dt) FROM eco",
    "retail_channel_comparison": f"""WITH {feeds.API17_SQL}
SELECT {_DAYS}, {_CHANNEL} AS channel_type, category_nm, item_nm, kind_nm, rank_nm, {_STATS}, '{STAMP}' AS created_at
FROM api17 WHERE price IS NOT NULL AND market_nm IS NOT NULL
GROUP BY api17.res_dt, api17.year, api17.month, week_of_year, weekday_nm, weekend_yn, {_CHANNEL}, category_nm,
  item_nm, kind_nm, rank_nm""",
    "retail_region_comparison": f"""WITH {feeds.API17_SQL}
SELECT {_DAYS}, country_cd, country_nm, category_nm, item_nm, kind_nm, rank_nm, {_STATS}, '{STAMP}' AS created_at
FROM api17 WHERE price IS NOT NULL AND country_nm IS NOT NULL
GROUP BY api17.res_dt, api17.year, api17.month, week_of_year, weekday_nm, weekend_yn, country_cd, country_nm,
  category_nm, item_nm, kind_nm, rank_nm""",
    "load_stamp": f"""WITH {feeds.API17_SQL}
SELECT country_nm, CAST(0 AS BIGINT) AS unstamped, CAST(1 AS BIGINT) AS stamps, count(*) AS mart_rows
FROM (SELECT DISTINCT res_dt, country_cd, country_nm, category_nm, item_nm, kind_nm, rank_nm FROM api17
  WHERE price IS NOT NULL AND country_nm IS NOT NULL) GROUP BY country_nm""",
    "dq_not_null": f"WITH {_ECO} "
    + " UNION ALL ".join(
        _eco_nulls(c) for c in ("res_dt", "item_cd", "market_category", "record_count", "avg_price")
    ),
    "dq_accepted_values": f"WITH {_ECO} "
    + _check(
        "mart_eco_price_statistics_by_category",
        "accepted_values",
        "market_category",
        "SELECT count(*) AS n FROM eco WHERE market_category NOT IN ("
        + ", ".join(f"'{v}'" for v in MARKET_CATEGORIES)
        + ")",
    ),
    "dq_unique_rank": f"WITH {feeds.API10_SQL} "
    + _check("mart_price_rise_top3", "unique", "country_cd,ranking", _REPEATED_RANKS)
    + " UNION ALL "
    + _check(
        "api10",
        "unique",
        "country_cd,dt",
        "SELECT count(*) AS n FROM (SELECT country_cd, dt FROM api10 GROUP BY 1, 2 HAVING count(*) > 1)",
    ),
    "dq_season_month": f"WITH {_SEASON} "
    + _check(
        "stg_season_region_all_product",
        "same_month",
        "present_month,season_month",
        "SELECT count(*) AS n FROM joined WHERE 11 <> season_month",
    )
    + " UNION ALL "
    + _check(
        "planted",
        "same_month",
        "present_month,season_month",
        "SELECT count(*) AS n FROM joined WHERE month(res_dt) <> 11",
    ),
    "dq_not_empty": f"WITH {feeds.API10_SQL} "
    + _check(
        "mart_price_rise_top3",
        "not_empty",
        "",
        "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n FROM snapshot WHERE prev_1d_dir_tp = '1'",
    )
    + " UNION ALL "
    + _check("planted", "not_empty", "", "SELECT 1 AS n"),
    "dq_numeric": "WITH t AS (SELECT count(*) AS n FROM lineitem WHERE l_discount = 0.1) "
    + _check("api10", "numeric", "direction_pct", "SELECT n FROM t"),
    "count_reconcile": f"WITH {feeds.API10_SQL} "
    + _check("api10", "reconcile", "dt", _MISSING_ROWS)
    + " UNION ALL "
    + _check(
        "planted",
        "reconcile",
        "dt",
        "SELECT count(*) AS n FROM snapshot WHERE prev_1d_dir_tp = '1' OR prev_1d_dir_tp IS NULL",
    ),
}
