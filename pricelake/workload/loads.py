"""The loads end to end: landed, read, loaded, run again, registered, and read by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators import documents as ops
from pricelake.operators import registry, sinks
from pricelake.operators.landing_keys import organic_keys
from pricelake.operators.requests import product_requests
from pricelake.plans import build, gold, loads
from pricelake.plans import silver as plans
from pricelake.schemas import SNAPSHOT_PARTITIONS, silver_read_schema
from pricelake.session import work_path
from pricelake.sources import landing
from pricelake.workload import feeds
from pricelake.workload.gold import ORACLES as GOLD_ORACLES
from pricelake.workload.shape import plain
from pricelake.workload.silver import ORACLES as SILVER_ORACLES
from pricelake.workload.silver import REGION_SQL, product_codes
from pricelake.workload.storage import stamped_sql

MIDDLE = "1995-06-30"


def _database(spark, name):
    """An empty database of this name."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    registry.create_databases(spark, work_path(spark, "databases"), (name,))
    return name


def api1_load(spark, sf_dir):
    """Category documents landed, loaded in two halves with days of the first run again, the second half's partitions added by name.

    Wholesale documents name their day without dashes. Two more loads bring documents of no day: nothing stored may change."""
    root, path = work_path(spark, "landing"), work_path(spark, "api1")
    # Landed by year: a folder for every day, class, region and category would be mostly folders here, so these keys travel with
    # the document.
    docs = feeds.category_docs(spark, sf_dir)
    day = F.when(F.col("product_cls") == "02", F.replace("dt", F.lit("-"))).otherwise(F.col("dt")).alias("day")
    packed = F.to_json(F.struct("value", "dt", day, "product_cls", "country", "category"))
    keys = sinks.land_documents(docs.select(packed.alias("value"), F.substring("dt", 1, 4).alias("dt"), "product_cls"), root, compression="gzip")
    landed = landing.read_documents(spark, root, keys).select("file_path", F.col("dt").alias("folder"), F.col("value").alias("landed"))
    fields = landing.parsed(F.col("landed"), "struct<value:string,dt:string,day:string,product_cls:string,country:string,category:string>")
    landed = landing.once(landed.select("file_path", "folder", fields.alias("f")), "f").select("file_path", "folder", "f.*")
    # Each part names its folders too: the day stands inside the documents, so it alone would open every folder for every part.
    in_month = landed.where((F.col("folder") == "1994") & F.col("dt").startswith("1994-03"))

    def load(docs, **more):
        return loads.load_category(docs.drop("dt", "folder").withColumnRenamed("day", "dt"), path, **more)

    load(landed.where((F.col("folder") <= MIDDLE[:4]) & (F.col("dt") <= MIDDLE)))
    name = registry.register_silver(spark, "api1", path, f"{_database(spark, 'pricelake_api1')}.api1")
    later = landed.where((F.col("folder") >= MIDDLE[:4]) & (F.col("dt") > MIDDLE))
    load(later)
    for no_day in (None, "soon"):
        load(in_month.withColumn("day", F.lit(no_day).cast("string")))
    load(in_month)
    days = later.select(F.col("dt").cast("date").alias("day")).distinct()
    written = days.select(F.date_format("day", "yyyy").alias("year"), F.date_format("day", "MM").alias("month"), F.date_format("day", "yyyyMMdd").alias("dt"))
    registry.add_partitions(spark, name, written, SNAPSHOT_PARTITIONS)
    return plain(spark.table(name))


def api10_load(spark, sf_dir):
    """Product documents landed and loaded, the newest landing date once more, every segment read by its name."""
    root, path = work_path(spark, "landing"), work_path(spark, "api10")
    # All records of a year carry its first day, so the batch's date does not hang on the order inside a file.
    docs = feeds.product_docs(spark, sf_dir, F.trunc("l_shipdate", "year")).drop("file_path")
    keys = sinks.land_documents(docs, root, compression="gzip")
    codes = product_codes(spark, sf_dir)
    loads.load_products(landing.read_documents(spark, root, keys), codes, path)
    database, rows = _database(spark, "pricelake_api10"), None
    names = {s: registry.register_silver(spark, "api10", f"{path}/segment={s}", f"{database}.{s}") for s in sinks.SEGMENTS}
    loads.load_products(landing.read_latest(spark, root, keys, "01"), codes, path)
    registry.sync_partitions(spark, list(names.values()))
    for segment, name in names.items():
        part = spark.table(name).withColumn("segment", F.lit(segment))
        rows = part if rows is None else rows.unionAll(part)
    return plain(rows)


def api17_load(spark, sf_dir):
    """Region documents loaded in two halves, both with undated rows, with days of the first run again; the second half into the
    registered table, whose months are swapped."""
    path = work_path(spark, "api17")
    docs, products = feeds.region_docs(spark, sf_dir), feeds.products(spark, sf_dir)
    loads.load_regions(spark, docs.where(F.col("dt") <= MIDDLE), products, path)
    name = registry.register_silver(spark, "api17", path, f"{_database(spark, 'pricelake_api17')}.api17")
    loads.load_regions_into(spark, docs.where(F.col("dt") > MIDDLE), products, name)
    loads.load_regions_into(spark, docs.where(F.col("dt").startswith("1994-03")), products, name)
    return plain(spark.table(name).select(*silver_read_schema("api17").fieldNames()))


def backfill_landing(spark, sf_dir):
    """Backfilled region documents landed below their year and region name, read back as rows of the daily job."""
    root = work_path(spark, "landing")
    docs = feeds.region_docs(spark, sf_dir, backfill=True)
    others = ("category", "item", "kind", "product_rank")
    # These four levels would be a folder for every order line here, so they travel with the document.
    packed = docs.select(F.to_json(F.struct("value", *others)).alias("value"), "dt", "product_cls", "country")
    keys = sinks.land_documents(packed, root, compression="gzip")
    landed = landing.with_path_attributes(landing.read_documents(spark, root, keys), ("dt", "product_cls", "country"))
    fields = landing.parsed(F.col("value"), "struct<value:string," + ",".join(f"{k}:string" for k in others) + ">")
    landed = landed.withColumn("f", fields).select("file_path", "dt", "product_cls", "country", "f.*")
    return plain(plans.region_silver(landed, feeds.products(spark, sf_dir)))


def reject_accounting(spark, sf_dir):
    """Documents of each feed by outcome; some hold a record that is none. Those said to give rows are those that do."""
    holed = F.replace("value", F.lit("}]"), F.lit("},null]"))
    region = feeds.region_docs(spark, sf_dir)
    region = region.withColumn("value", F.when(F.col("item").cast("int") % 3 == 0, holed).otherwise(F.col("value")))
    rows = None
    for feed, docs, explode in (
        ("category", feeds.category_docs(spark, sf_dir), ops.explode_items),
        ("product", feeds.product_docs(spark, sf_dir), ops.explode_prices),
        ("region", region, ops.explode_records),
    ):
        # Both counts in one pass: each document is told its outcome, then exploded.
        told = explode(ops.with_outcome(docs, feed).withColumnRenamed("outcome", "told"), outcomes=True)
        given = F.count_if(F.col("pos") == 0)
        counts = told.groupBy("told").agg(F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("all"), given.alias("given"))
        of_feed = counts.select(F.lit(feed).alias("feed"), F.explode(F.map_from_arrays(F.array("told", F.lit("given")), F.array("all", "given"))))
        rows = of_feed if rows is None else rows.unionAll(of_feed)
    return rows.groupBy("feed", F.col("key").alias("outcome")).agg(F.sum("value").alias("documents"))


def _odd_products(spark, sf_dir):
    """Product documents, some with a record that is none and some without a region, which have no place in a landing zone."""
    docs = feeds.product_docs(spark, sf_dir)
    holed = F.replace("value", F.lit("}]"), F.lit("},null]"))
    docs = docs.withColumn("value", F.when(F.col("country") == "9999", holed).otherwise(F.col("value")))
    return docs.withColumn("country", F.nullif(F.col("country"), F.lit("all")))


def load_rejects(spark, sf_dir):
    """Documents given, those without a place and those loaded by landing date and outcome, from what landing and load have stored."""
    root, unplaced, outcomes = (work_path(spark, n) for n in ("landing", "unplaced", "outcomes"))
    given = _odd_products(spark, sf_dir).drop("file_path")
    keys = sinks.land_documents(given, root, unplaced=unplaced, run="first", compression="gzip")
    docs, codes, path = landing.read_documents(spark, root, keys), product_codes(spark, sf_dir), work_path(spark, "api10")
    for of_run in (F.col("dt") < "1996", F.col("dt") >= "1996", F.col("dt").startswith("1994")):
        loads.load_products(docs.where(of_run), codes, path, outcomes)
    stored = spark.read.schema("file_path string, outcome string, documents bigint, dt string").parquet(outcomes)
    rejected = loads.rejects(stored).groupBy(F.col("reason").alias("outcome"), "dt").agg(F.sum("documents").alias("documents"))
    loaded = stored.where(~F.col("outcome").isin(*ops.REASONS)).groupBy("outcome", "dt").agg(F.sum("documents").alias("documents"))
    homeless = spark.read.schema(given.schema).parquet(unplaced).groupBy(F.lit("without_place").alias("outcome"), "dt").agg(F.count("*").alias("documents"))
    every = given.groupBy(F.lit("given").alias("outcome"), "dt").agg(F.count("*").alias("documents"))
    return rejected.unionByName(loaded).unionByName(homeless).unionByName(every)


def load_accounting(spark, sf_dir):
    """What each load says of its documents and rows; the counts are taken while it writes."""
    monthly = feeds.category_docs(spark, sf_dir).withColumn("dt", F.concat(F.substring("dt", 1, 8), F.lit("01")))
    products = feeds.products(spark, sf_dir)
    reports = {
        "category": loads.load_category(monthly, work_path(spark, "api1")),
        "product": loads.load_products(_odd_products(spark, sf_dir), product_codes(spark, sf_dir), work_path(spark, "api10")),
        "region": loads.load_regions(spark, feeds.region_docs(spark, sf_dir), products, work_path(spark, "api17")),
    }
    rows = [(feed, of, name, n) for feed, r in reports.items() for of, counts in (("documents", r.documents), ("rows", r.rows)) for name, n in counts.items()]
    return spark.createDataFrame(rows, "feed string, counted string, name string, n bigint")


def product_request_grid(spark, sf_dir):
    """Requests of the product feed for the days orders came in."""
    days = feeds.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    return plain(product_requests(days))


def organic_landing_keys(spark, sf_dir):
    """Keys of organic responses from the request they echo; those without a day are left out."""
    line = feeds.table(spark, sf_dir, "lineitem")
    condition = F.struct(
        F.when(F.col("l_tax") > 0.02, F.date_format("l_shipdate", " yyyy-MM-dd")).alias("p_regday"),
        F.lit("500").alias("p_itemcategorycode"),
        F.col("l_partkey").cast("string").alias("p_itemcode"),
        F.when(F.col("l_discount") > 0.05, "01").otherwise(" ").alias("p_kindcode"),
        F.col("l_linenumber").alias("p_productrankcode"),
    )
    responses = line.select(F.to_json(F.struct(F.array(condition).alias("condition"))).alias("value"))
    return organic_keys(responses).select("dt", "product_cls", "country", "category", "item", "kind", "product_rank")


def gold_checks(spark, sf_dir):
    """All marts written and every check of the gold layer run on what was written."""
    snapshot = gold.latest_snapshot(feeds.api10(spark, sf_dir))
    frames = build.mart_frames(
        snapshot, feeds.api13(spark, sf_dir), feeds.api17(spark, sf_dir), feeds.coordinates(spark, sf_dir), feeds.seasons(spark, sf_dir)
    )
    marts = build.write_marts(frames, work_path(spark, "gold"))
    return build.checks(marts, feeds.api10(spark, sf_dir), snapshot)


QUERIES = {
    f.__name__: f
    for f in (
        api1_load,
        api10_load,
        api17_load,
        backfill_landing,
        reject_accounting,
        load_rejects,
        load_accounting,
        product_request_grid,
        organic_landing_keys,
        gold_checks,
    )
}

_MARTS = {
    "mart_price_rise_top3": "price_rise_top3",
    "mart_price_drop_top3": "price_drop_top3",
    "mart_season_region_product": "season_region_product",
    "mart_retail_channel_comparison": "retail_channel_comparison",
    "mart_retail_region_comparison": "retail_region_comparison",
    "mart_eco_price_statistics_by_category": "eco_price_stats",
}


def _row(table: str, check: str, column: str, count: str) -> str:
    """One check from a query of one number ``n``."""
    return f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, n AS failing_rows, n = 0 AS passed FROM ({count})"


def _gold_sql() -> str:
    sql = {mart: GOLD_ORACLES[query] for mart, query in _MARTS.items()}
    rows = [
        _row(mart, "not_null", c, f"SELECT count(*) FILTER ({c} IS NULL) AS n FROM ({sql[mart]})")
        for mart, columns in build.NOT_NULL.items()
        for c in columns
    ]
    for mart in ("mart_price_rise_top3", "mart_price_drop_top3"):
        key = f"SELECT count(*) AS n FROM (SELECT 1 FROM ({sql[mart]}) GROUP BY country_cd, ranking HAVING count(*) > 1)"
        rows.append(_row(mart, "unique", "country_cd,ranking", key))
    season, eco = "mart_season_region_product", "mart_eco_price_statistics_by_category"
    months = f"SELECT count(*) FILTER (present_month <> season_month) AS n FROM ({sql[season]})"
    rows.append(_row(season, "same_month", "present_month,season_month", months))
    values = ", ".join(f"'{v}'" for v in build.MARKET_CATEGORIES)
    outside = f"SELECT count(*) FILTER (market_category NOT IN ({values})) AS n FROM ({sql[eco]})"
    rows.append(_row(eco, "accepted_values", "market_category", outside))
    for mart in ("mart_price_rise_top3", "mart_price_drop_top3", season):
        rows.append(_row(mart, "not_empty", "", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n FROM ({sql[mart]})"))
    newest = f"WITH {feeds.API10_SQL} SELECT abs((SELECT count(*) FROM api10 WHERE dt = (SELECT max(dt) FROM api10)) - count(*)) AS n FROM snapshot"
    rows.append(_row("api10", "reconcile", "dt", newest))
    return " UNION ALL ".join(rows)


_PRODUCT_OUTCOME = """CASE WHEN l_tax = 0.01 THEN 'unreadable' WHEN l_tax IN (0.02, 0.03) THEN 'empty'
    WHEN country = '9999' AND l_tax > 0.035 THEN 'bad_record' ELSE 'rows' END"""
_REGION_CODES = ", ".join(f"'{code}'" for code in feeds.REGION_NAMES)

ORACLES = {
    "api1_load": SILVER_ORACLES["api1_silver"],
    "api10_load": f"WITH {stamped_sql("date_trunc('year', l_shipdate)")} SELECT * FROM stored",
    "api17_load": REGION_SQL,
    "backfill_landing": REGION_SQL,
    "reject_accounting": f"""WITH category AS (WITH {feeds.CATEGORY_DOCS_SQL} SELECT *, CASE
    WHEN l_tax = 0.01 THEN 'unreadable' WHEN l_tax < 0.025 THEN 'empty' WHEN l_tax = 0.03 AND l_returnflag = 'A' THEN 'bad_record'
    ELSE 'rows' END AS outcome FROM docs),
product AS (WITH {feeds.PRODUCT_DOCS_SQL} SELECT *, CASE WHEN l_tax = 0.01 THEN 'unreadable' WHEN l_tax IN (0.02, 0.03) THEN 'empty'
    ELSE 'rows' END AS outcome FROM docs),
region AS (SELECT CASE WHEN l_tax = 0.01 THEN 'unreadable' WHEN l_tax = 0.0 THEN 'empty' WHEN l_partkey % 3 = 0 THEN 'bad_record'
    ELSE 'rows' END AS outcome FROM lineitem),
counted AS (
  SELECT 'category' AS feed, outcome FROM category UNION ALL SELECT 'product', outcome FROM product
  UNION ALL SELECT 'region', outcome FROM region)
SELECT feed, outcome, count(*) AS documents FROM counted GROUP BY 1, 2
UNION ALL SELECT feed, 'given', count(*) FROM counted WHERE outcome = 'rows' GROUP BY 1""",
    "load_rejects": f"""WITH {feeds.PRODUCT_DOCS_SQL}, told AS (
  SELECT dt, CASE WHEN country = 'all' THEN 'without_place' ELSE {_PRODUCT_OUTCOME} END AS outcome FROM docs)
SELECT outcome, dt, count(*) AS documents FROM told GROUP BY 1, 2 UNION ALL SELECT 'given', dt, count(*) FROM told GROUP BY 2""",
    "load_accounting": f"""WITH category AS (
  WITH {feeds.CATEGORY_DOCS_SQL}
  SELECT 'documents' AS counted, CASE WHEN l_tax = 0.01 THEN 'unreadable' WHEN l_tax < 0.025 THEN 'empty'
    WHEN l_tax = 0.03 AND l_returnflag = 'A' THEN 'bad_record' ELSE 'rows' END AS name FROM docs
  UNION ALL SELECT 'rows', CASE WHEN base_pr IS NULL THEN 'no_price' ELSE 'kept' END FROM labelled),
product AS (
  WITH {feeds.PRODUCT_DOCS_SQL}
  SELECT 'documents' AS counted, {_PRODUCT_OUTCOME} AS name FROM docs
  UNION ALL SELECT 'rows', CASE WHEN product_cls_code <> '01' THEN 'other_class' WHEN category_code = '700' THEN 'no_segment' ELSE 'kept' END
  FROM raw_rows WHERE country <> '9999'
  UNION ALL SELECT 'rows', 'other_class' FROM docs WHERE l_tax = 0.0),
region AS (
  WITH {feeds.REGION_ROWS_SQL}
  SELECT 'documents' AS counted, CASE WHEN l_tax = 0.01 THEN 'unreadable' WHEN l_tax = 0.0 THEN 'empty' ELSE 'rows' END AS name FROM lineitem
  UNION ALL SELECT 'rows', CASE WHEN l_discount IN (0.0, 0.01) THEN 'pseudo_region' ELSE 'kept' END FROM dated)
SELECT feed, counted, name, count(*) AS n FROM (
  SELECT 'category' AS feed, * FROM category UNION ALL SELECT 'product', * FROM product UNION ALL SELECT 'region', * FROM region)
GROUP BY 1, 2, 3""",
    "product_request_grid": f"""SELECT CAST(d AS VARCHAR) AS regday, unnest([{_REGION_CODES}]) AS country_code
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "organic_landing_keys": """SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, '01' AS product_cls, 'all' AS country, '500' AS category,
  CAST(l_partkey AS VARCHAR) AS item, CASE WHEN l_discount > 0.05 THEN '01' ELSE '' END AS kind, '' AS product_rank
FROM lineitem WHERE l_tax > 0.02""",
    "gold_checks": _gold_sql(),
}
