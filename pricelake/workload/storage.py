"""Writers and scans of landed and stored data, each written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.functions import path_attribute
from pricelake.operators import registry, sinks
from pricelake.operators.snapshot import month_partitions
from pricelake.plans import gold
from pricelake.plans.loads import load_products, stamped_products
from pricelake.schemas import LANDING_KEYS, PRODUCTS, SEASONS
from pricelake.session import work_path
from pricelake.sources import landing, tables
from pricelake.workload import feeds
from pricelake.workload.shape import plain
from pricelake.workload.silver import product_codes, product_rows_sql

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _land_products(spark, sf_dir):
    """Product documents landed below dt, class and region; the path keeps the shipping year."""
    root = work_path(spark, "landing")
    docs = feeds.product_docs(spark, sf_dir)
    return root, sinks.land_documents(docs.drop("file_path"), root, compression="gzip")


def json_landing_scan(spark, sf_dir):
    """Landed documents with broken and empty ones kept apart."""
    root, keys = _land_products(spark, sf_dir)
    docs = landing.scan_status(landing.read_documents(spark, root, keys))
    return docs.groupBy("dt", "rejected").agg(F.count("*").alias("documents"))


def dated_scan(spark, sf_dir):
    """Two landing dates, one landed and one not; only the named folder is listed."""
    root, keys = _land_products(spark, sf_dir)
    docs = landing.read_documents(spark, root, keys)
    found = landing.of_date(docs, "19981101").unionAll(landing.of_date(docs, "18000101"))
    return found.groupBy("dt", "product_cls", "country").agg(F.count("*").alias("documents"))


def latest_date_scan(spark, sf_dir):
    root, keys = _land_products(spark, sf_dir)
    docs = landing.read_latest(spark, root, keys, "01")
    return docs.groupBy("dt", "product_cls", "country").agg(F.count("*").alias("documents"))


def landing_write(spark, sf_dir):
    """Region records grouped by day are landed with all path keys a month folder needs; the
    dashes of the date are dropped and the region level is absent. Each document comes on several lines."""
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        F.replace(F.to_json(F.struct(*LINE)), F.lit(","), F.lit(",\r\n ")).alias("value"),
        F.date_format("l_shipdate", "yyyy-MM").alias("dt"),
        F.lit("01").alias("product_cls"),
        F.col("l_returnflag").alias("category"),
    )
    root = work_path(spark, "landing")
    keys = sinks.land_documents(lines, root, normalize_dt=True)
    docs = landing.read_documents(spark, root, keys)
    attributes = {f"path_{k}": path_attribute(F.col("file_path"), k) for k in LANDING_KEYS}
    fields = F.from_json("value", "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint")
    return docs.select(fields.alias("f"), *keys, *[c.alias(k) for k, c in attributes.items()]).select("f.*", "*").drop("f")


def landing_status_counts(spark, sf_dir):
    """Keys of shipped lines against keys of ordered lines: day and discount rate."""
    incoming = feeds.table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("dt"), F.col("l_linenumber").alias("category")
    )
    landed = feeds.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("dt"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("category"),
    )
    return sinks.landing_status(incoming, landed, ["dt", "category"])


def parquet_scan(spark, sf_dir):
    """Declared-schema scan, joined by name with a history that does not exist yet."""
    path = work_path(spark, "nothing")
    schema = feeds.table(spark, sf_dir, "events").schema
    known = tables.read_parquet(spark, f"{sf_dir}/events.parquet", schema)
    both = known.unionByName(tables.read_parquet(spark, path, schema))
    return both.groupBy("event_type").agg(F.count("*").alias("events"), F.max("event_id").alias("last_id"))


def csv_write(spark, sf_dir):
    """Product metadata through a header CSV; codes keep their leading zeros, and names their quotes, commas, line breaks
    and last backslash."""
    path = work_path(spark, "csv")
    named = feeds.products(spark, sf_dir, unpadded=True).withColumn("item_nm", F.concat("item_nm", F.lit(ODD_TEXT)))
    sinks.write_csv(named, path)
    return tables.products(spark, path)


#: Everything a CSV dialect can get wrong.
ODD_TEXT = ' "a ""b""", c\n\'d\\'


def csv_scan(spark, sf_dir):
    path = work_path(spark, "csv")
    sinks.write_csv(feeds.products(spark, sf_dir), path)
    return tables.read_csv(spark, path, PRODUCTS)


def seed_scan(spark, sf_dir):
    path = work_path(spark, "seed")
    named = feeds.seasons(spark, sf_dir).withColumn("kind_nm", F.concat("kind_nm", F.lit(ODD_TEXT)))
    sinks.write_csv(named, path)
    return plain(tables.read_csv(spark, path, SEASONS))


def _stored_products(spark, sf_dir):
    """Product history stamped per batch and written to all segments."""
    root = work_path(spark, "api10")
    load_products(feeds.product_docs(spark, sf_dir), product_codes(spark, sf_dir), root)
    return root


def snapshot_write(spark, sf_dir):
    """Snapshot folders: one date per batch, that of the batch's first dated row. Many rows, the first of some batches
    among them, have no date."""
    path = work_path(spark, "snapshots")
    docs = feeds.product_docs(spark, sf_dir, F.when(F.col("l_linenumber") > 1, F.col("l_shipdate")))
    sinks.write_snapshot(stamped_products(docs, product_codes(spark, sf_dir)).drop("segment"), path)
    return plain(tables.read_silver(spark, path, "api10"))


def segment_split(spark, sf_dir):
    """The three segments, each read from its own folder."""
    root = _stored_products(spark, sf_dir)
    rows = None
    for segment in sinks.SEGMENTS:
        part = tables.read_silver(spark, f"{root}/segment={segment}", "api10").withColumn("segment", F.lit(segment))
        rows = part if rows is None else rows.unionAll(part)
    return plain(rows)


def registered_scan(spark, sf_dir):
    """The main segment registered by location and read by name through the latest snapshot."""
    root = _stored_products(spark, sf_dir)
    database = "pricelake_registered"
    registry.create_databases(spark, work_path(spark, "databases"), (database,))
    name = registry.register_silver(spark, "api10", f"{root}/segment=main", f"{database}.api10")
    return plain(gold.latest_snapshot(spark.table(name), tables.newest_partition(spark, name)))


def _prices(spark, sf_dir):
    """Order lines as a stored price table, with month partitions and the day as third level name."""
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        *LINE, F.col("l_extendedprice").alias("price"), F.col("l_shipdate").cast("date").alias("res_dt"), "l_returnflag"
    )
    return month_partitions(lines)


def replace_day(spark, sf_dir):
    """A rerun of the newest snapshot with other prices; all other snapshots stay as they were."""
    path = work_path(spark, "days")
    base = _prices(spark, sf_dir).withColumns({"month": F.lit("11"), "dt": F.concat("year", F.lit("1101"))})
    sinks.write_snapshot(base, path)
    rerun = base.where(base.dt == base.agg(F.max("dt")).scalar()).withColumn("price", F.col("price") + 1)
    sinks.write_snapshot(rerun, path)
    return plain(spark.read.schema(base.schema).parquet(path).drop("res_dt"))


def merge_by_date(spark, sf_dir):
    """Months rewritten where days come again: returned lines of the first of a month replace everything of that day.

    They bring a new column and lack one that is stored. Stored and new rows without a date stay beside each other, and a
    second run of the same load changes nothing.
    """
    path = work_path(spark, "months")
    base = _prices(spark, sf_dir).withColumn("res_dt", F.when(F.col("l_linenumber") < 7, F.col("res_dt")))
    base = month_partitions(base)
    sinks.write_parquet(base, path, ("year", "month"))
    returned = base.where("l_returnflag = 'R' AND (day(res_dt) = 1 OR res_dt IS NULL)").drop("l_returnflag")
    again = returned.withColumns({"revised": F.lit(True), "price": F.col("price") + 1})
    for _ in range(2):
        sinks.merge_by_date(tables.read_stored(spark, path, base.schema, ("year", "month")), again, path)
    return plain(tables.read_stored(spark, path, base.schema, ("year", "month")))


def month_swap(spark, sf_dir):
    """The same merge into a registered table, by pointing the catalog to new months. One load breaks before that and is run
    again; then it is run once more, and what no month points to is removed."""
    path, database = work_path(spark, "swapped"), "pricelake_swap"
    base = month_partitions(_prices(spark, sf_dir).withColumn("res_dt", F.when(F.col("l_linenumber") < 7, F.col("res_dt"))))
    sinks.write_parquet(base, path, ("year", "month"))
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    registry.create_databases(spark, work_path(spark, "databases"), (database,))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema)
    spark.sql(f"CREATE TABLE {database}.prices ({columns}) USING parquet PARTITIONED BY (year, month) LOCATION '{path}'")
    registry.sync_partitions(spark, [f"{database}.prices"])
    returned = base.where("l_returnflag = 'R' AND (day(res_dt) = 1 OR res_dt IS NULL)").drop("l_returnflag")
    again = returned.withColumns({"revised": F.lit(True), "price": F.col("price") + 1})
    registry.write_version(spark, f"{database}.prices", again)
    for _ in range(2):
        registry.swap_months(spark, f"{database}.prices", again)
    registry.drop_old_versions(spark, f"{database}.prices")
    return plain(spark.table(f"{database}.prices"))


def whole_file_landing(spark, sf_dir):
    """A document per part, on several lines, landed in a file of its own; read by whole files, and by lines after the zone was compacted."""
    part = feeds.table(spark, sf_dir, "part")
    docs = part.select(
        F.replace(F.to_json(F.struct("p_partkey", "p_name", "p_size")), F.lit(","), F.lit(",\r\n ")).alias("value"),
        F.when(F.col("p_size") % 2 == 0, "20250101").otherwise("20250102").alias("dt"),
        F.lit("01").alias("product_cls"),
    )
    root, compact = work_path(spark, "landing"), work_path(spark, "compacted")
    keys = sinks.land_documents(docs, root, one_per_file=True)
    for day in landing.folder_values(spark, root, "dt"):
        sinks.compact_documents(spark, root, compact, keys, day)
    whole, lines = landing.read_documents(spark, root, keys, one_per_file=True), landing.read_documents(spark, compact, keys)
    both = whole.withColumn("layout", F.lit("file")).unionByName(lines.withColumn("layout", F.lit("line")))
    fields = landing.parsed(F.col("value"), "struct<p_partkey:bigint,p_name:string,p_size:bigint>")
    return both.select(fields.alias("f"), "layout", *keys).select("f.*", "layout", *keys)


def undated_batches(spark, sf_dir):
    """Product batches, a landing date each, every other one without a dated row: these take their landing date. Three loads."""
    root = work_path(spark, "undated")
    docs = feeds.product_docs(spark, sf_dir, F.when(F.year("l_shipdate") % 2 == 1, F.col("l_shipdate")))
    for rest in range(3):
        load_products(docs.where(F.substring("dt", 1, 4).cast("int") % 3 == rest), product_codes(spark, sf_dir), root)
    schema = tables.silver_read_schema("api10").add("segment", "string")
    return plain(spark.read.schema(schema).parquet(root))


def materialize_mart(spark, sf_dir):
    """A mart rebuilt over an earlier one holds only the new rows."""
    path = work_path(spark, "mart")
    snapshot = gold.latest_snapshot(feeds.api10(spark, sf_dir))
    sinks.write_parquet(gold.price_region_count(snapshot.where("prev_1d_dir_tp = '1'")), path)
    sinks.write_parquet(gold.price_region_count(snapshot), path)
    return spark.read.schema("country_nm string, rise_count bigint, drop_count bigint, keep_count bigint").parquet(path)


GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def table_inventory(spark, sf_dir):
    database = "pricelake_inventory"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    registry.create_databases(spark, work_path(spark, "databases"), (database,))
    for name in GIVEN:
        registry.register_files(spark, f"{database}.{name}", f"{sf_dir}/{name}.parquet")
    return registry.inventory(spark, [database])


QUERIES = {
    f.__name__: f
    for f in (
        json_landing_scan,
        dated_scan,
        latest_date_scan,
        landing_write,
        landing_status_counts,
        parquet_scan,
        csv_write,
        csv_scan,
        seed_scan,
        snapshot_write,
        segment_split,
        registered_scan,
        undated_batches,
        replace_day,
        merge_by_date,
        month_swap,
        whole_file_landing,
        materialize_mart,
        table_inventory,
    )
}

def stamped_sql(day: str = "l_shipdate") -> str:
    """Product rows with the date of the first dated row of their batch."""
    return f"""{product_rows_sql(day)},
batches AS (
  SELECT batch AS stamp_batch, arg_min(res_dt, file_path || '#' || pos) AS day FROM product_rows WHERE res_dt IS NOT NULL GROUP BY batch),
stored AS (
  SELECT product_rows.* EXCLUDE (batch, file_path, pos), substr(day, 1, 4) AS year, substr(day, 6, 2) AS month,
    replace(day, '-', '') AS dt
  FROM product_rows JOIN batches ON batch = stamp_batch)"""


_STAMPED = stamped_sql()
_LINE = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey"
_COUNTS = "WITH {docs} SELECT dt, '01' AS product_cls, country, count(*) AS documents FROM docs WHERE dt = {dt} GROUP BY 1, 2, 3"

_ODD_SQL = "'" + ODD_TEXT.replace("'", "''") + "'"

ORACLES = {
    "json_landing_scan": f"""WITH {feeds.PRODUCT_DOCS_SQL}
SELECT dt, l_tax = 0.01 AS rejected, count(*) AS documents FROM docs GROUP BY 1, 2""",
    "dated_scan": _COUNTS.format(docs=feeds.PRODUCT_DOCS_SQL, dt="'19981101'"),
    "latest_date_scan": _COUNTS.format(docs=feeds.PRODUCT_DOCS_SQL, dt="(SELECT max(dt) FROM docs)"),
    "landing_write": f"""SELECT {_LINE}, strftime(l_shipdate, '%Y%m') AS dt, '01' AS product_cls,
  l_returnflag AS category, strftime(l_shipdate, '%Y%m') AS path_dt, '01' AS path_product_cls,
  CAST(NULL AS VARCHAR) AS path_country, l_returnflag AS path_category,
  CAST(NULL AS VARCHAR) AS path_item, CAST(NULL AS VARCHAR) AS path_kind, CAST(NULL AS VARCHAR) AS path_product_rank
FROM lineitem""",
    "landing_status_counts": """WITH incoming AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_linenumber AS c FROM lineitem),
landed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS c FROM orders)
SELECT CASE WHEN (d, c) IN (SELECT (d, c) FROM landed) THEN 'overwrite' ELSE 'new' END AS status,
  count(*) AS objects FROM incoming GROUP BY 1""",
    "parquet_scan": """SELECT event_type, count(*) AS events, max(event_id) AS last_id FROM events GROUP BY 1""",
    "csv_write": f"WITH {feeds.PRODUCTS_SQL} SELECT * REPLACE (item_nm || {_ODD_SQL} AS item_nm) FROM products",
    "csv_scan": f"WITH {feeds.PRODUCTS_SQL} SELECT * FROM products",
    "seed_scan": f"WITH {feeds.SEASONS_SQL} SELECT * REPLACE (CAST(month AS BIGINT) AS month, kind_nm || {_ODD_SQL} AS kind_nm) FROM seasons",
    "snapshot_write": f"""WITH {stamped_sql("CASE WHEN l_linenumber > 1 THEN l_shipdate END")}
SELECT * EXCLUDE (segment) FROM stored""",
    "segment_split": f"WITH {_STAMPED} SELECT * FROM stored",
    "registered_scan": f"""WITH {_STAMPED}
SELECT product_no, category_nm, item_nm, kind_nm, product_cls_unit, country_cd, country_nm, res_dt, base_dt, base_pr, prev_1d_dt,
  prev_1d_pr, direction_tp AS prev_1d_dir_tp, TRY_CAST(direction_pct AS DOUBLE) AS prev_1d_dir_pct, prev_1m_dt, prev_1m_pr,
  prev_1y_dt, prev_1y_pr, dt
FROM stored WHERE segment = 'main' AND dt = (SELECT max(dt) FROM stored WHERE segment = 'main')""",
    "replace_day": f"""WITH base AS (SELECT *, strftime(l_shipdate, '%Y') AS year FROM lineitem)
SELECT {_LINE}, l_extendedprice + CASE WHEN year = (SELECT max(year) FROM base) THEN 1 ELSE 0 END AS price,
  l_returnflag, year, '11' AS month, year || '1101' AS dt FROM base""",
    "merge_by_date": f"""WITH base AS (SELECT *, CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) END AS d FROM lineitem),
again AS (SELECT * FROM base WHERE l_returnflag = 'R' AND (day(d) = 1 OR d IS NULL))
SELECT {_LINE}, l_extendedprice AS price, CAST(d AS VARCHAR) AS res_dt, l_returnflag, strftime(d, '%Y') AS year,
  strftime(d, '%m') AS month, CAST(NULL AS BOOLEAN) AS revised
FROM base WHERE d IS NULL OR d NOT IN (SELECT d FROM again WHERE d IS NOT NULL)
UNION ALL SELECT {_LINE}, l_extendedprice + 1, CAST(d AS VARCHAR), NULL, strftime(d, '%Y'), strftime(d, '%m'), true
FROM again""",
    "whole_file_landing": """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, unnest(['file', 'line']) AS layout,
  CASE WHEN p_size % 2 = 0 THEN '20250101' ELSE '20250102' END AS dt, '01' AS product_cls FROM part""",
    "undated_batches": f"""WITH {product_rows_sql("CASE WHEN year(l_shipdate) % 2 = 1 THEN l_shipdate END")},
batches AS (
  SELECT batch AS stamp_batch, coalesce(min_by(res_dt, file_path || '#' || pos) FILTER (res_dt IS NOT NULL), substr(batch, 1, 4) || '-11-01') AS day
  FROM product_rows GROUP BY batch)
SELECT product_rows.* EXCLUDE (batch, file_path, pos), substr(day, 1, 4) AS year, substr(day, 6, 2) AS month, replace(day, '-', '') AS dt
FROM product_rows JOIN batches ON batch = stamp_batch""",
    "materialize_mart": f"""WITH {feeds.API10_SQL}
SELECT country_nm, CAST(count(*) FILTER (prev_1d_dir_tp = '1') AS BIGINT) AS rise_count,
  CAST(count(*) FILTER (prev_1d_dir_tp = '0') AS BIGINT) AS drop_count,
  CAST(count(*) FILTER (prev_1d_dir_tp = '2') AS BIGINT) AS keep_count
FROM snapshot GROUP BY country_nm""",
    "table_inventory": " UNION ALL ".join(
        f"""SELECT 'pricelake_inventory' AS database_name, '{name}' AS table_name,
  (SELECT count(*) FROM (DESCRIBE {name})) AS column_count, count(*) AS row_count FROM {name}"""
        for name in GIVEN
    ),
}
# The same rows, whichever way the months are replaced.
ORACLES["month_swap"] = ORACLES["merge_by_date"]
